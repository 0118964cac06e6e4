from __future__ import annotations

import hashlib
import random
import re

import pytest

from lexloom.llm.plans import QUERIES
from lexloom.llm.secrets import SecretRule, find_secrets, spans_text

OWNED = "doc_id bigint, owner string, repo string, text string"
PATTERNS = [
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)),
    ("access", re.compile(r"AKIA[A-Z0-9]+")),
    ("hex", re.compile(r"[0-9a-f]+")),
]
LEAST = {"assign": 6, "access": 20, "hex": 24}


def plain_base(text: str | None) -> list[tuple[int, int, str, int, str]]:
    found = []
    for order, (kind, pattern) in enumerate(PATTERNS):
        for m in pattern.finditer(text or ""):
            value = m[2] if kind == "assign" else m[0]
            if len(value) >= LEAST[kind]:
                found.append((m.start(), order, kind, m.end(), value))
    return sorted(found)


def lively(value: str) -> bool:
    digits, letters = len(re.findall("[0-9]", value)), len(re.findall("[A-Za-z]", value))
    return len(value) >= 16 and len(set(value)) >= 8 and digits >= 3 and letters >= 3


def plain_findings(rows: list[tuple]) -> list[list[tuple[str, int, int, str]]]:
    """Every document against the owners of every value of every document."""
    every = []
    for _, _, _, text in rows:
        base = plain_base(text)
        bare = [(m.start(), 3, "owned", m.end(), m[0]) for m in re.finditer("[0-9A-Za-z+/_=-]+", text or "") if lively(m[0])]
        every.append(sorted(base + [w for w in bare if not any(x[0] < w[3] and x[3] > w[0] for x in base)]))
    owners: dict[str, set] = {}
    for (_, owner, *_), found in zip(rows, every, strict=True):
        for f in found:
            owners.setdefault(f[4], set()).add(owner)
    out = []
    for found in every:
        judged = [(f[2], f[0], f[3], "example" if len(owners[f[4]]) >= 3 else "live" if lively(f[4]) else "weak") for f in found]
        out.append([f for f in judged if f[0] != "owned" or f[3] == "live"])
    return out


def drawn_texts(rng: random.Random, n: int) -> list[tuple]:
    values = ["".join(rng.choices("abcdef0123456789", k=rng.choice([5, 18, 23, 24, 40]))) for _ in range(6)]
    values += ["AKIA" + "".join(rng.choices("ABCDEFGHIJ0123456789", k=rng.choice([15, 16, 30]))) for _ in range(4)]
    values += ["".join(rng.choices("abcdefghXYZ0123456789+/_=-", k=rng.choice([15, 16, 32]))) for _ in range(6)] + ["changeme", "abc", "a.b-c/d"]
    names = ["password", "PASSWD", "Secret", "token", "api_key", "APIKEY", "ſecret", "toKen", "nothing", "tokens"]
    out = []
    for d in range(n):
        parts = []
        for _ in range(rng.randrange(12)):
            value = rng.choice(values)
            how = rng.randrange(5)
            parts.append(
                rng.choice(names) + rng.choice(["", '"', "'"]) + rng.choice(["=", ":", " : ", "\t=", " "]) + rng.choice(["", "'", '"', "é"]) + value
                if how < 2 else value if how == 2 else "token=" + rng.choice(["secret=", "ab: "]) + value if how == 3 else "東京 wörter 12"
            )
        owner = rng.choice(["a", "b", "c", None])
        out.append((d, owner, rng.choice(["r", "s", None]), rng.choice([" ", "", "\n"]).join(parts)))
    return out


@pytest.mark.parametrize("rule", [SecretRule(), SecretRule(sent=0)])
def test_findings_are_those_of_plain_patterns_and_counts(spark, rule):
    rows = drawn_texts(random.Random(5), 300)
    got = {r["doc_id"]: [(f["kind"], f["start"], f["end"], f["verdict"]) for f in r["findings"]] for r in find_secrets(spark.createDataFrame(rows, OWNED), rule).collect()}
    want = plain_findings(rows)
    assert {v for found in want for *_, v in found} == {"live", "example", "weak"} and any(f[0] == "owned" for found in want for f in found)
    assert got == dict(enumerate(want))


def test_texts_that_touch_in_memory_do_not_share_findings(spark):
    half = "0123456789abcdef"
    rows = [(1, "a", "r", half), (2, "a", "r", half), (3, "a", "r", ""), (4, "a", "r", half + half)]
    got = {r["doc_id"]: [(f["kind"], f["start"], f["end"]) for f in r["findings"]] for r in find_secrets(spark.createDataFrame(rows, OWNED).coalesce(1)).collect()}
    assert got == {1: [("owned", 0, 16)], 2: [("owned", 0, 16)], 3: [], 4: [("hex", 0, 32)]}


def test_copies_make_examples_and_one_owner_does_not(spark):
    value = "9fK3xQ7pLw2ZtB8vR5mN"
    copied = [(d, f"o{d % 40}", "r", f"set TOKEN = '{value}' here") for d in range(400)]
    own = [(1000 + d, "o1", f"r{d}", f"use zz{value}9 now") for d in range(50)]
    got = find_secrets(spark.createDataFrame(copied + own, OWNED)).collect()
    found = {r["doc_id"]: r["findings"] for r in got}
    assert all(found[d][0]["verdict"] == "example" and found[d][0]["n_owners"] == 40 and found[d][0]["n_repos"] == 40 for d in range(400))
    assert all(f["verdict"] == "live" and f["n_owners"] == 1 and f["n_repos"] == 50 for d in range(50) for f in found[1000 + d])


def test_edges(spark, edge_docs, no_docs):
    given = edge_docs.selectExpr("*", "source AS owner", "lang AS repo", "1 AS row", "2 AS value")
    got = find_secrets(given)
    assert got.columns == ["doc_id", "findings"] and got.count() == edge_docs.count() and got.where("size(findings) > 0").count() == 0
    assert find_secrets(no_docs.selectExpr("*", "source AS owner", "lang AS repo")).count() == 0
    long = "wort " * 300_000 + "password: hunter2hunter " + "ü" * 100_000 + " AKIA" + "Q7" * 8
    rows = [(None, None, None, long), (1, None, None, None), (1, None, None, long), (1, None, None, long)]
    found = find_secrets(spark.createDataFrame(rows, OWNED)).select("doc_id", spans_text("findings").alias("s")).collect()
    text = ",".join(f"{k}:{a}:{b}" for a, _, k, b, _ in plain_base(long))
    assert len(text) > 20 and sorted(r["s"] for r in found) == ["", text, text, text]


def test_query_at_small_scale(spark):
    sf = "/root/testdata/sf0.01"
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    want = plain_findings([(d, r["source"], None, r["text"]) for d, r in docs.items()])
    got = {r["doc_id"]: r for r in QUERIES["op11_secrets"](spark, sf).collect()}
    assert sum(map(len, want)) > 5
    for d, found in zip(docs, want, strict=True):
        base = [f"{k}:{a}:{b}" for k, a, b, _ in found if k != "owned"]
        assert got[d]["spans"] == ",".join(f"{k}:{a}:{b}" for k, a, b, _ in found)
        assert got[d]["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert [got[d][f"n_{k}"] for k in ("assign", "access", "hex", "owned")] == [sum(f[0] == k for f in found) for k in ("assign", "access", "hex", "owned")]
        assert [got[d][f"n_{v}"] for v in ("live", "example")] == [sum(f[3] == v for f in found) for v in ("live", "example")]
