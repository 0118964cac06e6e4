"""Secrets in texts, judged by who owns them: a value that many owners have is an example, one owner's may be live.

Texts are scanned once for assignments, access keys and hexadecimal strings, and for bare tokens that look drawn at
random. What is found is kept as places and digests; digests are counted by distinct owners and repositories over the
whole corpus, and the verdict goes back to every place.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexloom.llm.arrays import pieces, utf8
from lexloom.operators.frames import salted_join
from lexloom.session import cut_lineage, ship_package

KINDS = ("assign", "access", "hex", "owned")
ASSIGN = re.compile(rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]{16,}")
HEX = re.compile(rb"[0-9a-f]{24,}")
IN_HEX = np.zeros(256, dtype=bool)
IN_HEX[list(b"0123456789abcdef")] = True
IN_TOKEN = np.zeros(256, dtype=bool)
IN_TOKEN[list(b"0123456789abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ+/_=-")] = True
IN_DIGIT = np.zeros(256, dtype=bool)
IN_DIGIT[list(b"0123456789")] = True
SALTS = 64


@dataclass(frozen=True)
class SecretRule:
    """What looks live, and how many owners make a value an example.

    An assigned value has at least ``least_value`` characters. A value looks live with at least ``least_token``
    characters, ``distinct`` different ones, and ``digits`` digits and as many letters. From ``example_owners`` distinct
    owners on it is an example. ``sent`` verdicts may go to every task after they were counted.
    """

    least_value: int = 6
    least_token: int = 16
    distinct: int = 8
    digits: int = 3
    example_owners: int = 3
    sent: int = 100_000


def looks_live(value: bytes, rule: SecretRule) -> bool:
    digits = sum(48 <= c <= 57 for c in value)
    letters = sum(65 <= c <= 90 or 97 <= c <= 122 for c in value)
    return len(value) >= rule.least_token and len(set(value)) >= rule.distinct and digits >= rule.digits and letters >= rule.digits


def _long_runs(member: np.ndarray, at: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every maximal run of at least ``least`` member bytes inside a text."""
    inside = np.zeros(len(member) + 2, dtype=np.int8)
    inside[1:-1] = member
    change = np.diff(inside)
    start, end = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
    # a run that reaches over the border of two texts is cut there
    borders = at[1:-1]
    crossed = np.unique(borders[(np.searchsorted(start, borders, "left") - np.searchsorted(end, borders, "right")) > 0])
    start, end = np.sort(np.concatenate([start, crossed])), np.sort(np.concatenate([end, crossed]))
    long = end - start >= least
    return start[long], end[long]


def text_findings(text: bytes, tokens: list[tuple[int, int]], rule: SecretRule) -> list[tuple[int, int, int, bytes]]:
    """``(kind, start, end, value)`` in bytes, by start and kind; ``tokens`` are the places of bare tokens.

    Assignments are matched as they stand and dropped afterwards if their value is short; a bare token is dropped
    unless it looks live and meets no other finding.
    """
    found = []
    if b"=" in text or b":" in text:
        found += [(0, m.start(), m.end(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= rule.least_value]
    if b"AKIA" in text:
        found += [(1, m.start(), m.end(), m[0]) for m in ACCESS.finditer(text)]
    found += [(2, m.start(), m.end(), m[0]) for a, b in tokens for m in HEX.finditer(text, a, b)]
    taken = sorted((a, b) for _, a, b, _ in found)
    ends = np.maximum.accumulate([b for _, b in taken]) if taken else np.zeros(0, np.int64)
    starts = np.array([a for a, _ in taken], np.int64)
    for a, b in tokens:
        k = int(np.searchsorted(starts, b))
        if (k == 0 or ends[k - 1] <= a) and looks_live(text[a:b], rule):
            found.append((3, a, b, text[a:b]))
    return sorted(found, key=lambda f: (f[1], f[0]))


_FOUND = "row bigint, doc_id bigint, owner string, repo string, found array<struct<kind:int,start:bigint,end:bigint,value:binary,live:boolean>>"


def _scanner(rule: SecretRule):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.binary()), ("live", pa.bool_())])
        for piece in pieces(batches, "text"):
            data, at = utf8(piece.column("text"))
            data = np.ascontiguousarray(data)
            # bare tokens hold a digit; hexadecimal strings lie inside runs of the same characters
            start, end = _long_runs(IN_TOKEN[data], at, min(rule.least_token, 24))
            n_digits = np.concatenate([[0], np.cumsum(IN_DIGIT[data])])
            n_hex = np.concatenate([[0], np.cumsum(IN_HEX[data])])
            useful = (n_digits[end] - n_digits[start] >= rule.digits) | (n_hex[end] - n_hex[start] >= 24)
            start, end = start[useful], end[useful]
            row = np.searchsorted(at, start, "right") - 1
            tokens = np.searchsorted(row, np.arange(piece.num_rows + 1))
            seen = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            raw, rows = data.tobytes(), []
            for k in range(piece.num_rows):
                a, b = int(at[k]), int(at[k + 1])
                here = slice(tokens[k], tokens[k + 1])
                places = list(zip((start[here] - a).tolist(), (end[here] - a).tolist(), strict=True))
                rows.append([
                    {"kind": f, "start": int(seen[a + i] - seen[a]), "end": int(seen[a + j] - seen[a]),
                     "value": hashlib.blake2b(value, digest_size=16).digest(), "live": looks_live(value, rule)}
                    for f, i, j, value in text_findings(raw[a:b], places, rule)
                ])
            yield pa.record_batch(
                [piece.column(c) for c in ("row", "doc_id", "owner", "repo")] + [pa.array(rows, pa.list_(kind))],
                names=["row", "doc_id", "owner", "repo", "found"],
            )

    return run


def value_owners(found: DataFrame) -> DataFrame:
    """``(value, n_owners, n_repos, n_places)`` of places ``(value, owner, repo)``, counted in steps that all combine per task.

    No list of owners is ever gathered: a value that a third of all documents have is one row per owner after the
    first step. Null owners are one owner, null repositories one repository of their owner.
    """
    by_repo = found.groupBy("value", "owner", "repo").agg(F.count(F.lit(1)).alias("n"))
    by_owner = by_repo.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repos"), F.sum("n").alias("n"))
    return by_owner.groupBy("value").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("repos").alias("n_repos"), F.sum("n").alias("n_places"))


def find_secrets(docs: DataFrame, rule: SecretRule = SecretRule()) -> DataFrame:
    """Each row of ``docs`` (``doc_id, owner, repo, text``) as ``(doc_id, findings)``.

    A finding has its ``kind`` (assign, access, hex, owned), ``start`` and ``end`` in code points, the ``n_owners`` and
    ``n_repos`` that have its value in the whole corpus, and a ``verdict``: ``example`` from ``example_owners`` distinct
    owners on, else ``live`` if the value looks live, else ``weak``. The first three kinds are always listed, whatever
    their verdict; ``owned`` are bare tokens outside of them, listed when they are live. Findings are by start, then kind.

    Null and empty texts have none. A null ``doc_id`` and repeated rows pass through; repeated rows of one owner count
    as one owner. Other columns are ignored; an empty table gives no rows. Texts are scanned whole and never shuffled;
    places and digests are written once, and rows without a place stay out of every shuffle but the last.
    """
    ship_package(docs.sparkSession)
    given = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "owner", "repo", "text")
    scanned = cut_lineage(given.mapInArrow(_scanner(rule), _FOUND))
    places = scanned.where("size(found) > 0").select("row", "owner", "repo", F.explode("found").alias("f")).select("row", "owner", "repo", "f.*")
    # values of one owner need no lookup
    owners = value_owners(places)
    shared = cut_lineage(owners.where("n_owners > 1 or n_repos > 1"))
    few = shared.limit(rule.sent + 1).count() <= rule.sent
    judged = places.join(F.broadcast(shared), "value", "left") if few else salted_join(places, shared, "value", "row", "left", SALTS)
    n_owners = F.coalesce("n_owners", F.lit(1))
    verdict = F.when(n_owners >= rule.example_owners, "example").when(F.col("live"), "live").otherwise("weak")
    kind = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    listed = judged.withColumn("verdict", verdict).where("kind < 3 or verdict = 'live'")
    finding = F.struct("start", F.col("kind").alias("order"), kind.alias("kind"), "end", n_owners.alias("n_owners"), F.coalesce("n_repos", F.lit(1)).alias("n_repos"), "verdict")
    by_row = listed.groupBy("row").agg(F.sort_array(F.collect_list(finding)).alias("findings"))
    none = F.array().cast("array<struct<start:bigint,order:int,kind:string,end:bigint,n_owners:bigint,n_repos:bigint,verdict:string>>")
    return scanned.select("row", "doc_id").join(by_row, "row", "left").select(
        "doc_id",
        F.transform(F.coalesce("findings", none), lambda f: F.struct(f["kind"].alias("kind"), f["start"].alias("start"), f["end"].alias("end"), f["n_owners"].alias("n_owners"), f["n_repos"].alias("n_repos"), f["verdict"].alias("verdict"))).alias("findings"),
    )


def spans_text(findings: Column | str) -> Column:
    """The findings as ``kind:start:end``, comma-joined."""
    return F.concat_ws(",", F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"], f["end"])))
