from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa

from lexloom.llm.arrays import line_spans, pieces, prefix_hash, span_hash, utf8, word_spans
from lexloom.llm.perplexity import text_statistics

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def random_texts(seed: int, n: int = 60) -> list[str | None]:
    rng = random.Random(seed)
    return [rng.choice([None, "", "".join(rng.choices("ab é\n\t$|", k=rng.randrange(80)))]) for _ in range(n)]


def test_words_and_lines_match_plain_python():
    texts = random_texts(1)
    column = pa.array(["skipped", *texts]).slice(1)
    data, at = utf8(column)
    starts, ends, row = word_spans(data, at)
    found = [[] for _ in texts]
    for a, b, r in zip(starts, ends, row, strict=True):
        found[r].append(data[a:b].tobytes().decode())
    assert found == [WORD.findall(t or "") for t in texts]
    ls, le, lrow = line_spans(data, at)
    lines = [[] for _ in texts]
    for a, b, r in zip(ls, le, lrow, strict=True):
        lines[r].append(data[a:b].tobytes().decode())
    assert lines == [(t or "").split("\n") for t in texts]


def test_equal_spans_have_equal_hashes_wherever_they_stand():
    data = np.frombuffer(b"abcabcxabc", np.uint8)
    h = span_hash(prefix_hash(data), np.array([0, 3, 7, 1]), np.array([3, 6, 10, 4]))
    assert h[0] == h[1] == h[2] != h[3]


def test_pieces_cover_all_rows_and_long_texts_stand_alone():
    batch = pa.record_batch([pa.array(["a" * 10, "b" * 100, "", None, "c" * 5])], names=["text"])
    parts = list(pieces(iter([batch]), "text", limit=12))
    assert [r for p in parts for r in p.column(0).to_pylist()] == batch.column(0).to_pylist()
    assert len(parts) == 3


def slow_statistics(text: str) -> dict[str, int]:
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 3)}
    lines = text.split("\n")
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": sum(bool(WORD.search(x)) and x in lines[:i] for i, x in enumerate(lines)), "n_repeat_words": len(covered),
    }


def test_text_statistics():
    texts = random_texts(2, 200)
    stats = text_statistics(*utf8(pa.array(texts)))
    for i, text in enumerate(texts):
        assert {k: int(v[i]) for k, v in stats.items()} == slow_statistics(text or "")
