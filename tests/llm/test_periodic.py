"""Periodic runs against a search over all periods."""

import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pytest

from ledgerstar.llm import periodic, queries

SMALL = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
EMPTY = hashlib.sha256(b"").hexdigest()


def searched(words, least=24, times=3):
    """Every period, every stretch that keeps it; those with a smaller period are left out."""
    found = []
    for q in range(1, len(words) // times + 1):
        start = 0
        while start + q < len(words):
            end = start
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            stretch = words[start : end + q]
            if len(stretch) >= max(least, times * q):
                if not any(stretch[k:] == stretch[:-k] for k in range(1, q)):
                    found.append((start, len(stretch), q))
            start = max(end, start) + 1
    return sorted(found, key=lambda run: (run[0], run[2]))


def expected(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = searched(words)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = None
    for s, length, q in found:  # the greatest quotient, compared by cross products
        if best is None or (length * best[2], -s, -q) > (best[1] * q, -best[0], -best[2]):
            best = s, length, q
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in found)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    shas = [hashlib.sha256(x.encode()).hexdigest() for x in (listed, kept)]
    figures = [None] * 4 if best is None else [*best, 1000 * best[1] // best[2]]
    return (doc_id, len(found), *figures, *shas)


def test_depth():
    assert periodic.depth(24, 3) == 16
    assert periodic.depth(4, 2) == 2


@pytest.mark.parametrize("least, times", [(4, 2), (9, 3), (24, 3), (12, 4)])
def test_random_words(least, times):
    rng = random.Random(least)
    for _ in range(400):
        documents = []
        for _ in range(rng.randint(1, 4)):
            n, letters = rng.randint(0, 80), rng.randint(1, 4)
            words = [rng.randrange(letters) for _ in range(n)]
            if rng.random() < 0.6:
                words = (words[: rng.randint(1, 9)] * 80)[:n]
                for _ in range(rng.randint(0, 3)):
                    if words:
                        words[rng.randrange(len(words))] = rng.randrange(letters)
            documents.append(words)
        got = periodic.runs([np.array(x, np.int32) for x in documents], least, times)
        assert got == [searched(x, least, times) for x in documents]


@pytest.mark.parametrize(
    "words, run",
    [
        (np.zeros(100_000), (0, 100_000, 1)),
        (np.tile(np.arange(7), 10_000), (0, 70_000, 7)),
        (np.tile(np.arange(20_000), 4), (0, 80_000, 20_000)),
    ],
)
def test_long_runs(words, run):
    assert periodic.runs([words.astype(np.int32)]) == [[run]]


def test_whole_table(spark):
    got = {tuple(row) for row in queries.op12_periodic_runs(spark, SMALL).collect()}
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    assert got == {expected(*row) for row in texts}
    assert any(row[1] > 1 for row in got)


def test_awkward_rows(spark):
    line = "once upon a time " * 8
    made = [
        (1, line, 0), (1, line, 0), (None, line, 1), (2, None, None), (3, "", 2), (4, " \n\t", 3),
        (5, "x" * 100_000, 4), (6, "a a a\nb " * 9 + "end", 5),
    ]
    frame = spark.createDataFrame(made, "doc_id long, text string, start int")
    got = periodic.detected(frame).collect()
    assert len(got) == len(made)
    found = {row["doc_id"]: row for row in got}
    once = hashlib.sha256(b"once upon a time").hexdigest()
    for doc_id in (1, None):
        row = found[doc_id]
        assert (row["n_runs"], row["start"], row["length"], row["period"], row["exponent_milli"]) == (1, 0, 32, 4, 8000)
        assert row["collapsed_sha256"] == once
    for doc_id in (2, 3, 4):
        assert tuple(found[doc_id])[1:] == (0, None, None, None, None, EMPTY, EMPTY)
    assert found[5]["n_runs"] == 0
    assert found[6]["period"] == 4 and found[6]["length"] == 36
    assert periodic.detected(frame.limit(0)).collect() == []
