"""Spelling variants against a comparison by deleted letters."""

import re
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import duckdb
import pytest

from ledgerstar.llm import queries, variants
from ledgerstar.scratch import Tables

SMALL = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, planted=None):
    counts = Counter()
    for doc_id, text in rows:
        for word in RUN.findall(text or ""):
            word = word.translate(LOWER)
            if planted:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
                if h % planted == 0:
                    at = h % len(word)
                    word = word[:at] + word[at + 1 :]
            counts[word] += 1
    return {word: n for word, n in counts.items() if len(word) >= 5 and n >= 3}


def neighbours(words):
    """Words that agree after a letter is left out at one place, and words that are another less a letter."""
    near, holes = defaultdict(set), defaultdict(set)
    for word in words:
        for i in range(len(word)):
            holes[word[:i], word[i + 1 :]].add(word)
            if (less := word[:i] + word[i + 1 :]) in words:
                near[word].add(less)
                near[less].add(word)
    for group in holes.values():
        for one, other in combinations(group, 2):
            near[one].add(other)
            near[other].add(one)
    return near


def expected(counts):
    near, forms = neighbours(counts), {}
    for word, n in counts.items():
        best = min(near[word], key=lambda x: (-counts[x], x), default=None)
        forms[word] = best if best and counts[best] >= 2 * n else None
    found = set()
    for word, n in counts.items():
        root = word
        while forms[root]:
            root = forms[root]
        form = forms[word]
        found.add((word, form, root, n, len(near[word]), counts[form] if form else None))
    return found


def columns(frame):
    return [tuple(row) for row in frame.select("word", "form", "root", "n", "n_near", "form_n").collect()]


def test_whole_table(spark):
    texts = duckdb.sql(f"SELECT doc_id, text FROM '{SMALL}/documents.parquet'").fetchall()
    got = columns(queries.op13_spelling_variants(spark, SMALL))
    assert len(got) == len(set(got))
    assert set(got) == expected(counted(texts, 97))
    assert any(row[2] != row[0] for row in got)


def test_edits_anywhere(spark):
    """Each edit at each place of words with few and repeated bigrams; chains of forms."""
    words = ["aaaaaa", "ababab", "abcde", "ababcabab", "étését", "zzzzzzzzzy"]
    rows = [(0, f"{w} " * 48) for w in words]
    for k, word in enumerate(words):
        for i in range(len(word)):
            edits = [word[:i] + word[i + 1 :], word[:i] + "q" + word[i:], word[:i] + "q" + word[i + 1 :]]
            rows += [(k, f"{x} " * (3 + i)) for x in edits]
        rows += [(k, f"{word}xy " * 4), (k, f"{word}x " * 9)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert set(columns(variants.grouped(frame, Tables(spark, "t")))) == expected(counted(rows))


def test_pivots_are_disjoint_and_cheapest():
    words = ["aaaaa", "abcabc", "abcdefgh", "banana", "mississippi"]
    grams = Counter(w[i : i + 2] for w in words for i in range(len(w) - 1))
    order = {g: (rank, n) for rank, (n, g) in enumerate(sorted((n, g) for g, n in grams.items()))}
    for word in words:
        places, tied, last = variants.prefix(word, order)
        assert len(places) == 3 and len(tied) <= 2
        assert last == max(order[word[i : i + 2]][0] for i in places)

        def cost(pair):
            return sum(order[word[i : i + 2]][1] for i in pair)

        disjoint = [x for x in combinations(places, 2) if x[1] - x[0] >= 2]
        chosen = variants.pivots(word, places, order)
        assert tuple(chosen) in disjoint
        assert cost(chosen) == min(map(cost, disjoint))


def test_awkward_rows(spark):
    long = "ab" * 20_000
    rows = [
        (1, "Colour colour COLOUR color color color colour colour colour", "a", 0),
        (1, "Colour colour COLOUR color color color colour colour colour", "a", 0),
        (None, f"{long} {long} {long}x", "b", 1),
        (None, f"{long}x {long}x {long}", "b", 1),
        (2, None, None, None),
        (3, "", "c", 2),
        (4, "abcde-abcde_abcde1abcde ×÷×÷× " * 3, "d", 3),
    ]
    frame = spark.createDataFrame(rows, "doc_id long, text string, word string, n int")
    got = columns(variants.grouped(frame, Tables(spark, "t")))
    assert set(got) == expected(counted([row[:2] for row in rows]))
    assert ("color", "colour", "colour", 6, 1, 12) in got
    assert any(row[4] == 1 and len(row[0]) == 40_000 for row in got)
    assert variants.grouped(frame.limit(0), Tables(spark, "t")).collect() == []


@pytest.mark.parametrize("planted", [1, 2])
def test_planted_letters(spark, planted):
    rows = [(i, "Sentence with some longer words, Étude and étude") for i in range(20)] + [(None, "words " * 9)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = {row["word"]: row["n"] for row in variants.vocabulary(frame, planted).collect()}
    assert got == counted(rows, planted)
