"""Spelling variants: words one edit apart, found by pivotal grams, and the forms they vary.

A word's bigrams are ordered from rare to common in the vocabulary. Its prefix is the first
``GRAM * EDITS + 1`` of them; among three places of bigrams two are always disjoint, and dynamic
programming takes the disjoint ones with the fewest words behind them as pivots. One edit spoils at most one of
two disjoint bigrams. So of two words one edit apart, the one whose prefix ends earlier in the order
has a pivot that the edit leaves whole, and that pivot lies in the other's prefix. Pivots are therefore joined
with prefixes, not grams with grams. Equal bigrams are ordered by place, and an edit makes or spoils
at most two: the indexed prefix goes on by up to two places that tie with its last one.

A pivot left whole has the edit on one side only, so its place counted from the other end is the same in
both words, and so are all letters up to that end. The key of the join is this place with those letters,
once for either end. Where they are fewer than ``STRONG``, half of the other letters join the key, the nearer or the
farther half of the word with the pivot: an edit leaves one of them whole. Keys are 61 bits of a
hash, and pairs that meet are verified by their edit distance.

No group is ever listed: a hot key is two sides of one join that adaptive execution may split. The only
table on the driver is that of bigrams, bounded by the square of the alphabet's 90 letters.

Defined results: a null text has no words; a null id counts as an empty one; repeated rows count again; words
without near words have no form and are their own root; an empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerstar.llm import words as W
from ledgerstar.llm.tables import Tables

EDITS = 1
GRAM = 2
LEAST_LETTERS = 5
LEAST_TIMES = 3
TIMES_MORE = 2  # a form occurs at least so many times as often as its variant
STRONG = 6  # letters that make a key on their own
PLANTED = 97
DISTINCT = 200_000  # words that a counting task holds before it emits them

# A-Z are lower-cased before; U+00C0 to U+00FF are the UTF-8 pairs of C3
RUNS = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")

KEYED = "word string, key long, pivot boolean, last int, letters int"


# Words -----------------------------------------------------------------------------------


def _misspelt(word: bytes, check: int) -> bytes:
    """The word without one of its letters."""
    letters = word.decode()
    at = check % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def _count(batches: Iterable[pa.RecordBatch], planted: int | None) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def emitted() -> pa.RecordBatch:
        found = pa.array(held.keys(), pa.binary()).cast(pa.string())
        batch = pa.RecordBatch.from_arrays([found, pa.array(held.values(), pa.int64())], names=["word", "n"])
        held.clear()
        return batch

    for part in W.groups(batches):
        for doc_id, text in zip(part.column("doc_id").to_pylist(), W.texts(part.column("text"))):
            found = Counter(RUNS.findall(text.translate(W.LOWER)))
            if planted:
                start = zlib.crc32(b"%s:" % str("" if doc_id is None else doc_id).encode())
                checks = [(word, zlib.crc32(word, start)) for word in found]
                moved = [(word, check) for word, check in checks if check % planted == 0]
                changed = [(_misspelt(word, check), found.pop(word)) for word, check in moved]
                for word, n in changed:
                    found[word] += n
            held.update(found)
        if len(held) > DISTINCT:
            yield emitted()
    yield emitted()


def vocabulary(documents: DataFrame, planted: int | None = None) -> DataFrame:
    """``(word, n)`` of words that are long and frequent enough.

    With ``planted``, a word loses a letter in the documents whose id makes its checksum a multiple of that.
    """
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return (
        texts.mapInArrow(lambda batches: _count(batches, planted), "word string, n long")
        .filter(F.char_length("word") >= LEAST_LETTERS)
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= LEAST_TIMES)
    )


# Grams -----------------------------------------------------------------------------------


def gram_order(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Rank and number of places of each bigram, from rare to common; at most 90 squared of them."""
    places = f"transform(sequence(1, char_length(word) - {GRAM - 1}), i -> substring(word, i, {GRAM}))"
    counted = words.select(F.explode(F.expr(places)).alias("gram")).groupBy("gram").count()
    ordered = sorted((row["count"], row["gram"]) for row in counted.collect())
    return {gram: (rank, n) for rank, (n, gram) in enumerate(ordered)}


def prefix(word: str, order: dict[str, tuple[int, int]]) -> tuple[list[int], list[int], int]:
    """Places of the rarest bigrams, those that tie behind them, and the rank they end with."""
    size = GRAM * EDITS + 1
    ranked = sorted((order[word[i : i + GRAM]][0], i) for i in range(len(word) - GRAM + 1))
    last = ranked[size - 1][0]
    tied = [i for rank, i in ranked[size : size + GRAM * EDITS] if rank == last]
    return sorted(i for _, i in ranked[:size]), tied, last


def pivots(word: str, places: list[int], order: dict[str, tuple[int, int]]) -> list[int]:
    """``EDITS + 1`` disjoint places of the lowest total count.

    ``best[k]`` is the cheapest choice of ``k`` grams among the places so far; a place that overlaps
    the one before may extend only choices made before that.
    """
    nothing: list[tuple[int, list[int]] | None] = [(0, [])] + [None] * (EDITS + 1)
    past = [(-GRAM, nothing)]
    for place in places:
        cost = order[word[place : place + GRAM]][1]
        free = next(best for at, best in reversed(past) if at + GRAM <= place)
        best = list(past[-1][1])
        for k in range(1, EDITS + 2):
            if free[k - 1] is not None:
                taken = free[k - 1][0] + cost, [*free[k - 1][1], place]
                best[k] = taken if best[k] is None else min(best[k], taken)
        past = [*past[-GRAM:], (place, best)]
    return past[-1][1][EDITS + 1][1]


PRIME, BASE, MIX = (1 << 61) - 1, 0x1F3D5B79A2C4E68F, 0x0B7E151628AED2A6
POWERS = [1]


def _hashes(letters: str) -> list[int]:
    """Hash of each beginning of the letters."""
    while len(POWERS) <= len(letters):
        POWERS.append(POWERS[-1] * BASE % PRIME)
    value, found = 0, [0]
    for x in letters:
        value = (value * BASE + ord(x) + 1) % PRIME
        found.append(value)
    return found


def word_keys(word: str, order: dict[str, tuple[int, int]]) -> tuple[list[tuple[int, bool]], int]:
    """Keys of a word's prefix, those of its pivots marked, and the rank where the prefix ends.

    A word that is one letter longer or shorter halves its letters elsewhere, so a word has the keys
    for all three; as a pivot, for its own length alone.
    """
    first, tied, last = prefix(word, order)
    chosen = pivots(word, first, order)
    n, found = len(word), []
    for end, letters in enumerate((word, word[::-1])):
        hashes = _hashes(letters)
        for place in [*first, *tied]:
            pivot = place in chosen
            known = (place if end == 0 else n - GRAM - place) + GRAM
            head = hashes[known] * MIX + 6 * known + end
            if known >= STRONG:
                found.append((head % PRIME, pivot))
                continue
            rest = n - known
            for near in {(rest + i) // 2 for i in (-EDITS, 0, EDITS)}:
                if 0 <= near <= rest:
                    whole = hashes[known + near] * MIX + 6 * known + 2 + end
                    found.append(((whole * MIX + near) % PRIME, pivot and near == rest // 2))
            for far in {(rest + i + 1) // 2 for i in (-EDITS, 0, EDITS)}:
                if 0 <= far <= rest:
                    tail = (hashes[n] - hashes[n - far] * POWERS[far]) % PRIME
                    found.append((((head + 4) * MIX + tail * BASE + far) % PRIME, pivot and far == (rest + 1) // 2))
    return found, last


def _keys(batches: Iterable[pa.RecordBatch], order: dict[str, tuple[int, int]]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 1000):
            rows = []
            for word in batch.column("word").slice(at, 1000).to_pylist():
                keys, last = word_keys(word, order)
                rows += [(word, key, pivot, last, len(word)) for key, pivot in keys]
            columns = list(zip(*rows)) or [()] * 5
            kinds = (pa.string(), pa.int64(), pa.bool_(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, kind) for x, kind in zip(columns, kinds)],
                names=["word", "key", "pivot", "last", "letters"],
            )


def near_pairs(words: DataFrame, tables: Tables) -> DataFrame:
    """``(word, near)``: all ordered pairs of words exactly one edit apart, each once."""
    order = gram_order(words)
    keyed = tables.save(words.select("word").mapInArrow(lambda batches: _keys(batches, order), KEYED), "keyed")
    other = keyed.filter("pivot").selectExpr(
        "word AS near", "key AS of_key", "last AS of_last", "letters AS of_letters"
    )
    met = F.expr(f"key = of_key AND of_last <= last AND abs(letters - of_letters) <= {EDITS} AND word != near")
    verified = F.levenshtein("word", "near", EDITS) == EDITS
    found = keyed.join(other, met).filter(verified).select(
        F.least("word", "near").alias("one"), F.greatest("word", "near").alias("other")
    )
    pairs = tables.save(found.distinct(), "pairs")
    return pairs.selectExpr("one AS word", "other AS near").unionByName(
        pairs.selectExpr("other AS word", "one AS near")
    )


# Forms -----------------------------------------------------------------------------------


def formed(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """``word, n, n_near, form, form_n``: the near word that occurs most often, if often enough.

    Only words that have a near one are counted again; the smallest struct is the largest ``n``, then the
    first word by code point.
    """
    counts = words.selectExpr("word AS of_word", "n AS of_n")
    best = (
        pairs.join(counts, F.expr("near = of_word"))
        .groupBy("word")
        .agg(F.count("*").alias("n_near"), F.min(F.expr("struct(-of_n AS negated, near)")).alias("best"))
        .withColumnRenamed("word", "of_word")
    )
    often = f"-best.negated >= {TIMES_MORE} * n"
    return words.join(best, F.expr("word = of_word"), "left").selectExpr(
        "word",
        "n",
        "coalesce(n_near, 0L) AS n_near",
        f"CASE WHEN {often} THEN best.near END AS form",
        f"CASE WHEN {often} THEN -best.negated END AS form_n",
    )


def rooted(forms: DataFrame, tables: Tables) -> DataFrame:
    """``forms`` with the last word that following forms leads to.

    A form occurs at least twice as often, so chains are short and have no cycle; each step doubles the part of
    a chain that is followed, and is a written table.
    """
    points = tables.save(forms.selectExpr("word AS at", "form AS to").filter("to IS NOT NULL"), "points0")
    turn = 0
    while True:
        turn += 1
        further = points.selectExpr("at AS of_at", "to AS of_to")
        points = tables.save(
            points.join(further, F.expr("to = of_at"), "left").selectExpr(
                "at", "coalesce(of_to, to) AS to", "of_to IS NOT NULL AS moved"
            ),
            f"points{turn}",
        )
        if points.filter("moved").isEmpty():
            break
        points = points.drop("moved")
    ends = points.selectExpr("at AS of_at", "to AS of_to")
    return forms.join(ends, F.expr("word = of_at"), "left").selectExpr(
        *forms.columns, "coalesce(of_to, word) AS root"
    )


def grouped(documents: DataFrame, tables: Tables, planted: int | None = None) -> DataFrame:
    """One row per word: ``word, n, n_near, form, form_n, root``."""
    words = tables.save(vocabulary(documents, planted), "words")
    forms = tables.save(formed(words, near_pairs(words, tables)), "forms")
    return rooted(forms, tables)
