"""Scoring texts with a weighted backoff automaton of smoothed n-grams.

Training counts are taken over all texts that are not held out. With ``c`` the count of a sequence and
``w`` after context ``h``, hierarchical Dirichlet smoothing gives

    P(w | h) = (c(hw) + PRIOR * P(w | h')) / (c(h) + PRIOR),    h' = h without its first word,

down to ``P(w) = (c(w) + 1) / (N + V + 1)``; each order adds up to one. As an automaton, every context seen
in training is a state, every n-gram seen is an arc with its probability to the longest state that ends it, and
the failure arc from ``h`` to ``h'`` carries the weight ``PRIOR / (c(h) + PRIOR)``. A text is read once from left
to right: a word without an arc takes the failure arcs to a state that has one, and logarithms add up.

The automaton grows with the corpus and is never in one place. Texts are written as blocks of
bounded size; a block asks for the counts of exactly the n-grams it contains, its own training counts being
part of the question. Questions are grouped by ranges of the n-gram hash, answered there, and sent back to
their blocks, each of which then holds the part of the automaton that its texts can reach. Counts
are exact but for collisions of 64-bit hashes.

Defined results: a null text is empty and has only the end; a null id counts as training; repeated rows
count as often as they appear; without training texts N and V are 0; an empty table gives an empty
result; a text of any length lies whole in one block.
"""

from __future__ import annotations

import math
from array import array
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from ledgerstar.llm import words as W
from ledgerstar.llm.tables import Tables

ORDER = 3
PRIOR = 4.0
BLOCK_WORDS = 2_000_000
RANGE_KEYS = 1_500_000  # questions answered in one group, at most on average
HELD_OUT = "pmod(crc32(CAST(doc_id AS STRING)), 7) = 2"

# The mark before the first word, which is context only, and the one after the last
BEGIN, END = 0, 1

BLOCKS = "block long, doc_ids array<bigint>, held binary, sizes binary, vocabulary binary, words binary, n_keys long"
QUESTIONS = "range long, block long, keys binary, counts binary, n long"
ANSWERS = "block long, range long, counts binary, known long, seen long"
SCORES = (
    "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
    "base_score double, score double"
)


# Blocks --------------------------------------------------------------------------------


def _blocks(batches: Iterable[pa.RecordBatch], order: int) -> Iterator[pa.RecordBatch]:
    hashes, block = W.WordHashes(), TaskContext.get().partitionId() << 32
    ids: list = []
    held: list = []
    sizes: list[np.ndarray] = []
    streams: list[np.ndarray] = []

    def written():
        stream, lengths = np.concatenate(streams), np.concatenate(sizes)
        vocabulary, words, times = np.unique(stream, return_inverse=True, return_counts=True)
        # frequent words get small numbers, which pack well
        rank = np.empty(len(vocabulary), np.int32)
        rank[np.argsort(-times, kind="stable")] = np.arange(len(vocabulary), dtype=np.int32)
        ordered = np.empty_like(vocabulary)
        ordered[rank] = vocabulary
        words = rank[words].astype(np.uint32)
        n_keys = len(ordered) + (order - 1) * len(words)  # at most; half of them or so are distinct
        return pa.RecordBatch.from_arrays(
            [
                pa.array([block], pa.int64()),
                pa.array([ids], pa.list_(pa.int64())),
                pa.array([np.array(held, np.uint8).tobytes()], pa.binary()),
                pa.array([lengths.tobytes()], pa.binary()),
                pa.array([ordered.tobytes()], pa.binary()),
                pa.array([W.packed(words)], pa.binary()),
                pa.array([n_keys], pa.int64()),
            ],
            names=["block", "doc_ids", "held", "sizes", "vocabulary", "words", "n_keys"],
        )

    for part in W.groups(batches):
        found, counts = W.split_all([x.translate(W.LOWER) for x in W.texts(part.column("text"))])
        keys = np.maximum(hashes.of(found), np.uint64(2))
        ids += part.column("doc_id").to_pylist()
        held += part.column("held").to_pylist()
        sizes.append(counts)
        streams.append(keys)
        if sum(map(len, streams)) >= BLOCK_WORDS:
            yield written()
            block += 1
            for x in (ids, held, sizes, streams):
                x.clear()
    if ids:
        yield written()


def _marked(words: np.ndarray, sizes: np.ndarray, vocabulary: np.ndarray):
    """The stream with both marks, the vocabulary with them, and each place within its text.

    The marks take the numbers 0 and 1, and words follow.
    """
    starts = np.cumsum(sizes + 2) - sizes - 2
    place = np.arange(int((sizes + 2).sum()), dtype=np.int32) - np.repeat(starts.astype(np.int32), sizes + 2)
    stream = np.full(len(place), -1, np.int32)
    stream[starts], stream[starts + sizes + 1] = BEGIN, END
    stream[stream < 0] = words.astype(np.int32) + 2
    return stream, np.concatenate([np.array([BEGIN, END], np.uint64), vocabulary]), place


def _grams(vocabulary, words, sizes, order) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per order: hashes of the distinct n-grams, and the number of each place's.

    Places without an n-gram of that order have -1.
    """
    stream, vocabulary, place = _marked(words, sizes, vocabulary)
    number = stream
    yield vocabulary, number
    for size in range(2, order + 1):
        ends = np.flatnonzero(place >= size - 1)
        pair = number[ends - 1].astype(np.int64) * len(vocabulary) + stream[ends]
        distinct, which = np.unique(pair, return_inverse=True)
        del pair
        previous = hashed if size > 2 else W.chained(vocabulary, np.full(len(vocabulary), 1, np.uint64))
        hashed = W.chained(
            W.chained(previous[distinct // len(vocabulary)], vocabulary[distinct % len(vocabulary)]),
            np.uint64(size),
        )
        number = np.full(len(stream), -1, np.int32)
        number[ends] = which
        del previous, distinct, which, ends  # nothing but the result is held while that is used
        yield hashed, number


def _row_arrays(row):
    sizes = np.frombuffer(row["sizes"], np.int64)
    vocabulary = np.frombuffer(row["vocabulary"], np.uint64)
    held = np.frombuffer(row["held"], np.uint8).astype(bool)
    return sizes, vocabulary, held, W.unpacked(row["words"], np.uint32)


# Counts --------------------------------------------------------------------------------


def _questions(batches: Iterable[pa.RecordBatch], order: int, ranges: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            sizes, vocabulary, held, words = _row_arrays(row)
            training = np.repeat(~held, sizes + 2)
            for level, (keys, number) in enumerate(_grams(vocabulary, words, sizes, order)):
                counts = np.bincount(number[training & (number >= 0)], minlength=len(keys))
                by_key = np.argsort(keys)
                keys, counts = keys[by_key], counts[by_key]
                of = _range(keys, ranges)
                cuts = np.flatnonzero(np.diff(of, prepend=-1))
                for start, end in zip(cuts, np.append(cuts[1:], len(keys))):
                    gaps = np.diff(keys[start:end], prepend=np.uint64(0))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([int(of[start]) * order + level], pa.int64()),
                            pa.array([row["block"]], pa.int64()),
                            pa.array([W.packed(gaps)], pa.binary()),
                            pa.array([W.packed(counts[start:end].astype(np.uint32))], pa.binary()),
                            pa.array([end - start], pa.int64()),
                        ],
                        names=["range", "block", "keys", "counts", "n"],
                    )


def _range(keys: np.ndarray, ranges: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _answer(group: pd.DataFrame) -> pd.DataFrame:
    """Total count of every key asked for, returned in the order of each question."""
    keys = [np.cumsum(W.unpacked(x, np.uint64), dtype=np.uint64) for x in group["keys"]]
    counts = np.concatenate([W.unpacked(x, np.uint32) for x in group["counts"]])
    distinct, which = np.unique(np.concatenate(keys), return_inverse=True)
    totals = np.bincount(which, counts, len(distinct)).astype(np.int64)
    words = totals[distinct != BEGIN]
    bounds = np.cumsum([len(x) for x in keys])[:-1]
    known, seen = np.zeros((2, len(group)), np.int64)
    known[0], seen[0] = (words > 0).sum(), words.sum()  # of the whole group, said once
    return pd.DataFrame({
        "block": group["block"],
        "range": group["range"],
        "counts": [W.packed(x) for x in np.split(totals[which], bounds)],
        "known": known,
        "seen": seen,
    })


# The automaton of a block ----------------------------------------------------------------


class Automaton(NamedTuple):
    """States and arcs by number. State 0 is the empty context and has an arc for every word."""

    weight: array  # of each arc: log10 of the probability
    target: array
    fail: array  # of each state: the longest state that ends it, what going there costs, its words
    cost: array
    depth: array
    start: int  # the state before the first word of a text


def _automaton(levels: list[tuple[np.ndarray, np.ndarray]], n: int, v: int) -> tuple[Automaton, list[np.ndarray]]:
    """The automaton of a block's n-grams, and for each order the arc that a place's n-gram is.

    ``levels`` has for each order the training counts of its n-grams, and the n-gram that ends at each
    place, or -1. An arc is an n-gram seen: it leaves the state of all its words but the last. Places
    whose n-gram is no arc have -1.
    """
    weight, target, spelled = array("d"), array("i"), []
    fail, cost, depth = array("i", [0]), array("d", [0]), array("b", [0])
    for level, (counts, number) in enumerate(levels):
        if level:
            place = np.empty(len(counts), np.int64)
            ends = np.flatnonzero(number >= 0)
            place[number[ends]] = ends
            ending = last_number[place]
            before, shorter = last_counts[last_number[place - 1]], states[ending]
            prob = np.where(before > 0, (counts + PRIOR * prob[ending]) / (before + PRIOR), prob[ending])
            arcs = seen = (counts > 0) & (before > 0)
        else:
            prob = (counts + 1) / (n + v + 1)
            shorter, seen, arcs = np.zeros(len(counts), np.int64), counts > 0, np.ones(len(counts), bool)
        states = shorter.astype(np.intc)
        if level + 1 < len(levels):  # an n-gram seen is a state; for any other stands the longest that ends it
            states[seen] = np.arange(len(fail), len(fail) + seen.sum())
            fail.frombytes(shorter[seen].astype(np.intc).tobytes())
            cost.frombytes(np.log10(PRIOR / (counts[seen] + PRIOR)).tobytes())
            depth.frombytes(np.full(int(seen.sum()), level + 1, np.int8).tobytes())
        if not level:
            start = int(states[BEGIN])
        arc = np.full(len(counts) + 1, -1, np.int32)  # the last one for places without an n-gram
        arc[:-1][arcs] = np.arange(len(weight), len(weight) + arcs.sum(), dtype=np.int32)
        spelled.append(arc[number])
        weight.frombytes(np.log10(prob[arcs]).tobytes())
        target.frombytes(states[arcs].tobytes())
        last_number, last_counts = number, counts
    return Automaton(weight, target, fail, cost, depth, start), spelled


def _walked(automaton: Automaton, spelled: Iterable[tuple[int, ...]]) -> float:
    """What reading a text from left to right adds up to.

    ``spelled`` has for each word the arcs that it can be, by the number of words in the state they leave.
    """
    weight, target, fail, cost, depth, state = automaton
    total = 0.0
    for arcs in spelled:
        arc = arcs[depth[state]]
        while arc < 0:
            total += cost[state]
            state = fail[state]
            arc = arcs[depth[state]]
        total += weight[arc]
        state = target[arc]
    return total


def _score(blocks: pd.DataFrame, answers: pd.DataFrame, order: int, n: int, v: int) -> pd.DataFrame:
    row = blocks.iloc[0]
    sizes, vocabulary, held, words = _row_arrays(row)
    answers = answers.sort_values("range")
    counts = [[np.empty(0, np.int64)] for _ in range(order)]  # short texts may lack whole orders
    for at, found in zip(answers["range"], answers["counts"]):
        counts[at % order].append(W.unpacked(found, np.int64))

    levels = []
    for level, (keys, number) in enumerate(_grams(vocabulary, words, sizes, order)):
        total = np.empty(len(keys), np.int64)
        total[np.argsort(keys)] = np.concatenate(counts[level])
        counts[level] = []
        levels.append((total, number))
    automaton, spelled = _automaton(levels, n, v)
    token_count = levels[0][0][levels[0][1]]
    del levels
    starts = np.cumsum(sizes + 2) - sizes - 2
    texts = zip((starts + 1).tolist(), (starts + sizes + 2).tolist())
    counted = np.ones(len(token_count), bool)
    counted[starts] = False

    def summed(values):
        return np.add.reduceat(np.where(counted, values, 0), starts)

    return pd.DataFrame({
        "doc_id": pd.array(list(row["doc_ids"]), dtype="Int64"),
        "held_out": held,
        "n_tokens": sizes + 1,
        "n_known": summed((token_count > 0).astype(np.int64)),
        "train_tokens": n,
        "base_score": summed(np.log10((token_count + 1) / (n + v + 1))),
        "score": [_walked(automaton, zip(*(x[a:b].tolist() for x in spelled))) for a, b in texts],
    })


def scored(
    documents: DataFrame, tables: Tables, held_out: Column | None = None, order: int = ORDER
) -> DataFrame:
    """One row per document: its tokens, its unigram base score and its score by the automaton."""
    held = F.expr(HELD_OUT) if held_out is None else held_out
    rows = documents.select(
        F.col("doc_id").cast("long"),
        F.col("text").cast("string"),
        F.coalesce(held, F.lit(False)).alias("held"),
    )
    blocks = tables.save(rows.mapInArrow(lambda batches: _blocks(batches, order), BLOCKS), "blocks")
    n_blocks, asked = blocks.agg(F.count("*"), F.sum("n_keys")).first()
    ranges = max(16, math.ceil((asked or 0) / order / RANGE_KEYS))
    questions = blocks.select("block", "held", "sizes", "vocabulary", "words").mapInArrow(
        lambda batches: _questions(batches, order, ranges), QUESTIONS
    )
    # groups stay about equal as the corpus grows, so there are as many partitions as groups
    asked_of = questions.repartition(ranges * order, "range").groupBy("range")
    answers = tables.save(asked_of.applyInPandas(_answer, ANSWERS), "answers")
    v, n = answers.filter(f"range % {order} = 0").agg(F.sum("known"), F.sum("seen")).first()
    n, v = int(n or 0), int(v or 0)
    parts = max(1, n_blocks)
    told = answers.select("block", "range", "counts").repartition(parts, "block")
    return (
        blocks.drop("n_keys")
        .repartition(parts, "block")
        .groupBy("block")
        .cogroup(told.groupBy("block"))
        .applyInPandas(lambda x, y: _score(x, y, order, n, v), SCORES)
    )
