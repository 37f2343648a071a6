"""Packing documents into sequences by a configuration linear program.

Only the histogram of piece lengths matters, and it has at most ``CAPACITY`` entries whatever the
corpus. A configuration is a multiset of lengths that fits one sequence; the program asks for the fewest
configurations that cover the histogram. Multiplicative weights solve it: lengths that lag behind
become dearer, a knapsack by dynamic programming finds the dearest configuration, and that is used
for a while. Uses are rounded down to whole sequences, and what is left goes best-fit
into sequences by falling length, still by length and not by piece.

Pieces then find their places without meeting each other: a piece's rank among those of its length is
its rank in its task plus the number in earlier tasks, and the plan says which sequence and offset
that rank has.

Defined results: a null text is empty and takes the end id alone; documents longer than a sequence are cut
so that only their first piece is short; rows with equal ids are separate documents; an empty table gives
no piece.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ledgerstar.llm import tokens, words as W
from ledgerstar.llm.tables import Tables

CAPACITY = 1024
END = 2
ROUNDS = 600
RATE = 0.3  # how strongly a lag in coverage raises a price
POWER = 1.1  # prices start at the share of a sequence to this power: long pieces are harder to place

PIECES = (
    "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, task int, nth long"
)
PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary, sequence_id long, offset long"


class Config(NamedTuple):
    """``copies`` sequences that hold ``items``: pairs of a length and how often it occurs."""

    items: tuple[tuple[int, int], ...]
    copies: int


class Plan(NamedTuple):
    """Intervals of ranks, sorted by length and first rank, and where they go."""

    length: np.ndarray
    first: np.ndarray
    each: np.ndarray  # pieces of this length in one sequence
    sequence: np.ndarray
    offset: np.ndarray


# The plan, from the histogram -------------------------------------------------------


def dearest(price: np.ndarray, capacity: int) -> dict[int, int]:
    """The multiset of lengths of the highest total price that fits; ``price[0]`` is unused."""
    best = np.zeros(capacity + 1)
    taken = np.zeros(capacity + 1, np.int64)  # 0: leave one place empty
    for room in range(1, capacity + 1):
        values = best[room - 1 :: -1] + price[1 : room + 1]
        choice = int(np.argmax(values))
        if values[choice] > best[room - 1]:
            best[room], taken[room] = values[choice], choice + 1
        else:
            best[room] = best[room - 1]
    items: dict[int, int] = {}
    room = capacity
    while room:
        size = int(taken[room])
        if size:
            items[size] = items.get(size, 0) + 1
        room -= size or 1
    return items


def fractional(counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> dict[tuple, float]:
    """Uses of configurations that cover the histogram about evenly, by multiplicative weights."""
    sizes = np.flatnonzero(counts)
    cover = np.zeros(capacity + 1)
    uses: dict[tuple, float] = {}
    base = (np.arange(capacity + 1) / capacity) ** POWER
    price = np.full(capacity + 1, -1.0)
    for _ in range(rounds):
        open_sizes = sizes[cover[sizes] < 1]
        if not len(open_sizes):
            break
        lag = cover[open_sizes].mean() - cover[open_sizes]
        price[:] = -1
        price[open_sizes] = base[open_sizes] * np.exp(RATE * lag)
        items = dearest(price, capacity)
        use = min(counts[size] * (1 - cover[size]) / n for size, n in items.items())
        for size, n in items.items():
            cover[size] += use * n / counts[size]
        key = tuple(sorted(items.items(), reverse=True))
        uses[key] = uses.get(key, 0) + use
    return uses


def best_fit(left: np.ndarray, capacity: int) -> list[Config]:
    """Best fit by falling length, with all equal sequences handled at once."""
    rooms: dict[int, list[tuple[dict[int, int], int]]] = {}
    for size in np.flatnonzero(left)[::-1].tolist():
        n = int(left[size])
        while n:
            room = min((x for x in rooms if x >= size), default=None)
            if room is None:
                each = min(n, capacity // size)
                rooms.setdefault(capacity - each * size, []).append(({size: each}, n // each))
                n %= each
                continue
            held, copies = rooms[room].pop()
            if not rooms[room]:
                del rooms[room]
            each = min(n, room // size)
            used = min(copies, n // each)
            if copies > used:
                rooms.setdefault(room, []).append((held, copies - used))
            filled = {**held, size: held.get(size, 0) + each}
            rooms.setdefault(room - each * size, []).append((filled, used))
            n -= used * each
    return [
        Config(tuple(held.items()), copies) for groups in rooms.values() for held, copies in groups
    ]


def configurations(counts: np.ndarray, capacity: int, rounds: int = ROUNDS) -> list[Config]:
    """Whole configurations that hold every piece of the histogram exactly once."""
    left = counts.astype(np.int64).copy()
    chosen = []
    if left[capacity]:
        chosen.append(Config(((capacity, 1),), int(left[capacity])))
        left[capacity] = 0
    uses = fractional(left, capacity, rounds)
    for items, use in sorted(uses.items(), key=lambda x: -x[1]):
        copies = min(int(use), *(int(left[size]) // n for size, n in items))
        if copies > 0:
            chosen.append(Config(items, copies))
            for size, n in items:
                left[size] -= n * copies
    rounded = chosen + best_fit(left, capacity)
    # where few lengths leave the program no choice, rounding can lose to best fit alone
    return min(rounded, best_fit(counts, capacity), key=lambda x: sum(config.copies for config in x))


def plan_of(configs: list[Config]) -> Plan:
    """Ranks of each length dealt out to the configurations in turn."""
    rows, given, sequence = [], {}, 0
    for items, copies in configs:
        offset = 0
        for size, n in items:
            first = given.get(size, 0)
            rows.append((size, first, n, sequence, offset))
            given[size] = first + n * copies
            offset += n * size
        sequence += copies
    rows.sort()
    columns = np.array(rows, np.int64).reshape(-1, 5).T
    return Plan(*(np.ascontiguousarray(x) for x in columns))


# The pieces ---------------------------------------------------------------------------


def _cut(batches, path: str, pieces: str, end: int, capacity: int, keep_ids: bool) -> Iterator[pa.RecordBatch]:
    encoder, task = tokens.encoder(path, pieces), TaskContext.get().partitionId()
    seen = np.zeros(capacity + 1, np.int64)
    for part in W.groups(batches):
        ids, sizes = encoder.encode(W.texts(part.column("text")), end)
        data = ids.astype("<u4")
        n = -(-sizes // capacity)
        row = np.repeat(np.arange(len(sizes)), n)
        piece = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        head = (sizes - (n - 1) * capacity)[row]
        length = np.where(piece == 0, head, capacity)
        start = np.where(piece == 0, 0, head + (piece - 1) * capacity)
        at = (np.cumsum(sizes) - sizes)[row] + start
        # rank of each piece among those of its length in this task
        order = np.argsort(length, kind="stable")
        ordered = length[order]
        begins = np.flatnonzero(np.diff(ordered, prepend=-1))
        runs = np.diff(np.append(begins, len(ordered)))
        nth = np.empty(len(row), np.int64)
        nth[order] = np.arange(len(ordered)) - np.repeat(begins, runs) + seen[ordered]
        seen += np.bincount(length, minlength=capacity + 1)
        bounds = list(zip(at.tolist(), (at + length).tolist()))
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id").take(pa.array(row)),
                pa.array(piece.astype(np.int32)),
                pa.array(start),
                pa.array(length),
                pa.array([zlib.crc32(data[a:b]) for a, b in bounds], pa.int64()),
                pa.array([ids[a:b].astype("<u2").tobytes() if keep_ids else None for a, b in bounds], pa.binary()),
                pa.array(np.full(len(row), task, np.int32)),
                pa.array(nth),
            ],
            names=["doc_id", "piece", "start", "length", "ids_crc32", "ids", "task", "nth"],
        )


def _place(batches: Iterable[pa.RecordBatch], plan: Plan) -> Iterator[pa.RecordBatch]:
    span = int(plan.first.max(initial=0)) + 1
    keys = plan.length * span + plan.first
    for batch in batches:
        length, rank = (batch.column(x).to_numpy() for x in ("length", "rank"))
        row = np.searchsorted(keys, length * span + np.minimum(rank, span - 1), "right") - 1
        within = rank - plan.first[row]
        kept = [batch.column(x) for x in ("doc_id", "piece", "start", "length", "ids_crc32", "ids")]
        yield pa.RecordBatch.from_arrays(
            [
                *kept,
                pa.array(plan.sequence[row] + within // plan.each[row]),
                pa.array(plan.offset[row] + within % plan.each[row] * length),
            ],
            names=["doc_id", "piece", "start", "length", "ids_crc32", "ids", "sequence_id", "offset"],
        )


def pack(
    documents: DataFrame,
    tables: Tables,
    tokenizer: str,
    pieces: str = "spaced",
    end: int = END,
    capacity: int = CAPACITY,
    keep_ids: bool = True,
) -> DataFrame:
    """Every piece with its sequence and offset, and its ids (16 bits each) if ``keep_ids``."""
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    cut = rows.mapInArrow(
        lambda batches: _cut(batches, tokenizer, pieces, end, capacity, keep_ids), PIECES
    )
    cut = tables.save(cut, "pieces")
    per_task = tables.save(cut.groupBy("task", "length").agg(F.count("*").alias("n")), "lengths")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in per_task.groupBy("length").agg(F.sum("n")).collect():  # at most ``capacity`` rows
        counts[length] = n
    plan = plan_of(configurations(counts, capacity))
    before = per_task.selectExpr(
        "task AS of_task",
        "length AS of_length",
        "sum(n) OVER (PARTITION BY length ORDER BY task ROWS UNBOUNDED PRECEDING) - n AS before",
    )
    ranked = cut.join(before, F.expr("task = of_task AND length = of_length")).selectExpr(
        "doc_id", "piece", "start", "length", "ids_crc32", "ids", "before + nth AS rank"
    )
    shared = tables.spark.sparkContext.broadcast(plan)  # a row per length of each configuration
    return ranked.mapInArrow(lambda batches: _place(batches, shared.value), PLACED)


def sequences(packed: DataFrame) -> DataFrame:
    """The packed sequences: ``sequence_id``, and all its ids joined in order."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    joined = F.expr("aggregate(parts, X'', (all, part) -> concat(all, part.ids))")
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select("sequence_id", joined.alias("ids"))
