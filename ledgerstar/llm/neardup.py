"""MinHash near-duplicates with sequential Bayesian verification.

Equal shingle sets are one class from the start. Bands of its MinHash signature file each class under
bucket keys. Candidates share a bucket; their
signatures are compared a batch at a time, and a pair is given up as soon as the posterior
probability that its similarity reaches the threshold falls below ``MISS``. Survivors are confirmed on the
full sets.

No bucket is expanded into all its pairs. First every member meets one center of its bucket, and
links are merged into components. Only members of different components that have not met that way are
then compared, in blocks of bounded size that hold signatures and sets and emit confirmed links alone, one
at most for two components. So a component is lost only with the chosen miss probability, and no rows of
pairs grow with the square of a group.

Defined results: a text without words has an empty set and is linked with nothing; a text with fewer
words than a shingle has its whole sequence as the only one; rows with a null id have no component and
are kept, unlinked; rows are classed by their text, so rows with equal ids may differ; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from ledgerstar.llm import words as W
from ledgerstar.llm.tables import Tables

WORDS_PER_SHINGLE = 5
PERCENT = 80  # similarity from which documents are linked
HASHES = 180
BATCH = 36  # signature values compared at a time
MISS = 1e-5  # chance to give up a pair exactly at the threshold
BLOCK = 2048  # members of a bucket on either side of one comparison
BLOCK_BYTES = 16 << 20  # of their sets

SIGNED = "doc_id long, print long, n_shingles long, rep long, bands array<bigint>, signature binary"
SETS = "rep long, shingles binary"


@lru_cache
def rows_per_band(percent: int) -> int:
    """The most signature values per band that miss a pair at the threshold once in a million."""
    return max(
        r for r in range(1, 13)
        if HASHES % r == 0 and (r == 1 or (1 - (percent / 100) ** r) ** (HASHES // r) <= 1e-6)
    )


@lru_cache
def least_matches(percent: int) -> tuple[int, ...]:
    """After each batch, the fewest equal values that keep a pair, for a uniform prior.

    With ``m`` of ``n`` values equal the posterior is Beta(m + 1, n - m + 1), and it exceeds ``t``
    with the probability that a binomial of ``n + 1`` trials at ``t`` is at most ``m``.
    """
    t, kept = percent / 100, []
    for n in range(BATCH, HASHES + 1, BATCH):
        chance, m = 0.0, 0
        while True:
            chance += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if chance >= MISS:
                break
            m += 1
        kept.append(m)
    return tuple(kept)


# Sets and signatures ------------------------------------------------------------------


def shingle_sets(documents: list[bytes], size: int, hashes: W.WordHashes) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    found, counts = W.split_all([x.translate(W.LOWER) for x in documents])
    flat = hashes.of(found)
    keys = flat
    for i in range(1, size):
        keys = W.chained(keys[: len(flat) - i], flat[i:]) if len(flat) > i else flat[:0]
    sets, at = [], 0
    for n in counts.tolist():
        if n >= size:
            sets.append(np.unique(keys[at : at + n - size + 1]))
        elif n:
            whole = flat[at : at + 1]
            for i in range(1, n):
                whole = W.chained(whole, flat[at + i : at + i + 1])
            sets.append(W.mixed(whole + np.uint64(n)))  # no shingle of full size
        else:
            sets.append(flat[:0])
        at += n
    return sets


def _multipliers() -> np.ndarray:
    steps = np.arange(1, HASHES + 1, dtype=np.uint64)
    return (W.mixed(steps) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def signature(shingles: np.ndarray, multipliers: np.ndarray) -> np.ndarray:
    """Smallest value of each of ``HASHES`` permutations of 32 bits, folded to 16 bits."""
    mixed = (W.mixed(shingles) >> np.uint64(32)).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(mixed), 1024):
        np.minimum(least, (mixed[at : at + 1024, None] * multipliers).min(0), out=least)
    return ((least * np.uint32(0x9E3779B1)) >> np.uint32(16)).astype(np.uint16)


def _rep(shingles: np.ndarray) -> int | None:
    """The class of a set: 64 bits of a digest."""
    return xxhash.xxh3_128_intdigest(shingles.tobytes()) % (1 << 64) - (1 << 63) if len(shingles) else None


def _band_keys(signed: np.ndarray, rows: int) -> list[int]:
    """Bucket keys; the lowest byte is the band."""
    found = enumerate(signed.reshape(-1, rows))
    return [(xxhash.xxh3_64_intdigest(x.tobytes()) & ~0xFF | band) - (1 << 63) for band, x in found]


def _sign(batches, size: int, rows: int) -> Iterator[pa.RecordBatch]:
    hashes, multipliers = W.WordHashes(), _multipliers()
    for part in W.groups(batches):
        sets = shingle_sets(W.texts(part.column("text")), size, hashes)
        signs = [signature(x, multipliers) if len(x) else None for x in sets]
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                part.column("print"),
                pa.array(map(len, sets), pa.int64()),
                pa.array(map(_rep, sets), pa.int64()),
                pa.array([None if x is None else _band_keys(x, rows) for x in signs], pa.list_(pa.int64())),
                pa.array([None if x is None else x.tobytes() for x in signs], pa.binary()),
            ],
            names=["doc_id", "print", "n_shingles", "rep", "bands", "signature"],
        )


def _sets(batches, size: int) -> Iterator[pa.RecordBatch]:
    """Sets of texts that come partitioned by id, each class once per task."""
    hashes, seen = W.WordHashes(), set()
    for part in W.groups(batches):
        new: dict[int | None, bytes] = {}
        for x in shingle_sets(W.texts(part.column("text")), size, hashes):
            rep = _rep(x)
            if rep not in seen:
                seen.add(rep)
                new[rep] = x.tobytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array(new.keys(), pa.int64()), pa.array(new.values(), pa.binary())], names=["rep", "shingles"]
        )


# Verification -------------------------------------------------------------------------


def _estimate(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    """Drop pairs that the posterior rules out, one batch of signature values after the other."""
    least = least_matches(percent)
    for batch in batches:
        if not batch.num_rows:
            continue
        left, right = (
            np.frombuffer(b"".join(batch.column(x).to_pylist()), np.uint16).reshape(-1, HASHES)
            for x in ("sign_a", "sign_b")
        )
        alive, equal = np.arange(len(left)), np.zeros(len(left), np.int64)
        for step, fewest in enumerate(least):
            part = slice(step * BATCH, (step + 1) * BATCH)
            equal[alive] += (left[alive, part] == right[alive, part]).sum(1)
            alive = alive[equal[alive] >= fewest]
        yield pa.RecordBatch.from_arrays(
            [batch.column(x).take(pa.array(alive)) for x in ("a", "b")], names=["a", "b"]
        )


def _confirm(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = [
            _linked(np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64), percent)
            for left, right in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist())
        ]
        keep = pa.array(good, pa.bool_())
        yield pa.RecordBatch.from_arrays(
            [batch.column(x).filter(keep) for x in ("a", "b")], names=["a", "b"]
        )


def _with(pairs: DataFrame, values: DataFrame, column: str, name: str) -> DataFrame:
    """``pairs`` with ``column`` of both sides, as ``name_a`` and ``name_b``."""
    for side in "ab":
        of = values.select(F.col("rep").alias("of"), F.col(column).alias(f"{name}_{side}"))
        pairs = pairs.join(of, F.col(side) == F.col("of")).drop("of")
    return pairs


def estimated(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    signed = _with(pairs, reps, "signature", "sign")
    return signed.mapInArrow(lambda batches: _estimate(batches, percent), "a long, b long")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    whole = _with(pairs, sets, "shingles", "set")
    return whole.mapInArrow(lambda batches: _confirm(batches, percent), "a long, b long")


def _linked(x: np.ndarray, y: np.ndarray, percent: int) -> bool:
    both = np.sort(np.concatenate([x, y]))
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(both) - shared)


def _compare(group: pd.DataFrame, percent: int, rows: int) -> pd.DataFrame:
    """Confirmed links of one block between different components.

    A pair is left to the first band that its signatures share. Components that a link has joined
    are not compared any further in the block, and likely pairs come first.
    """
    key, low, high = (int(group[x].iloc[0]) for x in ("key", "low", "high"))
    band = (key + (1 << 63)) & 0xFF
    group = group.sort_values("rep", ignore_index=True)
    signs = np.frombuffer(b"".join(group["signature"]), np.uint16).reshape(-1, HASHES)
    sets = [np.frombuffer(x, np.uint64) for x in group["shingles"]]
    reps, comps, block = (group[x].to_numpy() for x in ("rep", "comp", "block"))
    least, found = least_matches(percent), []
    joined: dict[int, int] = {}

    def root(comp: int) -> int:
        while comp in joined:
            comp = joined[comp]
        return comp

    for i in np.flatnonzero(block == low).tolist():
        others = np.flatnonzero((block == high) & (comps != comps[i]))
        if low == high:
            others = others[others > i]
        if not len(others):
            continue
        equal = signs[others] == signs[i]
        alive = np.ones(len(others), bool)
        for step, fewest in enumerate(least):
            alive &= equal[:, : (step + 1) * BATCH].sum(1) >= fewest
        alive &= equal.reshape(len(others), -1, rows).all(2).argmax(1) == band
        likely = others[alive][np.argsort(-equal[alive].sum(1), kind="stable")]
        for j in likely.tolist():
            one, other = root(comps[i]), root(comps[j])
            if one != other and _linked(sets[i], sets[j], percent):
                joined[max(one, other)] = min(one, other)
                found.append((reps[i], reps[j]))
    return pd.DataFrame(found, columns=["a", "b"], dtype="int64")


def across(
    members: DataFrame, reps: DataFrame, sets: DataFrame, comps: DataFrame, percent: int, rows: int
) -> DataFrame:
    """Links between components, from buckets where members have not met their like.

    ``members`` has ``(key, rep, center)`` of all buckets of two or more. Blocks are bounded in rows
    and in bytes of sets.
    """
    met = members.filter("rep != center")
    labelled = (
        met.join(comps, F.col("rep") == F.col("id"), "left")
        .join(sets.select(F.col("rep").alias("of"), F.octet_length("shingles").alias("bytes")), F.expr("rep = of"))
        .select("key", "rep", F.coalesce("comp", "rep").alias("comp"), "bytes")
    )
    open_keys = (
        labelled.groupBy("key")
        .agg(F.min("comp").alias("first"), F.max("comp").alias("last"), F.count("*").alias("n"), F.sum("bytes").alias("bytes"))
        .filter("first != last")
        .selectExpr(
            "key AS of_key", f"greatest(ceil(n / {BLOCK}), ceil(bytes / {BLOCK_BYTES})) AS blocks"
        )
    )
    whole = reps.select("rep", "signature").join(sets, "rep").withColumnRenamed("rep", "of")
    blocked = (
        labelled.drop("bytes")
        .join(open_keys, F.expr("key = of_key"))
        .withColumn("block", F.expr("pmod(xxhash64(rep), blocks)"))
        .withColumn("other", F.explode(F.expr("sequence(0L, blocks - 1)")))
        .join(whole, F.expr("rep = of"))
        .selectExpr(
            "key", "rep", "comp", "signature", "shingles", "block",
            "least(block, other) AS low", "greatest(block, other) AS high",
        )
    )
    return (
        blocked.groupBy("key", "low", "high")
        .applyInPandas(lambda group: _compare(group, percent, rows), "a long, b long")
        .distinct()
    )


# Components ---------------------------------------------------------------------------


def components(links: DataFrame, tables: Tables, label: str) -> DataFrame:
    """``(id, comp)``: the smallest id that each linked id reaches.

    Every id points to its smallest neighbour, pointers are followed to their ends, and links are
    drawn again between the ends, until none is left. Each step is a written table.
    """
    edges = tables.save(links.filter("a != b").distinct(), f"{label}_edges0")
    whole, turn = None, 0
    while not edges.isEmpty():
        both = edges.unionByName(edges.selectExpr("b AS a", "a AS b"))
        points = both.groupBy(F.col("a").alias("id")).agg(F.least("id", F.min("b")).alias("comp"))
        points = tables.save(points, f"{label}_points{turn}_0")
        jump = 0
        while True:
            further = points.selectExpr("id AS at", "comp AS to")
            jump += 1
            points = tables.save(
                points.join(further, F.col("comp") == F.col("at")).selectExpr("id", "to AS comp", "comp != to AS moved"),
                f"{label}_points{turn}_{jump}",
            )
            if points.filter("moved").isEmpty():
                break
            points = points.drop("moved")
        points = points.select("id", "comp")
        if whole is None:
            whole = points
        else:
            later = points.selectExpr("id AS at", "comp AS to")
            whole = tables.save(
                whole.join(later, F.col("comp") == F.col("at"), "left").selectExpr("id", "coalesce(to, comp) AS comp"),
                f"{label}_whole{turn}",
            )
        ends = [points.selectExpr(f"id AS at_{x}", f"comp AS to_{x}") for x in "ab"]
        turn += 1
        edges = tables.save(
            edges.join(ends[0], F.col("a") == F.col("at_a"))
            .join(ends[1], F.col("b") == F.col("at_b"))
            .selectExpr("to_a AS a", "to_b AS b")
            .filter("a != b")
            .distinct(),
            f"{label}_edges{turn}",
        )
    return tables.spark.createDataFrame([], "id long, comp long") if whole is None else whole


# The operator ---------------------------------------------------------------------------


def _print(text: Column) -> Column:
    """Tells the texts of rows that share an id apart."""
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


def linked(
    documents: DataFrame, tables: Tables, size: int = WORDS_PER_SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``."""
    return judged(documents, tables, size, percent).drop("print")


def judged(documents: DataFrame, tables: Tables, size: int, percent: int) -> DataFrame:
    """As :func:`linked`, with a ``print`` of each row's text."""
    rows = rows_per_band(percent)
    texts = documents.select(
        F.col("doc_id").cast("long"), F.col("text").cast("string"), _print(F.col("text")).alias("print")
    )
    signed = tables.save(texts.mapInArrow(lambda batches: _sign(batches, size, rows), SIGNED), "signed")
    classed = tables.save(signed.select("doc_id", "print", "n_shingles", "rep"), "classed")
    owner = tables.save(
        classed.filter("rep IS NOT NULL AND doc_id IS NOT NULL").groupBy("rep").agg(F.min("doc_id").alias("owner")),
        "owner",
    )
    reps = tables.save(
        signed.filter("rep IS NOT NULL AND doc_id IS NOT NULL")
        .select("rep", "bands", "signature")
        .dropDuplicates(["rep"]),
        "reps",
    )
    tables.drop("signed")
    filed = reps.select("rep", F.explode("bands").alias("key"))
    buckets = filed.groupBy("key").agg(F.min("rep").alias("center"), F.count("*").alias("n"))
    shared = tables.save(buckets.filter("n > 1").selectExpr("key AS of_key", "center"), "buckets")
    members = tables.save(
        filed.join(shared, F.expr("key = of_key")).select("key", "rep", "center"), "members"
    )
    mates = members.select(F.col("rep").alias("of")).distinct().join(owner, F.expr("of = rep")).select("owner")
    # partitioned by id, rows that repeat an id meet in one task
    sets = tables.save(
        texts.drop("print")
        .repartition("doc_id")
        .join(mates.distinct(), F.expr("doc_id = owner"), "left_semi")
        .mapInArrow(lambda batches: _sets(batches, size), SETS),
        "sets",
    )

    pairs = members.filter("rep != center").select(F.col("center").alias("a"), F.col("rep").alias("b")).distinct()
    links = tables.save(confirmed(estimated(pairs, reps, percent), sets, percent), "links0")
    comps = components(links, tables, "round0")
    more = tables.save(across(members, reps, sets, comps, percent, rows), "links1")
    comps = components(links.unionByName(more), tables, "round1")

    named = owner.join(comps, F.col("rep") == F.col("id"), "left").select(
        "rep", "owner", F.coalesce("comp", "rep").alias("comp")
    )
    smallest = named.groupBy("comp").agg(F.min("owner").alias("component_id"))
    verdicts = tables.save(
        named.join(smallest, "comp").select(F.col("rep").alias("of"), "component_id"), "verdicts"
    )
    return (
        classed.join(verdicts, F.expr("rep = of"), "left")
        .select(
            "doc_id",
            "print",
            "n_shingles",
            F.expr("CASE WHEN doc_id IS NOT NULL THEN coalesce(component_id, doc_id) END").alias("component_id"),
        )
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )


def dedup(
    documents: DataFrame, tables: Tables, size: int = WORDS_PER_SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """The documents without those that a smaller id of their component stands for.

    Each row goes or stays by its own text: where an id occurs with two texts, one may go alone.
    """
    gone = tables.save(
        judged(documents, tables, size, percent)
        .filter("NOT kept AND doc_id IS NOT NULL")
        .selectExpr("doc_id AS gone_id", "print AS gone_print")
        .distinct(),
        "gone",
    )
    rows = documents.select(
        F.struct("*").alias("doc"), F.col("doc_id").cast("long").alias("id"), _print(F.col("text")).alias("print")
    )
    met = (rows.id == gone.gone_id) & (rows.print == gone.gone_print)
    return rows.join(gone, met, "left_anti").select("doc.*")
