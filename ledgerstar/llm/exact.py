"""Exact deduplication of a new batch against an immutable snapshot.

Texts are equal when identical after deleting ASCII white space. A snapshot holds one row per
distinct text (its digest, its best document, its number of documents), and one static binary fuse
filter per bucket of digests. Duplicates inside the batch are grouped among themselves; the digests
left are screened by the filters, and only those that pass are joined with the snapshot's exact
buckets, where the bytes of both texts are compared.

Of equal texts the row with the most code points in the original text stays, then the smallest id.
Defined results: a null text counts as empty; a null id comes after all others; rows with equal ids
and equal texts share one verdict, and ``dedup`` keeps one of them: the one with the most code points, then the
greatest original text, and any of those that differ in other columns alone; an empty batch or snapshot is
screened like any other.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from ledgerstar.llm import fuse
from ledgerstar.llm.tables import Tables

WHITE = " \t\n\x0b\x0c\r"
DIGESTS_PER_FILTER = 20_000
LEAST_BUCKETS = 64

# Which part of a table counts as the earlier snapshot when it is deduplicated in itself
EARLIER = "pmod(xxhash64(doc_id), 2) = 0"

FILTERS = "bucket long, seed long, segment long, segments long, slots binary"
SCREENED = "digest string, best struct<n_chars:int,id:bigint>, n long, bucket long, maybe boolean"


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), WHITE, "")


def digested(documents: DataFrame, in_snapshot: Column, *extra: Column) -> DataFrame:
    """One row per document: id, digest, length and part, with any ``extra`` columns."""
    return documents.select(
        "doc_id",
        F.sha2(normalised(F.col("text")), 256).alias("digest"),
        F.char_length(F.coalesce("text", F.lit(""))).alias("n_chars"),
        F.coalesce(in_snapshot, F.lit(False)).alias("earlier"),
        *extra,
    )


def _keys(digests: pd.Series) -> np.ndarray:
    """The leading 64 bits of hexadecimal digests."""
    return np.fromiter((int(x[:16], 16) for x in digests), np.uint64, len(digests))


def _build(group: pd.DataFrame) -> pd.DataFrame:
    made = fuse.build(_keys(group["digest"]))
    return pd.DataFrame({
        "bucket": [group["bucket"].iloc[0]],
        "seed": [made.seed],
        "segment": [made.segment],
        "segments": [made.segments],
        "slots": [made.slots.tobytes()],
    })


def _screen(batch: pd.DataFrame, filters: pd.DataFrame) -> pd.DataFrame:
    maybe = np.zeros(len(batch), bool)
    for row in filters.itertuples():
        made = fuse.FuseFilter(row.seed, row.segment, row.segments, np.frombuffer(row.slots, np.uint8))
        maybe |= made.contains(_keys(batch["digest"]))
    return batch.assign(maybe=maybe)


def with_bucket(rows: DataFrame, buckets: int) -> DataFrame:
    """Digests are uniform, so buckets are of equal size whatever the copies."""
    return rows.withColumn("bucket", F.expr(f"CAST(conv(substr(digest, -8), 16, 10) AS BIGINT) % {buckets}"))


def build_filters(snapshot: DataFrame) -> DataFrame:
    """One filter per bucket of a snapshot's distinct digests."""
    return snapshot.select("digest", "bucket").groupBy("bucket").applyInPandas(_build, FILTERS)


def screen(batch: DataFrame, filters: DataFrame) -> DataFrame:
    """Distinct digests of a batch, each with the answer of its bucket's filter."""
    return batch.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInPandas(_screen, SCREENED)


def confirmed(positives: DataFrame, documents: DataFrame) -> DataFrame:
    """Digests whose best texts on both sides are equal byte by byte.

    ``positives`` has a digest with the best row of either side. Texts are fetched by digest and id,
    so that only those of best rows meet.
    """
    wanted = positives.select(
        "digest", F.explode(F.array(F.col("best.id"), F.col("old.id"))).alias("negated")
    ).selectExpr("digest AS of_digest", "-negated AS of_id")
    texts = documents.select(
        "doc_id",
        F.sha2(normalised(F.col("text")), 256).alias("digest"),
        normalised(F.col("text")).alias("bytes"),
    )
    met = (texts.digest == wanted.of_digest) & texts.doc_id.eqNullSafe(wanted.of_id)
    return (
        texts.join(wanted.distinct().hint("merge"), met)
        .groupBy("digest")
        .agg(F.min("bytes").alias("low"), F.max("bytes").alias("high"))
        .filter("low = high")
        .select("digest")
    )


def verdicts(documents: DataFrame, tables: Tables, in_snapshot: Column | None = None) -> DataFrame:
    """Per digest and part (``earlier`` or not): ``keep_id``, ``group_size``, and whether it is ``repeated``.

    Where it is not, one row alone has the id that stays in this part.
    ``in_snapshot`` tells which rows form the snapshot; the others are the new batch.
    """
    part = F.expr(EARLIER) if in_snapshot is None else in_snapshot
    rows = digested(documents, part)
    # Copies are merged before the shuffle: a text with a third of all rows is a row per task and id
    by_id = rows.groupBy("earlier", "digest", "doc_id").agg(F.max("n_chars").alias("n_chars"), F.count("*").alias("n"))
    # the smallest id is the largest negated one, so both orders are one maximum; null ids come last
    best = F.struct("n_chars", (-F.col("doc_id")).alias("id"))
    texts = tables.save(
        by_id.groupBy("earlier", "digest").agg(
            F.max(best).alias("best"), F.max_by(F.col("n"), best).alias("n_best"), F.sum("n").alias("n")
        ),
        "texts",
    )
    buckets = max(LEAST_BUCKETS, -(-texts.count() // DIGESTS_PER_FILTER))
    bucketed = with_bucket(texts.drop("n_best"), buckets)
    snapshot = bucketed.filter("earlier").drop("earlier")
    batch = bucketed.filter("NOT earlier").drop("earlier")
    filters = tables.save(build_filters(snapshot), "filters")

    screened = tables.save(screen(batch, filters), "screened")
    old = snapshot.select("digest", F.col("best").alias("old"), F.col("n").alias("old_n"))
    positives = tables.save(
        screened.filter("maybe").select("digest", "best", "n").join(old, "digest"), "positives"
    )
    same = tables.save(
        positives.join(confirmed(positives, documents), "digest", "left_semi").select(
            "digest",
            F.greatest("best", "old").alias("joint_best"),
            (F.col("n") + F.col("old_n")).alias("joint_n"),
            F.col("best.id").eqNullSafe(F.col("old.id")).alias("in_both"),
        ),
        "same",
    )
    return tables.save(
        texts.join(same, "digest", "left").select(
            "earlier",
            "digest",
            (-F.coalesce("joint_best", "best")["id"]).alias("keep_id"),
            F.coalesce("joint_n", "n").alias("group_size"),
            (F.coalesce("in_both", F.lit(False)) | (F.col("n_best") > 1)).alias("repeated"),
        ),
        "verdicts",
    )


def _with_verdicts(documents: DataFrame, found: DataFrame, *extra: Column) -> DataFrame:
    """The verdicts are a written table, so both sides of the join are shuffled for it alone, and
    adaptive execution may cut a digest with very many copies into several tasks.
    """
    found = found.withColumnsRenamed({"digest": "of_digest", "earlier": "of_part"})
    rows = digested(documents, F.expr(EARLIER), *extra)
    met = (rows.digest == found.of_digest) & (rows.earlier == found.of_part)
    return rows.join(found, met).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id")))


def judged(documents: DataFrame, tables: Tables, *extra: Column) -> DataFrame:
    """Every document with its verdict, dropped ones too."""
    return _with_verdicts(documents, verdicts(documents, tables), *extra)


def dedup(documents: DataFrame, tables: Tables) -> DataFrame:
    """The documents that stay, with all their columns; one row of each text.

    Rows with the id that stays are told apart only for texts where it is repeated: those rows are written, and
    reduced in their tasks before they are shuffled, however many there are.
    """
    found = verdicts(documents, tables)
    doc = F.struct("*").alias("doc")
    if found.filter("repeated").isEmpty():
        return _with_verdicts(documents, found, doc).filter("kept").select("doc.*")
    once = _with_verdicts(documents, found.filter("NOT repeated"), doc).filter("kept").select("doc.*")
    rows = tables.save(
        _with_verdicts(documents, found.filter("repeated"), doc).filter("kept").select("digest", "n_chars", "doc"),
        "repeated",
    )
    longest = F.max_by("doc", F.struct("n_chars", "doc.text")).alias("doc")
    return once.unionByName(rows.groupBy("digest").agg(longest).select("doc.*"))
