"""Mixing sources to target weights, as one join of documents with a rate per source.

Tokens are summed per source, each source gets a target and a repetition rate, and every document
is emitted ``floor(rate)`` times, plus once more with probability ``rate - floor(rate)``. The
chance is a hash of the document id and a seed, so that reruns agree.

Defined results: a null text has size 0; null is a source of its own; a source without words has
target and rate 0, so none of its documents is emitted; rows with equal ids share their chance; an
empty table gives an empty mix. A target never exceeds ``limit`` times its source's size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

WEIGHTS = (1, 2, 3)
LIMIT = 3
SEED = 20240601
SIZE = r"regexp_count(coalesce({text}, ''), '[^\\x20\\x09-\\x0D]+')"


def rates(
    sizes: DataFrame, weights: Sequence[int] = WEIGHTS, limit: int = LIMIT
) -> DataFrame:
    """Target and rate per source, from rows of ``(source, size)``.

    Sources in code point order take the weights in turn and share the total. Targets stop at
    ``limit`` times the source's size, and the excess is shared again by weight. That ends where
    every target is the smaller of its limit and one common level times its weight: order sources
    by limit over weight, and the level is fixed by the first source that the level does not lift
    above its limit. The windows run over one row per source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    cycle = ", ".join(map(str, weights))
    ordered = "(ORDER BY source_size / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)"
    return (
        totals.selectExpr(
            "source",
            "source_size",
            f"array({cycle})[int((row_number() OVER (ORDER BY source NULLS LAST) - 1)"
            f" % {len(weights)})] AS weight",
        )
        .selectExpr(
            "*",
            "sum(source_size) OVER () AS total",
            f"{limit} * (sum(source_size) OVER {ordered} - source_size) AS capped_before",
            f"sum(weight) OVER () - sum(weight) OVER {ordered} + weight AS weight_left",
        )
        .selectExpr("*", "(total - capped_before) / weight_left AS level")
        .selectExpr(
            "*",
            f"min(CASE WHEN level * weight <= {limit} * source_size"
            " THEN struct(source_size / weight AS rank, level) END) OVER () AS shared",
        )
        .selectExpr(
            "source",
            "source_size",
            f"CASE WHEN source_size = 0 THEN 0D ELSE least(double({limit} * source_size),"
            f" coalesce(shared.level * weight, double({limit} * source_size))) END AS target",
        )
        .withColumn("rate", F.expr("CASE WHEN source_size = 0 THEN 0D ELSE target / source_size END"))
    )


def copies(
    documents: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    limit: int = LIMIT,
    seed: int = SEED,
) -> DataFrame:
    """Each row of ``documents`` as ``doc``, with its size, its source's target, and ``copies``."""
    sized = documents.select(
        F.struct("*").alias("doc"), "source", F.expr(SIZE.format(text="text")).cast("long").alias("size")
    )
    per_source = rates(sized.select("source", "size"), weights, limit).withColumnRenamed(
        "source", "of_source"
    )
    # 52 bits of a digest as a fraction of one
    chance = f"conv(substr(md5(concat(coalesce(CAST(doc.doc_id AS STRING), ''), ':{seed}')), 1, 13), 16, 10) / 4503599627370496D"
    return sized.join(per_source, F.col("source").eqNullSafe(F.col("of_source"))).select(
        "doc",
        "size",
        "source_size",
        "target",
        F.expr(f"int(floor(rate)) + int({chance} < rate - floor(rate))").alias("copies"),
    )


def mix(
    documents: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    limit: int = LIMIT,
    seed: int = SEED,
) -> DataFrame:
    """The mixed corpus: rows of ``documents``, repeated or left out."""
    chosen = copies(documents, weights, limit, seed).filter("copies > 0")
    return chosen.select("doc", F.explode(F.expr("sequence(1, copies)"))).select("doc.*")
