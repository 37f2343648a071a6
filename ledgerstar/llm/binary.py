"""Token ids in binary shards, with Elias-Fano coded document boundaries.

Documents are range partitioned and sorted by id, and each task writes its run as shards: the ids of
consecutive documents as one array of little-endian 16-bit integers, and where each document ends,
coded by Elias-Fano, whose select gives any boundary without a table of 64-bit offsets. Shards are
rows of Parquet files, so any store that Spark writes to will do. A shard's place in the whole
corpus is the number of ids before it; it is summed over the tasks, then within a task.

Defined results: a null text is encoded as empty and has the end id alone; null ids come first;
rows with equal ids follow each other, ordered by a hash of their text; an empty table gives an
empty corpus; a text of any length is one document, whole, in one shard.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerstar.llm import tokens, words as W
from ledgerstar.llm.eliasfano import EliasFano

END = 1
SHARD_IDS = 2_000_000
PARTITION_BYTES = 32 << 20  # of text per task, about

SHARDS = "task int, shard int, n_ids long, doc_ids array<bigint>, ends binary, ids binary"
READ = "task int, shard int, doc_id long, within long, n_tokens long, ids_crc32 long"


def _shards(batches, path: str, pieces: str, end: int) -> Iterator[pa.RecordBatch]:
    encoder, task, shard = tokens.encoder(path, pieces), TaskContext.get().partitionId(), 0
    names: list[int | None] = []
    arrays: list[np.ndarray] = []

    def written():
        ends = np.cumsum([len(x) for x in arrays], dtype=np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([task], pa.int32()),
                pa.array([shard], pa.int32()),
                pa.array([int(ends[-1])], pa.int64()),
                pa.array([names], pa.list_(pa.int64())),
                pa.array([EliasFano.encode(ends).to_bytes()], pa.binary()),
                pa.array([np.concatenate(arrays).astype("<u2").tobytes()], pa.binary()),
            ],
            names=["task", "shard", "n_ids", "doc_ids", "ends", "ids"],
        )

    held = 0
    for part in W.groups(batches):
        found, sizes = encoder.encode(W.texts(part.column("text")), end)
        cut = np.split(found, np.cumsum(sizes)[:-1])
        for name, ids in zip(part.column("doc_id").to_pylist(), cut):
            names.append(name)
            arrays.append(ids)
            held += len(ids)
            if held >= SHARD_IDS:
                yield written()
                shard, held = shard + 1, 0
                names.clear()
                arrays.clear()
    if arrays:
        yield written()


def write(
    documents: DataFrame, folder: str, tokenizer: str, pieces: str = "words", end: int = END
) -> None:
    """Encode all documents into shards below ``folder``."""
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, -(-size // PARTITION_BYTES))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange(parts, F.asc_nulls_first("doc_id"), tie).sortWithinPartitions(
        F.asc_nulls_first("doc_id"), tie
    )
    shards = ordered.mapInArrow(lambda batches: _shards(batches, tokenizer, pieces, end), SHARDS)
    shards.write.parquet(folder)


def _read(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ends = EliasFano.from_bytes(row["ends"]).all()
            starts = np.concatenate([[0], ends[:-1]])
            ids = np.frombuffer(row["ids"], "<u2").astype("<u4")
            sums = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist())]
            n = len(ends)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(n, row["task"], np.int32)),
                    pa.array(np.full(n, row["shard"], np.int32)),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(starts, pa.int64()),
                    pa.array(ends - starts, pa.int64()),
                    pa.array(sums, pa.int64()),
                ],
                names=["task", "shard", "doc_id", "within", "n_tokens", "ids_crc32"],
            )


def first_ids(shards: DataFrame) -> DataFrame:
    """``(of_task, of_shard, first)``: the number of ids before each shard.

    The window without a partition runs over one row per writing task.
    """
    before = (
        shards.groupBy("task")
        .agg(F.sum("n_ids").alias("n"))
        .selectExpr("task", "sum(n) OVER (ORDER BY task ROWS UNBOUNDED PRECEDING) - n AS before")
    )
    within = shards.selectExpr(
        "task", "shard", "sum(n_ids) OVER (PARTITION BY task ORDER BY shard) - n_ids AS within"
    )
    return within.join(before, "task").selectExpr(
        "task AS of_task", "shard AS of_shard", "before + within AS first"
    )


def read(spark: SparkSession, folder: str) -> DataFrame:
    """Where each document lies in the corpus, and the checksum of its ids, from the files.

    Shards are decoded where they lie; only a short row per document meets the shards' places.
    """
    shards = spark.read.schema(SHARDS).parquet(folder)
    documents = shards.select("task", "shard", "doc_ids", "ends", "ids").mapInArrow(_read, READ)
    return documents.join(first_ids(shards), F.expr("task = of_task AND shard = of_shard")).selectExpr(
        "doc_id", "first + within AS start", "n_tokens", "ids_crc32"
    )
