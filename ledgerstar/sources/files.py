"""File sources. Schemas are declared, so no file is read to infer one."""

from __future__ import annotations

import csv
from collections.abc import Mapping
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DecimalType, IntegralType, StringType, StructField, StructType

from ledgerstar.schemas import FACT_PARTITIONS, STAR_TABLES, table_schemas
from ledgerstar.sources import quoted

if TYPE_CHECKING:
    from ledgerstar.sinks.versions import Manifest

CORRUPT = "_corrupt_record"

# Quotes are doubled inside quoted text, as spreadsheet tools and data-frame libraries do
CSV_OPTIONS = {"header": True, "escape": '"'}

# What whole numbers in CSV are parsed as; all of LONG and 18 decimals fit
WHOLE = DecimalType(38, 18)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType,
    multi_line: bool = False,
    keep_corrupt: bool = False,
    range_bytes: int = quoted.RANGE_BYTES,
) -> DataFrame:
    """CSV with a header. A cell that is empty, or does not fit its type, becomes null.

    Columns are read by position; a header that does not name them as the schema does is an
    error, rather than values in the wrong column.

    Whole numbers may be written with a zero fraction (``7.0``), as data-frame libraries do with
    a column that has nulls; any other fraction does not fit.

    With ``keep_corrupt`` the source line of each such row is kept in ``_corrupt_record`` (for a
    fraction or a number beyond its type, the line put together again); write that frame before
    looking for corrupt rows. ``multi_line`` allows line breaks inside quoted text, kept as they
    are; rows must then end in a plain line feed. Files are split into ranges of ``range_bytes`` all the
    same, by a pass over the quotes that runs at once, see :mod:`ledgerstar.sources.quoted`; zero
    leaves each file to one task.
    """
    whole = {f.name: f.dataType.simpleString() for f in schema if isinstance(f.dataType, IntegralType)}
    parsed = [StructField(f.name, WHOLE if f.name in whole else f.dataType) for f in schema]
    extra = [StructField(CORRUPT, StringType())] if keep_corrupt else []
    frame = _columns(spark, path, StructType(parsed + extra), multi_line, range_bytes)
    if not whole:
        return frame

    fitted = {
        name: f"CASE WHEN `{name}` % 1 = 0 THEN try_cast(`{name}` AS {kind}) END"
        for name, kind in whole.items()
    }
    columns = [F.expr(fitted.get(name, f"`{name}`")).alias(name) for name in schema.names]
    if keep_corrupt:
        lost = " OR ".join(f"(`{name}` IS NOT NULL AND {fit} IS NULL)" for name, fit in fitted.items())
        line = F.to_csv(F.struct(*schema.names))
        columns.append(F.coalesce(CORRUPT, F.when(F.expr(lost), line)).alias(CORRUPT))
    return frame.select(*columns)


def _columns(
    spark: SparkSession, path: str, schema: StructType, multi_line: bool, range_bytes: int
) -> DataFrame:
    """Parsed columns, of ranges where they may hold line breaks, else by Spark's reader."""
    found = quoted.files(path) if multi_line and range_bytes else None
    if not found:
        return _whole_files(spark, path, schema, multi_line)
    split = quoted.split(spark, found, range_bytes)
    names = [name for name in schema.names if name != CORRUPT]
    for header in split.headers:
        if [x.lower() for x in next(csv.reader([header.removeprefix("\ufeff").rstrip("\r")]))] != [x.lower() for x in names]:
            raise ValueError(f"CSV header does not conform to the schema: {header!r}, not {','.join(names)!r}")
    options = {"escape": CSV_OPTIONS["escape"], "columnNameOfCorruptRecord": CORRUPT}
    frame = quoted.parsed(spark, split.ranges, schema.toDDL(), options)
    if not split.irregular:
        return frame
    others = _whole_files(spark, split.irregular, schema, multi_line)
    return frame.unionByName(others) if split.ranges else others


def _whole_files(
    spark: SparkSession, path: str | list[str], schema: StructType, multi_line: bool
) -> DataFrame:
    reader = (
        spark.read.schema(schema)
        .options(**CSV_OPTIONS)
        .option("enforceSchema", False)
        .option("multiLine", multi_line)
        .option("columnNameOfCorruptRecord", CORRUPT)
    )
    if multi_line:
        reader = reader.option("lineSep", "\n")  # else the parser guesses, and changes \r\n inside text
    return reader.csv(path)


def corrupt_rows(kept: DataFrame) -> DataFrame:
    """Rows of which at least one cell did not fit its type."""
    return kept.filter(F.col(CORRUPT).isNotNull())


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    """Parquet, partitioned or not, in the column order of ``schema``.

    Partition columns come back last and typed by their text. With a schema they keep their
    declared type and place.
    """
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def load_star(
    spark: SparkSession, warehouse: str, schemas: Mapping[str, StructType] | None = None
) -> dict[str, DataFrame]:
    """The four tables of the star schema, by name; nothing is read until they are used.

    ``warehouse`` is a folder of the tables, or the base of published runs, of which the last one counts.
    """
    from ledgerstar.sinks import versions  # which reads by this module

    manifest = versions.load(spark, warehouse)
    if manifest is not None:
        return star_of(spark, warehouse, manifest, schemas or table_schemas(*manifest.types.values()))
    declared = table_schemas() if schemas is None else schemas
    return {
        name: read_parquet(spark, f"{warehouse}/{name}", declared[name]) for name in STAR_TABLES
    }


def star_of(
    spark: SparkSession, base: str, manifest: Manifest, schemas: Mapping[str, StructType]
) -> dict[str, DataFrame]:
    """The star schema of one run."""
    from ledgerstar.sinks import versions

    star = {}
    for name in STAR_TABLES:
        table = f"warehouse/{name}"
        if table in manifest.parts:
            star[name] = versions.read(spark, base, manifest, table, schemas[name], FACT_PARTITIONS)
        else:
            star[name] = read_parquet(spark, f"{versions.folder(base, manifest)}/{table}", schemas[name])
    return star


def register_views(tables: Mapping[str, DataFrame]) -> None:
    """Make tables available to SQL text under their names."""
    for name, frame in tables.items():
        frame.createOrReplaceTempView(name)
