"""Runs that readers see as a whole or not at all, and that rewrite only partitions which changed.

A run writes into a folder of its own below ``versions``. Its last act is a manifest in ``published``, put
there by one rename; the manifest with the highest number counts. Until then readers resolve the
run before, whose files nobody touches, so a run that breaks anywhere leaves the former tables complete.

A partitioned table may span the folders of several runs. The manifest lists, for each partition, the run
that wrote it and the fingerprint of its rows; a new run compares fingerprints, writes the partitions
that differ, and points to the others where they are. So partitions are replaced without being overwritten.
After ``MOST_FOLDERS`` such runs a table is written anew.

The manifest has a line per partition, and partitions are few by choice of their keys. One run at a time may
publish to a base; file systems whose rename refuses an existing target also tell a second one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ledgerstar.functions.fingerprint import MEASURES, fingerprint
from ledgerstar.scratch import located
from ledgerstar.sinks.files import write_parquet
from ledgerstar.sources.files import read_parquet

FORMAT = 1  # raise it when the same rows lead to other tables; all partitions are then written anew
MOST_FOLDERS = 30
VERSIONS, PUBLISHED = "versions", "published"


class PublishError(Exception):
    """Another run has published meanwhile."""


@dataclass(frozen=True)
class Part:
    """One partition of a table: its values, the run that wrote it, and its fingerprint."""

    values: tuple
    folder: str
    row_count: int
    hash_sum: str
    hash_xor: int

    @property
    def print(self) -> tuple[int, str, int]:
        return self.row_count, self.hash_sum, self.hash_xor


@dataclass
class Manifest:
    """What a run consists of. ``written`` counts the partitions of a table that each folder has held."""

    number: int
    folder: str
    types: dict[str, str] = field(default_factory=dict)
    parts: dict[str, list[Part]] = field(default_factory=dict)
    written: dict[str, dict[str, int]] = field(default_factory=dict)
    form: int = FORMAT

    def to_json(self) -> str:
        return json.dumps(asdict(self), indent=1)

    @classmethod
    def from_json(cls, text: str) -> Manifest:
        made = cls(**json.loads(text))
        made.parts = {
            name: [Part(**{**x, "values": tuple(x["values"])}) for x in parts] for name, parts in made.parts.items()
        }
        return made


# Manifests -------------------------------------------------------------------------------


def _numbers(spark: SparkSession, base: str) -> list[int]:
    path, system = located(spark, f"{base}/{PUBLISHED}")
    if not system.exists(path):
        return []
    names = [x.getPath().getName() for x in system.listStatus(path)]
    return sorted(int(x[: -len(".json")]) for x in names if x.endswith(".json") and not x.startswith("."))


def _manifest_path(base: str, number: int) -> str:
    return f"{base}/{PUBLISHED}/{number:08d}.json"


def load(spark: SparkSession, base: str, number: int | None = None) -> Manifest | None:
    """A published manifest, by default the latest; null where nothing has been published."""
    if number is None:
        numbers = _numbers(spark, base)
        if not numbers:
            return None
        number = numbers[-1]
    path, system = located(spark, _manifest_path(base, number))
    stream = system.open(path)
    try:
        return Manifest.from_json(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def start(spark: SparkSession, base: str) -> Manifest:
    """The manifest of a new run, with a folder that no run has used."""
    number = ([0] + _numbers(spark, base))[-1] + 1
    return Manifest(number, f"{number:08d}-{uuid.uuid4().hex}")


def publish(spark: SparkSession, base: str, manifest: Manifest) -> None:
    """Make a finished run the current one."""
    target, system = located(spark, _manifest_path(base, manifest.number))
    draft, _ = located(spark, f"{base}/{PUBLISHED}/.{manifest.folder}")
    system.mkdirs(target.getParent())
    stream = system.create(draft, False)
    try:
        stream.write(bytearray(manifest.to_json().encode()))
    finally:
        stream.close()
    if system.exists(target) or not system.rename(draft, target):
        system.delete(draft, False)
        raise PublishError(f"run {manifest.number} of {base} has been published by another")


def folder(base: str, manifest: Manifest) -> str:
    return f"{base}/{VERSIONS}/{manifest.folder}"


def exists(spark: SparkSession, path: str) -> bool:
    found, system = located(spark, path)
    return bool(system.exists(found))


def resolve(spark: SparkSession, base: str) -> str:
    """The folder of the current run; ``base`` itself where nothing has been published."""
    manifest = load(spark, base)
    return base if manifest is None else folder(base, manifest)


def expire(spark: SparkSession, base: str, keep: int = 2) -> list[str]:
    """Forget all but the last ``keep`` runs; returns the folders deleted.

    A folder goes when no manifest that is kept points to it. Those of broken runs go too, but none with a
    number above the last published one: such a run may be under way.
    """
    numbers = _numbers(spark, base)
    kept = [load(spark, base, number) for number in numbers[-keep:]]
    used = {x.folder for x in kept} | {p.folder for x in kept for parts in x.parts.values() for p in parts}
    for number in numbers[:-keep]:
        path, system = located(spark, _manifest_path(base, number))
        system.delete(path, False)
    path, system = located(spark, f"{base}/{VERSIONS}")
    gone = []
    for status in system.listStatus(path) if kept and system.exists(path) else []:
        name = status.getPath().getName()
        if name not in used and int(name.split("-")[0]) <= numbers[-1]:
            system.delete(status.getPath(), True)
            gone.append(name)
    return sorted(gone)


# Partitioned tables ------------------------------------------------------------------------


def _among(keys: Sequence[str], parts: Sequence[tuple]) -> F.Column:
    """Whether a row belongs to one of the partitions; null is a value like any other."""
    found = F.lit(False)
    for values in parts:
        test = F.lit(True)
        for key, value in zip(keys, values):
            test = test & F.col(key).eqNullSafe(F.lit(value))
        found = found | test
    return found


def _within(frame: DataFrame, keys: Sequence[str], parts: Sequence[tuple]) -> DataFrame:
    """Rows of some partitions. The list is broadcast: it has a row per partition."""
    kinds = ", ".join(f"of_{x} {frame.schema[x].dataType.simpleString()}" for x in keys)
    listed = frame.sparkSession.createDataFrame(list(parts), kinds)
    met = F.lit(True)
    for key in keys:
        met = met & frame[key].eqNullSafe(listed[f"of_{key}"])
    return frame.join(F.broadcast(listed), met, "left_semi")


def refresh(
    base: str,
    manifest: Manifest,
    previous: Manifest | None,
    name: str,
    frame: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    build: Callable[[DataFrame], DataFrame] = lambda frame: frame,
) -> int:
    """Write those partitions of table ``name`` whose rows in ``frame`` differ from the published ones.

    ``build`` makes the table's rows of the rows of ``frame``, and must keep ``keys``. Partitions that no row
    belongs to any more are left out of the manifest. Returns how many were written.
    """
    found = fingerprint(frame, columns, keys).collect()  # a row per partition
    fresh = {tuple(row[key] for key in keys): tuple(row[x] for x in MEASURES) for row in found}
    usable = previous is not None and previous.form == manifest.form and previous.types == manifest.types
    old = {x.values: x for x in previous.parts.get(name, [])} if usable else {}
    if len({x.folder for x in old.values()}) >= MOST_FOLDERS:
        old = {}
    changed = [values for values, print in fresh.items() if values not in old or old[values].print != print]
    if changed:
        rows = frame if len(changed) == len(fresh) else _within(frame, keys, changed)
        write_parquet(build(rows), f"{folder(base, manifest)}/{name}", tuple(keys))
    new = set(changed)
    manifest.parts[name] = [
        Part(values, manifest.folder if values in new else old[values].folder, *print)
        for values, print in fresh.items()
    ]
    used = {x.folder for x in manifest.parts[name]}
    before = previous.written.get(name, {}) if old else {}
    manifest.written[name] = {x: n for x, n in before.items() if x in used} | (
        {manifest.folder: len(changed)} if changed else {}
    )
    return len(changed)


def follow(
    base: str,
    manifest: Manifest,
    leader: str,
    name: str,
    keys: Sequence[str],
    fresh: DataFrame | None,
) -> None:
    """Write table ``name``, whose partitions depend on the same ones of ``leader`` alone.

    ``fresh`` has the rows of the partitions that :func:`refresh` has just written, if any.
    """
    if fresh is not None:
        write_parquet(fresh, f"{folder(base, manifest)}/{name}", tuple(keys))
    manifest.parts[name] = manifest.parts[leader]
    manifest.written[name] = manifest.written[leader]


def read(
    spark: SparkSession,
    base: str,
    manifest: Manifest,
    name: str,
    schema: StructType,
    keys: Sequence[str],
    only: str | None = None,
) -> DataFrame:
    """A partitioned table from all folders that hold parts of it; ``only`` names one of them.

    What other runs have replaced in a folder is left out by its partition values, so it is never opened.
    """
    by_folder: dict[str, list[tuple]] = {}
    for part in manifest.parts[name]:
        if only in (None, part.folder):
            by_folder.setdefault(part.folder, []).append(part.values)
    frames = []
    for where, parts in sorted(by_folder.items()):
        frame = read_parquet(spark, f"{base}/{VERSIONS}/{where}/{name}", schema)
        whole = len(parts) == manifest.written[name][where]
        frames.append(frame if whole else frame.filter(_among(keys, parts)))
    if not frames:
        return spark.createDataFrame([], schema)
    joined, *rest = frames
    for frame in rest:
        joined = joined.unionByName(frame)
    return joined
