"""Text with quoted line breaks by byte ranges, against Spark's own reader of whole files."""

import csv
import io
import random

import pytest
from pyspark.sql.types import StructType

import __spark_entry__ as contract
from ledgerstar.sinks import files as sinks
from ledgerstar.sources import files as sources
from ledgerstar.sources import quoted

SCHEMA = StructType().add("k", "long").add("a", "string").add("b", "string").add("d", "date")
PIECES = ["x", '"', "\n", ",", "\r\n", "é", " ", '""', "\n\n", "long " * 9, ""]


def text_of(rows, header="k,a,b,d"):
    out = io.StringIO()
    writer = csv.writer(out, lineterminator="\n")
    writer.writerows(rows)
    return f"{header}\n{out.getvalue()}"


def made(seed, n):
    rng = random.Random(seed)
    return [
        (i, *("".join(rng.choices(PIECES, k=rng.randint(0, 6))) for _ in range(2)), f"2024-01-{i % 28 + 1:02}")
        for i in range(n)
    ]


def rows(frame):
    return sorted(map(tuple, frame.collect()), key=str)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 50, 1000, 10**6])
@pytest.mark.parametrize("chunk", [1, 5, 64, 8 << 20])
def test_ranges_give_each_record_once(monkeypatch, size, chunk):
    monkeypatch.setattr(quoted, "CHUNK", chunk)
    data = text_of(made(size, 12)).encode().rstrip(b"\n")  # the last record has no line feed
    expected, quotes, begin = [], 0, 0
    for i, byte in enumerate(data + b"\n"):
        quotes += byte == quoted.QUOTE
        if byte == quoted.NEWLINE and quotes % 2 == 0:
            expected.append(data[begin:i].decode())
            begin = i + 1
    expected = [x for x in expected if x]
    got, before = [], 0
    for start in range(0, len(data), size):
        end = min(start + size, len(data))
        for batch in quoted.records(io.BytesIO(data), start, end, before % 2 == 1):
            got += batch.to_pylist()
        n, *ways = quoted.count(io.BytesIO(data), start, end)
        assert n == data[start:end].count(b'"')
        assert ways[before % 2]
        before += n
    assert got == expected


@pytest.mark.parametrize(
    "text, fits",
    [
        ('a,"b"\n', True), ('"a\nb",""\n', True), ('a,""""\n', True), ('"a""\n""b"', True), ("", True),
        ('a,5" pipe\n', False), ('a,"b" c\n', False), ('a, "b"\n', False), ('"a\r\n"\r\n', True),
    ],
)
@pytest.mark.parametrize("chunk", [1, 3, 100])
def test_quotes_out_of_place(monkeypatch, text, fits, chunk):
    monkeypatch.setattr(quoted, "CHUNK", chunk)
    assert quoted.count(io.BytesIO(text.encode()), 0, len(text))[1] == fits


@pytest.mark.parametrize("range_bytes", [20, 333, 1 << 20])
def test_equals_spark_reader(spark, tmp_path, range_bytes):
    for i in range(3):
        (tmp_path / f"part{i}.csv").write_text(text_of(made(i, 60)), newline="")
    (tmp_path / "_SUCCESS").write_text("")
    (tmp_path / "empty.csv").write_text("")
    whole = sources.read_csv(spark, str(tmp_path), SCHEMA, multi_line=True, keep_corrupt=True, range_bytes=0)
    split = sources.read_csv(spark, str(tmp_path), SCHEMA, multi_line=True, keep_corrupt=True, range_bytes=range_bytes)
    assert split.schema == whole.schema
    assert rows(split) == rows(whole)
    assert split.count() == 180


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    """Records longer than a range belong to the range they begin in."""
    path = tmp_path / "t.csv"
    path.write_text(text_of([(i, "line\n" * (5000 if i == 7 else 20), "b", "") for i in range(400)]), newline="")
    frame = sources.read_csv(spark, f"file:{path}", SCHEMA, multi_line=True, range_bytes=8_000)
    assert frame.rdd.getNumPartitions() >= 8
    assert {r["k"]: len(r["a"]) for r in frame.collect()} == {i: 25_000 if i == 7 else 100 for i in range(400)}


def test_irregular_files_are_read_whole(spark, tmp_path):
    (tmp_path / "good.csv").write_text(text_of(made(1, 30)), newline="")
    (tmp_path / "odd.csv").write_text('k,a,b,d\n1,5" pipe,x,\n2,6" pipe,y,\n3,7" pipe,z,\n')
    whole = sources.read_csv(spark, str(tmp_path), SCHEMA, multi_line=True, range_bytes=0)
    split = sources.read_csv(spark, str(tmp_path), SCHEMA, multi_line=True, range_bytes=50)
    assert rows(split) == rows(whole) and split.count() == 33


def test_malformed_cells_and_headers(spark, tmp_path):
    (tmp_path / "t.csv").write_text('k,a,b,d\nx,"two\nlines",b,2024-01-01\n2.0,a,b,never\n1.5,a,b,2024-01-01\n')
    kept = [
        rows(sources.read_csv(spark, str(tmp_path), SCHEMA, multi_line=True, keep_corrupt=True, range_bytes=size))
        for size in (0, 25)
    ]
    assert kept[0] == kept[1]
    assert sum(row[-1] is not None for row in kept[1]) == 3
    (tmp_path / "u.csv").write_text("k,b,a,d\n1,x,y,2024-01-01\n")
    with pytest.raises(ValueError, match="header"):
        sources.read_csv(spark, str(tmp_path), SCHEMA, multi_line=True)


def test_compressed_text_and_empty_folders(spark, tmp_path):
    frame = spark.createDataFrame([(1, "a\nb", "c", None)], SCHEMA)
    options = {"header": True, "escape": '"', "compression": "gzip"}
    frame.write.options(**options).csv(str(tmp_path / "z"))
    assert rows(sources.read_csv(spark, str(tmp_path / "z"), SCHEMA, multi_line=True)) == rows(frame)
    sinks.write_csv(frame.limit(0), str(tmp_path / "none"))
    assert sources.read_csv(spark, str(tmp_path / "none"), SCHEMA, multi_line=True).collect() == []


def test_texts_are_written_by_as_many_tasks_as_read_them(spark, tmp_path, monkeypatch):
    made = [(i, f"{i}\n\"x\", y", None, "s", i) for i in range(40)]
    table = spark.createDataFrame(made, "doc_id long, text string, lang string, source string, n_chars long")
    table.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    tasks, write = [], sinks.write_csv

    def noted(frame, path):
        tasks.append(frame.rdd.getNumPartitions())
        write(frame, path)

    monkeypatch.setattr(sinks, "write_csv", noted)
    got = contract.queries()["src_csv_multiline"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got)) == made
    assert tasks[0] > 1
