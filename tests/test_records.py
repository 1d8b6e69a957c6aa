"""Splitting inside of files whose values hold line breaks, against the reader that makes a file one task."""

import random

import numpy as np
import pytest

from wardlake.sources import readers, records
from workload.queries import QUERIES

PIECES = ["a", "é", ";", '"', '""', "\n", "\r\n", " ", "x;y", '"q"', "\n\n", "text ", "0"]


def csv_text(rng, rows, columns=3):
    """Records with awkward values, as a writer quotes them."""
    lines = [";".join(f"c{k}" for k in range(columns))]
    for n in range(rows):
        values = [str(n)]
        for _ in range(columns - 1):
            value = "".join(rng.choices(PIECES, k=rng.randrange(8)))
            if any(c in value for c in ';"\n\r') or rng.random() < 0.2:
                value = '"' + value.replace('"', '""') + '"'
            values.append(value)
        lines.append(";".join(values))
    return "\n".join(lines) + rng.choice(["", "\n"])


@pytest.fixture
def small_blocks(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "97")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


def one_task(spark, paths, encoding="UTF-8"):
    return spark.read.csv(paths, header=True, sep=";", quote='"', escape='"', multiLine=True, encoding=encoding)


@pytest.mark.parametrize("seed", range(6))
def test_equal_to_the_reader_of_whole_files(spark, tmp_path, small_blocks, seed):
    rng = random.Random(seed)
    encoding = ("UTF-8", "ISO-8859-1")[seed % 2]
    for name in "ab":
        (tmp_path / f"{name}.csv").write_bytes(csv_text(rng, 60).encode(encoding))
    long = '"' + 'line\n""x"";\n' * 40 + '"'  # over many blocks
    (tmp_path / "c.csv").write_bytes(f"c0;c1;c2\n1;{long};z\n2;{long};{long}\n3;x;y".encode(encoding))
    paths = [str(tmp_path / f"{n}.csv") for n in "abc"]
    got = readers.read_delimited(spark, paths, encoding=encoding, multiline=True, null_markers=(), position="at")
    want = {n: one_task(spark, p, encoding).collect() for n, p in zip("abc", paths)}
    rows = got.orderBy("at").collect()
    for name in "abc":
        assert [tuple(r)[:3] for r in rows if r["at"].file.endswith(f"{name}.csv")] == [tuple(r) for r in want[name]]


def test_odd_quotes(spark, tmp_path, small_blocks):
    text = 'k;v\n1;a"b\n2;"c"d;e\n3;"f" \n4; "g\n5;""\n6;"h\n\n";i\n\n7;j"\n8;"k""\nl"\n9;"open\nuntil the end'
    (tmp_path / "a.csv").write_text(text)
    got = readers.read_delimited(spark, str(tmp_path / "a.csv"), multiline=True, null_markers=())
    key = lambda r: r[0]
    assert sorted(map(tuple, got.collect()), key=key) == sorted(map(tuple, one_task(spark, str(tmp_path / "a.csv")).collect()), key=key)


def test_no_rows_and_byte_order_mark(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('nome;"te\nxto"\n'.encode("utf-8-sig"))
    df = readers.read_delimited(spark, str(tmp_path / "a.csv"), multiline=True)
    assert df.columns == ["nome", "te\nxto"] and df.count() == 0


def test_one_file_is_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "a.csv"
    with open(path, "w") as file:
        file.write("k;v\n")
        for k in range(40_000):
            file.write(f'{k};"text {k}\nwith ""quotes"";\n{"x" * (k % 90)}"\n')
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 18))
    try:
        df = readers.read_delimited(spark, str(path), multiline=True)
        from pyspark.sql import functions as F

        used = df.select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
        assert len(used) > 8 and max(r["count"] for r in used) < 8_000
        same = one_task(spark, str(path))
        assert df.exceptAll(same).isEmpty() and same.exceptAll(df).isEmpty()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_files_without_a_crossing_record_move_no_split(spark, tmp_path):
    """Split sizes follow the bytes of all files of a read, so a read of some of them would see other blocks."""
    (tmp_path / "a.csv").write_text("k;v\n" + "".join(f'{k};"{"line " * 9}\nend {k}"\n' for k in range(900)))
    (tmp_path / "b.csv").write_text("k;v\n" + "".join(f"{900 + k};{'x' * 50}\n" for k in range(900)))
    paths = [str(tmp_path / f"{n}.csv") for n in "ab"]
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        for parts in (5, 7, 11, 16):
            spark.conf.set("spark.sql.files.minPartitionNum", str(parts))
            got = readers.read_delimited(spark, paths, multiline=True)
            assert sorted(int(r.k) for r in got.collect()) == list(range(1800))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_blocks_that_change_between_the_passes(spark, tmp_path, monkeypatch):
    """Cores that come or go move the splits; the records are read again from the blocks there are."""
    (tmp_path / "a.csv").write_text("k;v\n" + "".join(f'{k};"{"line " * 9}\nend {k}"\n' for k in range(900)))
    parts, read = iter(("4", "9")), records._lines

    def changing(*args):
        spark.conf.set("spark.sql.files.minPartitionNum", next(parts, "9"))
        return read(*args)

    monkeypatch.setattr(records, "_lines", changing)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = readers.read_delimited(spark, str(tmp_path / "a.csv"), multiline=True)
        assert sorted(int(r.k) for r in got.collect()) == list(range(900))
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
        spark.conf.unset("spark.sql.files.minPartitionNum")


def test_texts_that_look_missing_come_back(spark, tmp_path):
    rows = [(1, "NA"), (2, "null"), (3, None), (4, "a\r\nb\n"), (5, "nan")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert sorted(map(tuple, QUERIES["q_csv_text_roundtrip"](spark, str(tmp_path)).collect())) == rows


def test_states_of_lines():
    rng = random.Random(1)
    for _ in range(300):
        n = rng.randrange(1, 12)
        flags = [(rng.random() < 0.4, rng.random() < 0.5) for _ in range(n)]
        for begin in (False, True):
            state, want = begin, []
            for outside, inside in flags:
                state = inside if state else outside
                want.append(state)
            made = records._states(np.array([f[0] for f in flags]), np.array([f[1] for f in flags]), begin)
            assert made.tolist() == want
