"""Sources, sinks and loads on small files."""

import datetime
import hashlib
import json
import subprocess
import sys
from pathlib import Path
from types import SimpleNamespace

import pandas as pd
import pytest
from pyspark.sql import functions as F

from wardlake.sources import files as files_module
from wardlake.sources import readers, writers
from wardlake.sources.storage import publish, shared_dir
from workload.queries import QUERIES


def test_delimited_with_byte_order_mark(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_bytes("nome;idade\nJoão;1\n;2\n".encode("utf-8-sig"))
    df = readers.read_delimited(spark, str(path))
    assert df.columns == ["nome", "idade"]
    assert [tuple(r) for r in df.collect()] == [("João", "1"), (None, "2")]


def test_position_follows_the_files(spark, tmp_path):
    for name, values in (("a", (3, 1)), ("b", (2, 9))):
        (tmp_path / f"{name}.csv").write_text("x\n" + "\n".join(map(str, values)) + "\n")
    df = readers.read_delimited(spark, [str(tmp_path / "b.csv"), str(tmp_path / "a.csv")], position="pos")
    assert [r.x for r in df.orderBy("pos").collect()] == ["3", "1", "2", "9"]


def test_mixed_files_align_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes("nome;cidade\nJosé;Natal\n".encode("latin-1"))
    (tmp_path / "b.csv").write_bytes("cidade;nome;extra\nMossoró;Ana;x\n".encode("latin-1"))
    (tmp_path / "c.csv").write_bytes("nome;cidade\nCaio;Acari\n".encode("latin-1"))
    df = readers.read_delimited_dir(spark, str(tmp_path / "*.csv"), encoding="ISO-8859-1")
    assert sorted(tuple(r) for r in df.select("nome", "cidade", "extra").fillna("-").collect()) == [
        ("Ana", "Mossoró", "x"), ("Caio", "Acari", "-"), ("José", "Natal", "-"),
    ]


def test_no_matching_file(spark, tmp_path):
    pattern = str(tmp_path / "none" / "*.csv")
    with pytest.raises(FileNotFoundError):
        readers.read_delimited_dir(spark, pattern)
    fallback = readers.read_delimited_dir(spark, pattern, fallback=lambda: spark.range(3).toDF("n"))
    assert fallback.count() == 3


def test_first_available(spark, tmp_path):
    sources = [
        ("gone", lambda: spark.read.parquet(str(tmp_path / "gone"))),
        ("no files", lambda: readers.read_delimited_dir(spark, str(tmp_path / "*.csv"))),
        ("empty", lambda: spark.range(0)),
        ("full", lambda: spark.range(2)),
        ("later", lambda: spark.range(5)),
    ]
    name, df = readers.first_available(sources)
    assert (name, df.count()) == ("full", 2)
    with pytest.raises(FileNotFoundError, match="gone, empty"):
        readers.first_available([sources[0], sources[2]])


def test_a_broken_source_is_not_skipped(spark):
    with pytest.raises(Exception, match="no_such_column"):
        readers.first_available([("bad", lambda: spark.range(1).select("no_such_column")), ("ok", lambda: spark.range(1))])


def test_flatten_comments(spark, tmp_path):
    def post(i, comments):
        return {"id": f"p{i}", "comments": comments}

    full = {"id": "c1", "text": "oi", "username": "ana", "timestamp": "2024-03-02T10:11:12+0000", "like_count": 4}
    payload = {"data": [post(0, {"data": [full, {"id": "c2"}]}), post(1, None), *(post(i, {"data": [{"id": f"d{i}"}]}) for i in range(2, 12))]}
    path = tmp_path / "p.json"
    path.write_text(json.dumps(payload) + "\n" + json.dumps({"data": []}) + "\n")
    payloads = readers.read_payloads(spark, str(path))
    rows = readers.flatten_comments(payloads, max_posts=10).collect()
    assert [tuple(r) for r in rows[:2]] == [("c1", "p0", "ana", "2024-03-02", 4, "oi"), ("c2", "p0", "", "", 0, "")]
    assert [r.comment_id for r in rows[2:]] == [f"d{i}" for i in range(2, 10)]  # the first ten posts
    assert readers.flatten_comments(payloads).count() == 12


def test_payloads_without_data_and_broken_ones(spark, tmp_path):
    (tmp_path / "error.json").write_text('{"error": {"code": 190}}\n{"data": [{"id": "p", "comments": {}}]}\n')
    assert readers.flatten_comments(readers.read_payloads(spark, str(tmp_path / "error.json"))).count() == 0
    (tmp_path / "pretty.json").write_text(json.dumps({"data": [{"id": 7, "comments": {"data": [{"id": 8}]}}]}, indent=2))
    pretty = readers.read_payloads(spark, str(tmp_path / "pretty.json"), multiline=True)
    assert [(r.post_id, r.comment_id) for r in readers.flatten_comments(pretty).collect()] == [("7", "8")]
    (tmp_path / "broken.json").write_text('{"data": [')
    with pytest.raises(Exception, match="MALFORMED|Malformed"):
        readers.read_payloads(spark, str(tmp_path / "broken.json")).collect()


def test_provenance(spark, tmp_path):
    contents = {"a.csv": b"x\n1\n2\n", "b.csv": b"x\n"}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    path = str(tmp_path / "*.csv")
    rows = readers.provenance(spark, path, spark.read.csv(path, header=True)).collect()
    got = {r.source.rsplit("/", 1)[1]: (r.file_hash, r.n_bytes, r.n_rows) for r in rows}
    assert got == {
        "a.csv": (hashlib.md5(contents["a.csv"]).hexdigest(), 6, 2),
        "b.csv": (hashlib.md5(contents["b.csv"]).hexdigest(), 2, 0),
    }


TEXTS = ["a;b", 'c"d', 'quoted "all" of it', "é ç", None, "line\nbreak", "line\r\nbreak", " padded ", "back\\slash", 'end\\"', "'x'", ","]


def test_delimited_roundtrip_keeps_text(spark, tmp_path):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(TEXTS)], "i int, v string")
    path = str(tmp_path / "out")
    writers.write_delimited(df, path)
    back = readers.read_delimited(spark, path, multiline=True).orderBy(F.col("i").cast("int"))
    assert [r.v for r in back.collect()] == TEXTS


def test_delimited_files_of_other_tools(spark, tmp_path):
    """Files as pandas writes them, and read as it reads them."""
    frame = pd.DataFrame({"i": range(len(TEXTS)), "v": TEXTS})
    path = tmp_path / "p.csv"
    frame.to_csv(path, sep=";", index=False, encoding="utf-8-sig", lineterminator="\n")
    back = readers.read_delimited(spark, str(path), multiline=True).orderBy(F.col("i").cast("int"))
    assert [r.v for r in back.collect()] == TEXTS


def test_markers_of_missing_values(spark, tmp_path):
    path = tmp_path / "n.csv"
    path.write_text("i;a.b\n1;NA\n2;null\n3;Na\n4;\n5;NaN\n6;\"\"\n")
    assert [r[1] for r in readers.read_delimited(spark, str(path)).collect()] == [None, None, "Na", None, None, None]
    kept = readers.read_delimited(spark, str(path), null_markers=()).collect()
    assert [r[1] for r in kept] == ["NA", "null", "Na", None, "NaN", None]


def test_parquet_copy_is_best_effort(spark, tmp_path):
    df = spark.range(100).withColumn("ano", F.col("id") % 3)
    path, blocked = str(tmp_path / "t"), tmp_path / "file"
    blocked.write_text("in the way")
    with pytest.warns(UserWarning, match="no copy"):
        writers.write_parquet(df, path, partition_by="ano", copy_to=str(blocked / "t"))
    stored = spark.read.parquet(path)
    assert stored.count() == 100
    assert sorted(p.name for p in (tmp_path / "t").glob("ano=*")) == ["ano=0", "ano=1", "ano=2"]
    with pytest.raises(Exception):
        writers.write_parquet(df, str(blocked / "t"))


def test_load_replaces_contents(spark, tmp_path):
    columns = {"day": "date", "n": "int", "x": "double"}
    first = spark.createDataFrame([("2024-01-01", 1.0, float("nan"), "extra")], "day string, n double, x double, other string")
    second = spark.createDataFrame([("2024-01-02", 2.0, 0.5), ("2024-01-03", float("nan"), None)], "day string, n double, x double")
    loaded = writers.load_table(first, "stg_test", columns, str(tmp_path / "stg"))
    assert [tuple(r) for r in loaded.collect()] == [(datetime.date(2024, 1, 1), 1, None)]
    loaded = writers.load_table(second, "stg_test", columns)
    assert dict(loaded.dtypes) == columns
    assert sorted(tuple(r) for r in loaded.collect()) == [
        (datetime.date(2024, 1, 2), 2, 0.5), (datetime.date(2024, 1, 3), None, None),
    ]


def test_publish_counts_and_uses_the_shared_folder(spark):
    stored = publish(spark.range(1234), "numbers")
    assert stored.rows == stored.frame.count() == 1234
    assert all(shared_dir(spark) in f for f in stored.frame.inputFiles())
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_the_session_names_the_shared_folder():
    def session(folder=None, warehouse="hdfs://lake/warehouse/", master="spark://host:1"):
        context = SimpleNamespace(getConf=lambda: {}, master=master)
        conf = {"spark.sql.warehouse.dir": warehouse} | ({"spark.checkpoint.dir": folder} if folder else {})
        return SimpleNamespace(sparkContext=context, conf=conf)

    assert shared_dir(session("hdfs://lake/tmp/")) == "hdfs://lake/tmp"
    assert shared_dir(session()) == "hdfs://lake/warehouse/_steps"
    assert shared_dir(session(warehouse="file:/here/w", master="local[2]")) == "file:/here/w/_steps"
    for own in ("file:/here/w", "file:///here/w", "/here/w"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_dir(session(warehouse=own))


@pytest.mark.parametrize("missing", ["wardlake.llm", "tokenizers", "ahocorasick", "public_tokenizers"])
def test_engine_queries_need_no_library_of_the_optional_part(missing):
    code = f"import sys; sys.modules[{missing!r}] = None; import __spark_entry__ as e; n = e.queries(); print(len(n), 'pipeline' in n, set(e.oracle_sql()) <= set(n))"
    root = Path(__file__).resolve().parents[1]
    done = subprocess.run([sys.executable, "-W", "ignore", "-c", code], cwd=root, capture_output=True, text=True, check=True)
    count, pipeline, same = done.stdout.split()
    assert int(count) >= len(QUERIES) and same == "True"
    if missing == "wardlake.llm":
        assert (int(count), pipeline) == (len(QUERIES), "False")


def test_headers_take_one_job_for_any_number_of_files(spark, tmp_path):
    for k in range(60):
        names = ("nome", "cidade") if k % 3 else ("cidade", "nome", "extra")
        (tmp_path / f"{k:02}.csv").write_text(";".join(names) + "\n" + "\n".join(f"{n}{k}" for n in [";".join(names)]) + "\n")
    files = sorted(spark.read.text(str(tmp_path / "*.csv")).inputFiles())
    context = spark.sparkContext
    jobs = {}
    for n in (36, 60):
        found = files_module.first_records(files_module.listed(spark, files[:n]), "UTF-8")
        context.setJobGroup(f"headers{n}", "headers")
        groups = readers.header_groups(found)
        jobs[n] = len(context.statusTracker().getJobIdsForGroup(f"headers{n}"))
        context._jsc.clearJobGroup()
        assert sorted(map(len, groups)) == [n // 3, n - n // 3]
    assert jobs[36] == jobs[60]
    slow = readers.header_groups(readers.read_first_lines(spark, str(tmp_path / "*.csv"), "UTF-8"))
    assert slow == groups


def test_headers_do_not_read_the_files(tmp_path, monkeypatch):
    """What is read of a file depends on its header alone; quoted line breaks belong to it."""
    cases = {
        b"\xef\xbb\xbfnome;cidade\r\nx;y\n": "nome;cidade",
        b"\n\r\nnome\n": "nome",
        b'"no\nme";"a ""b"" \n";c\n1;2;3': '"no\nme";"a ""b"" \n";c',
        b"nome": "nome",
        b"": None,
        b"\n\n": None,
        b"h" * 100_000 + b"\n1": "h" * 100_000,
    }
    for k, (content, header) in enumerate(cases.items()):
        (tmp_path / f"{k}.csv").write_bytes(content)
        assert files_module.first_record(f"file:{tmp_path}/{k}.csv", "UTF-8") == header
    read = []
    real = files_module.open_stream

    class Counted:
        def __init__(self, address):
            self.stream = real(address)

        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.stream.close()

        def read(self, n):
            chunk = self.stream.read(n)
            read.append(len(chunk))
            return chunk

    monkeypatch.setattr(files_module, "open_stream", Counted)
    for size in (1 << 20, 1 << 24):
        read.clear()
        (tmp_path / "long.csv").write_bytes(b"a;b\n" + b"1;2\n" * (size // 4))
        assert files_module.first_record(f"file:{tmp_path}/long.csv", "UTF-8") == "a;b"
        assert sum(read) == files_module.FIRST


def test_a_file_of_more_than_two_gigabytes_is_hashed(spark, tmp_path):
    with open(tmp_path / "big name.bin", "wb") as file:
        file.truncate((1 << 31) + 12_345)  # a hole, no blocks on disk
    want, zeros = hashlib.md5(), bytes(1 << 24)
    for _ in range((1 << 31) >> 24):
        want.update(zeros)
    want.update(bytes(12_345))
    row = files_module.digests(files_module.listed(spark, str(tmp_path / "*.bin"))).first()
    assert (row.n_bytes, row.file_hash) == ((1 << 31) + 12_345, want.hexdigest())
    assert row.file.endswith("big%20name.bin")


def test_addresses():
    assert files_module.can_open("file:/a/b") and files_module.can_open("/a/b") and not files_module.can_open("nosuch://a/b")


def test_load_goes_by_column_name(spark, tmp_path):
    one = spark.createDataFrame([(1, 2)], "a int, b int")
    writers.load_table(one, "stg_names", {"a": "int", "b": "int"}, str(tmp_path / "names"))
    loaded = writers.load_table(one, "stg_names", {"b": "int", "a": "int"})
    assert loaded.first().asDict() == {"a": 1, "b": 2}
    with pytest.raises(ValueError, match="stg_names"):
        writers.load_table(one, "stg_names", {"a": "int"})
    spark.sql("DROP TABLE stg_names")
