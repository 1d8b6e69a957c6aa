"""The interaction audit against running the filters one after another, and SQL."""

from __future__ import annotations

import re
from itertools import permutations

from pyspark.sql import functions as F

from compare import connect, duck_rows, spark_rows
from edge import edge, edge_rows, nothing
from wardlake.llm import audit
from wardlake.llm.queries import ORACLE, QUERIES

COLUMNS = "part filter_order step kept removed redundant unique_fails good_lost toxic_lost shapley".split()


def plain(docs, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    first = {}
    for i, text, _ in docs:
        text = text or ""
        if i is not None and (text not in first or i < first[text]):
            first[text] = i
    rows = []
    for i, text, part in docs:
        t = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        failed = {
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
            "D": bool(re.search(r"[#$%&*|]", t)),
            "E": t in first and (i is None or first[t] < i),
        }
        rows.append((part or "", {f for f, bad in failed.items() if bad}, i in good, i in toxic))
    out, shapley = [], {}
    for part in {r[0] for r in rows}:
        for order in permutations("ABCDE"):
            left, gone = [r for r in rows if r[0] == part], []
            for step, f in enumerate(order, 1):
                lost = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                shapley[part, f] = shapley.get((part, f), 0) + len(lost)
                out.append([
                    part, "".join(order), step, len(left), len(lost), sum(f in r[1] for r in gone),
                    sum(r[0] == part and r[1] == {f} for r in rows), sum(r[2] for r in lost), sum(r[3] for r in lost),
                ])
                gone += lost
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def rows_of(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


def test_edge_rows(spark):
    labels = [(0, 1, 0), (1, 0, 1), (1, 1, 1), (5, 1, 1), (6, None, 1), (None, 1, 1), (18, 1, None), (12, 0, 1)]
    frame = spark.createDataFrame([(*r, 1, "x") for r in labels], "doc_id bigint, quality int, toxic int, part int, mask string")
    docs = edge(spark).withColumns({"part": F.col("row"), "mask": F.col("blob"), "digest": F.col("text")})
    want = plain([(r[0], r[1], r[3]) for r in edge_rows()], labels)
    assert rows_of(audit.interactions(docs, frame)) == want
    assert audit.interactions(nothing(spark), frame).count() == 0
    assert rows_of(audit.interactions(docs, frame.limit(0))) == plain([(r[0], r[1], r[3]) for r in edge_rows()], [])


def test_given_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    want = plain(
        [tuple(r) for r in docs.select("doc_id", "text", "source").collect()],
        [tuple(r) for r in labels.select("doc_id", "quality", "toxic").collect()],
    )
    assert rows_of(QUERIES["op12_filter_audit"](spark, sf_dir)) == want


def test_counts_fill_their_fields():
    n = (1 << 56) - 1
    for mask in (0, 5, 31):
        made = audit.tally("p", [(mask, n, n, n)])
        assert set(made["kept"].tolist()) | set(made["redundant"].tolist()) <= {0, n}
        assert made["removed"].tolist() == made["good_lost"].tolist()
        assert all(sum(x) in (0, n) for x in zip(made["kept"].tolist(), made["removed"].tolist()))


def test_long_texts_in_pieces(monkeypatch):
    data = ("word %d and\tother\nwords " * 30_000 % tuple(range(30_000))).encode() + b"x" * 3_000_000
    whole = data.split()
    assert audit.count_words(data) == (len(whole), len(set(whole)))
    monkeypatch.setattr(audit, "PIECE", 5)
    assert audit.count_words(data[:2000]) == (len(data[:2000].split()), len(set(data[:2000].split())))
    assert audit.count_words(b" \x0b  a ") == (1, 1)


def test_sql_equals_query(spark, sf_dir):
    want = duck_rows(connect(sf_dir), ORACLE["op12_filter_audit"])
    assert spark_rows(QUERIES["op12_filter_audit"](spark, sf_dir)) == want
