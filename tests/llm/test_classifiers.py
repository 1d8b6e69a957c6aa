"""Classifiers on rows they never learned from, their numeric parts, and awkward input."""

from __future__ import annotations

import os
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from edge import edge, edge_rows, nothing
from wardlake.llm import quality, toxicity
from wardlake.llm.arrays import slices
from wardlake.llm.queries import QUERIES

LEARN_DIR = os.environ.get("TEST_LEARN_DIR", "/root/testdata/sf0.1")


def area(score, label):
    rank = np.argsort(np.argsort(score, kind="stable"))
    p = label > 0
    return (rank[p].sum() - p.sum() * (p.sum() - 1) / 2) / (p.sum() * (~p).sum())


@pytest.mark.parametrize("name, column, modulus, rest, least", [("op1_toxicity_cnn", "toxic", 4, 2, 0.9), ("op2_quality_kernel", "quality", 3, 1, 0.97)])
def test_held_out_rows(spark, name, column, modulus, rest, least):
    rows = QUERIES[name](spark, LEARN_DIR).collect()
    labels = dict(duckdb.sql(f"SELECT doc_id, {column} FROM '{LEARN_DIR}/labels.parquet'").fetchall())
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % modulus == rest) for r in rows)
    assert all(0 <= r.score <= 1 for r in rows)
    cut = 0.3 if name.startswith("op1") else 0.5
    assert all(r.predicted == (r.score >= cut) for r in rows)
    known = [(r.score, r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    score, predicted, label = map(np.array, zip(*known))
    assert area(score, label) > least and (predicted == label).mean() > 0.95


def labels_of(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int, text string")


def test_edges(spark):
    some = labels_of(spark, [(k, k % 2, k % 2, "x") for k in range(18)] + [(3, 0, 1, "x"), (None, 1, 1, "x"), (5, None, None, "x"), (77, 1, 0, "x")])
    one_kind = labels_of(spark, [(k, 1, 0, "x") for k in range(18)])
    for labels in (some, one_kind, some.where("false")):
        for found in (toxicity.toxicity(edge(spark), labels), quality.quality(edge(spark), labels)):
            rows = found.collect()
            assert len(rows) == len(edge_rows()) and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in quality.quality(edge(spark), one_kind).collect()} == {1.0}
    assert {r.score for r in quality.quality(edge(spark), some.where("false")).collect()} == {0.5}
    assert {r.score for r in toxicity.toxicity(edge(spark), some.where("false")).collect()} == {0.5}
    for found in (toxicity.toxicity(nothing(spark), some), quality.quality(nothing(spark), some)):
        assert found.count() == 0
    kept = quality.good(edge(spark), one_kind)
    assert kept.columns == edge(spark).columns and kept.count() == len(edge_rows())


def test_scores_do_not_depend_on_other_columns(spark):
    labels = labels_of(spark, [(k, k % 2, k % 2, "x") for k in range(18)])
    a = {r.doc_id: r.score for r in toxicity.toxicity(edge(spark), labels).collect()}
    rows = [(r[0], r[1], "zz", "other", *r[4:]) for r in edge_rows()]
    b = {r.doc_id: r.score for r in toxicity.toxicity(spark.createDataFrame(rows, edge(spark).schema), labels).collect()}
    assert a == b


def test_isotonic_pools():
    at, n, hits = np.arange(6.0), np.array([4, 4, 4, 4, 4, 4.0]), np.array([0, 2, 1, 3, 2, 4.0])
    centres, values = quality.pool_adjacent(at, n, hits)
    np.testing.assert_allclose(values, [0, 3 / 8, 5 / 8, 1])
    np.testing.assert_allclose(centres, [0, 1.5, 3.5, 5])


def test_normal_equations_are_sums(spark):
    rng = np.random.default_rng(1)
    stats, label = rng.random((300, len(quality.STATISTICS))), rng.integers(0, 2, 300)
    df = spark.createDataFrame([(list(map(float, s)), int(y)) for s, y in zip(stats, label)], "stats array<double>, label int").repartition(7)
    kernel = quality.kernel_of(df)
    z = np.concatenate([kernel(stats), label[:, None]], axis=1)
    np.testing.assert_allclose(quality.normal_equations(df, kernel), z.T @ z, rtol=1e-9, atol=1e-9)


def test_kernel_approximates_a_gaussian():
    rng = np.random.default_rng(2)
    d = len(quality.STATISTICS)
    kernel = quality.Kernel(np.zeros(d), np.ones(d), rng.normal(0, 1 / quality.BANDWIDTH, (d, 20_000)), rng.uniform(0, 2 * np.pi, 20_000))
    x = rng.normal(0, 0.5, (5, d))
    z = kernel(x)[:, :-1]
    gauss = np.exp(-((x[:, None] - x[None]) ** 2).sum(-1) / (2 * quality.BANDWIDTH**2))
    np.testing.assert_allclose(z @ z.T, gauss, atol=0.05)


def test_pooling_equals_a_plain_convolution():
    rng = np.random.default_rng(3)
    texts = ["one two three four five six seven eight nine ten", "", "alpha", "beta gamma"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    ((_, data, bounds),) = slices(batch)
    hashes, first, real = toxicity.word_hashes(data, bounds)
    start = toxicity._constant(0.5)
    rows = rng.integers(1, 20, len(start.rows)).astype(np.int32)
    rows[0] = 0
    vectors = rng.normal(0, 1, (20, toxicity.DIMENSIONS)).astype(np.float32)
    vectors[0] = 0
    filters = [rng.normal(0, 1, f.shape).astype(np.float32) for f in start.filters]
    model = start._replace(rows=rows, vectors=vectors, filters=filters)
    pooled, _ = toxicity._pool(model, rows[hashes], first, real)
    for k, text in enumerate(texts):
        own = vectors[rows[hashes[first[k] * 8 : first[k + 1] * 8]]].sum(axis=1)
        padded = np.concatenate([own, np.zeros((3, own.shape[1]), np.float32)])
        n = len(text.split())
        assert n <= len(own) - 2
        plain = np.zeros((1, sum(f.shape[2] for f in filters)))
        if n:
            plain = np.array([np.concatenate([sum(padded[i + j] @ f[j] for j in range(len(f))) for f in filters]) for i in range(n)])
        np.testing.assert_allclose(pooled[k, : plain.shape[1]], np.maximum(plain.max(axis=0), 0), rtol=1e-3, atol=1e-3)
