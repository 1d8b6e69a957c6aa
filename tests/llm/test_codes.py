"""Product codes against plain loops, and SQL on the given table."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest

from compare import connect, duck_rows, spark_rows
from wardlake.llm import codes
from wardlake.llm.codes import Codes, compress
from wardlake.llm.queries import ORACLE, QUERIES

SCHEMA = "vec_id bigint, embedding array<float>, label int, id int, vector string, code int, _of int"


def plain(rows, how):
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    dim = next((len(r[1]) for r in kept if r[1] and len(r[1]) % how.parts == 0), how.parts)
    usable = [r for r in kept if len(r[1]) == dim and all(abs(x) <= codes.LARGEST for x in r[1])]
    w = dim // how.parts
    ints = [[math.floor(float(np.float32(x)) * how.scale) for x in r[1]] for r in usable]
    cut = [[tuple(v[p * w : (p + 1) * w]) for p in range(how.parts)] for v in ints]
    books = [[list(v[p]) for v in cut[: how.entries]] for p in range(how.parts)]

    def nearest(p, part):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), k) for k, e in enumerate(books[p]))

    for _ in range(how.rounds):
        groups = {}
        for v in cut:
            for p, part in enumerate(v):
                groups.setdefault((p, nearest(p, part)[1]), []).append(part)
        for (p, k), members in groups.items():
            books[p][k] = [sum(x) // len(members) for x in zip(*members)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    out = []
    for r, v in zip(usable, cut):
        found = [nearest(p, part) for p, part in enumerate(v)]
        out.append([r[0], "".join(f"{k:02x}" for _, k in found), sum(d for d, _ in found), r[2]])
    out += [[r[0], None, None, r[2]] for r in kept if r not in usable]
    labels = {}
    for row in out:
        if row[2] is not None:
            labels[row[3]] = labels.get(row[3], 0) + row[2]
    return sorted(((i, c, e, labels.get(x), digest) for i, c, e, x in out), key=str)


def got(spark, rows, how):
    df = spark.createDataFrame([(*r, 1, "x", 2, 3) for r in rows], SCHEMA)
    return sorted(map(tuple, compress(df, how=how).collect()), key=str)


@pytest.mark.parametrize("how", [Codes(), Codes(parts=4, entries=5, rounds=3), Codes(parts=16, entries=200)])
def test_plain_loops(spark, how):
    rng = random.Random(how.entries)
    base = [[rng.uniform(-1, 1) for _ in range(32)] for _ in range(60)]
    rows = [(k, rng.choice(base) if k % 3 else [round(rng.uniform(-2, 2), 1) for _ in range(32)], rng.choice([1, 2, None])) for k in range(300)]
    rows = [(i, [float(np.float32(x)) for x in v], t) for i, v, t in rows]
    rows += [
        rows[7], rows[7],
        (400, None, 1), (401, [None] * 32, 1), (402, [float("nan")] * 32, 1), (403, [float("-inf")] + [0.0] * 31, 2),
        (404, [], 1), (405, [0.5] * 16, None), (406, [1e30] * 32, 9), (None, [0.25] * 32, 1), (3, [0.125] * 32, 1),
    ]
    assert got(spark, rows, how) == plain(rows, how)


def test_few_rows_and_none(spark):
    rows = [(5, [0.1] * 16, None), (5, [0.1] * 16, None), (2, [-0.3] * 16, 1)]
    assert got(spark, rows, Codes()) == plain([(i, [float(np.float32(x)) for x in v], t) for i, v, t in rows], Codes())
    assert got(spark, [], Codes()) == []
    assert got(spark, [(1, None, 1), (2, [], 3)], Codes()) == [(2, None, None, None, hashlib.sha256(b"").hexdigest())]


def test_walk_in_runs_equals_all_distances(monkeypatch):
    rng = np.random.default_rng(3)
    parts = codes.distinct(rng.integers(-6, 6, (5000, 4)))[0]
    book = rng.integers(-6, 6, (9, 4))
    full = ((parts[:, None, :] - book) ** 2).sum(2)
    for nodes in (2048, 7, 1):
        monkeypatch.setattr(codes, "NODES", nodes)
        entry, distance = codes.walk(parts, book)
        assert (entry == full.argmin(1)).all() and (distance == full.min(1)).all()


def test_many_chunks(spark, sf_dir, monkeypatch):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    whole = spark_rows(compress(df))
    monkeypatch.setattr(codes, "CHUNK", 64 * 9)
    assert spark_rows(compress(df.repartition(7))) == whole


def test_sql_equals_query(spark, sf_dir):
    want = duck_rows(connect(sf_dir), ORACLE["op11_code_trie"])
    assert spark_rows(QUERIES["op11_code_trie"](spark, sf_dir)) == want
