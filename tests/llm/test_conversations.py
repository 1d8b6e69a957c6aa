"""Snapshot collapse against comparing all conversations."""

from __future__ import annotations

import random
import re

import duckdb

from wardlake.llm import conversations as cv
from wardlake.llm.queries import ORACLE, QUERIES

SCHEMA = "conv_id bigint, turn bigint, role string, text string, chunk int, place int"


def plain(rows):
    by: dict = {}
    for c, turn, role, text in {r[:4] for r in rows}:
        by.setdefault(c, []).append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    whole = {c: [x[2:] for x in sorted(v)] for c, v in by.items()}
    out = []
    for c, v in whole.items():
        if any(len(w) > len(v) and w[: len(v)] == v for w in whole.values()):
            continue
        same = [k for k, w in whole.items() if w == v]
        known = [k for k in same if k is not None]
        if c != (min(known) if known else None):
            continue
        for part in range(-(-len(v) // cv.PART)):
            text = "".join(f"<|im_start|>{x[1]}\n{x[3]}<|im_end|>\n" for x in v[part * cv.PART : (part + 1) * cv.PART])
            out.append((c, part, len(v), len(same), text))
    return sorted(out, key=str)


def got(spark, rows):
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA)
    return sorted(((r.conv_id, r.part, r.n_turns, r.n_copies, r.rendered) for r in cv.collapsed(df).collect()), key=str)


def test_snapshots(spark):
    rng = random.Random(2)
    rows = []
    for c in range(150):
        base = random.Random(c % 12)
        turns = [(t, base.choice(["user", "assistant", None]), base.choice(["hi", "a b", "", None, f"x{t}"])) for t in range(rng.choice([1, 2, 3, 5, 9]))]
        if c % 10 == 9:
            turns[-1] = (turns[-1][0], "user", f"own {c}")
        rows += [(c, *t) for t in turns]
    rows += rows[:40]
    rows += [(900, None, "user", "no turn"), (900, 3, None, None), (901, 5, "b", "tie"), (901, 5, "a", "tie"), (None, 0, "user", "no id")]
    assert got(spark, rows) == plain(rows)


def test_long_conversations_in_chunks(spark):
    rows = [(1, t, "user", f"t{t}") for t in range(1700)] + [(2, t, "user", f"t{t}") for t in range(1500)] + [(3, t, "user", f"t{t}") for t in range(1700)]
    rows += [(4, 7 * t, "user", f"t{t}") for t in range(1699)] + [(5, t, "user", "t0") for t in range(600)]
    assert got(spark, rows) == plain(rows)


def test_empty(spark):
    assert cv.collapsed(spark.createDataFrame([], SCHEMA)).count() == 0


def test_sql_equals_query(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    expected = con.sql(ORACLE["op7_snapshot_collapse"])
    rows = QUERIES["op7_snapshot_collapse"](spark, sf_dir).select(*expected.columns).collect()
    assert sorted(map(tuple, rows)) == sorted(expected.fetchall())
