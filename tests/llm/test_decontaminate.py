"""Decontamination against a full edit-distance search."""

from __future__ import annotations

import random
import re

import duckdb
import numpy as np

from edge import edge, nothing
from wardlake.llm import decontaminate as dc
from wardlake.llm.queries import QUERIES


def plain(text):
    return re.sub(r"[\x09-\x0D]", " ", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def least_edits(item, text):
    """Fewest edits from the item to any part of the text, row by row."""
    t = np.frombuffer(text.encode("utf-32-le"), np.uint32)
    j = np.arange(len(t) + 1)
    row = np.zeros(len(t) + 1, np.int64)
    for i, c in enumerate(item, 1):
        new = np.concatenate([[i], np.minimum(row[:-1] + (t != ord(c)), row[1:] + 1)])
        row = np.minimum.accumulate(new - j) + j
    return int(row.min())


def budget(item):
    return min(len(item) * dc.EDIT_PERCENT // 100, (len(item) - dc.Q) // dc.Q)


def expected(docs, items):
    out = {}
    for d, text in docs:
        for i, item in items:
            item = plain(item)
            if len(item) >= dc.SHORTEST and text:
                e = least_edits(item, plain(text))
                if e <= budget(item):
                    out[d, i] = e
    return out


def check(spark, docs, items):
    got = dc.leaks(spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert {(r.doc_id, r.item_id): r.edits for r in got} == expected(docs, items)
    texts, known = dict(docs), dict(items)
    for r in got:
        part = plain(texts[r.doc_id])[r.start : r.end]
        item = plain(known[r.item_id])
        assert least_edits(item, part) == r.edits and abs(len(part) - len(item)) <= r.edits


def test_edited_passages(spark):
    rng = random.Random(3)
    letters = "abcdefgh éö,.\n"
    def prose(n):
        return "".join(rng.choice(letters) for _ in range(n))
    items = [(k, prose(rng.choice([24, 30, 60, 150, 300]))) for k in range(12)]
    docs = []
    for k in range(160):
        text = prose(rng.choice([0, 5, 300, 900]))
        item = list(items[k % 12][1])
        for _ in range(round(rng.uniform(0, 1.4) * budget("".join(item)))):
            at = rng.randrange(len(item))
            item[at : at + 1] = rng.choice([[], [rng.choice(letters)], [item[at], rng.choice(letters)]])
        if k % 4 == 3:
            item = item[: len(item) // 2]
        docs.append((k, "".join(item).upper() + text if k % 3 == 0 else text + "".join(item) if k % 3 == 1 else text[:100] + "".join(item) + text[100:]))
    check(spark, docs, items)


def short_places(docs, items):
    """Whole-word places of short items, letter by letter."""
    out = {}
    for d, text in docs:
        t = plain(text)
        for i, item in items:
            w = plain(item).strip(" ")
            if not w or len(plain(item)) >= dc.SHORTEST:
                continue
            for at in range(len(t) - len(w) + 1):
                end = at + len(w)
                if t[at:end] != w:
                    continue
                opens = at == 0 or not (t[at - 1].isalnum() and w[0].isalnum())
                if opens and (end == len(t) or not (t[end].isalnum() and w[-1].isalnum())):
                    out.setdefault((d, i), (at, end))
    return out


def test_short_items_are_found_exactly(spark):
    rng = random.Random(11)
    letters = ["a", "b", " ", "é", "?", "\n", "漢", "7"]
    word = lambda low, high: "".join(rng.choices(letters, k=rng.randrange(low, high)))
    items = [(k, word(0, 6)) for k in range(60)] + [(90, "what is two plus two"), (91, "a" * 23), (92, " \t"), (93, ""), (94, None), (95, "b" * 24)]
    docs = [(k, word(0, 30)) for k in range(200)] + [(300, "so: What is\ttwo plus two? 4"), (301, "what is two plus twos"), (302, "a" * 23), (303, "a" * 24), (304, None), (305, "b" * 24)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    got = {(r.doc_id, r.item_id): (r.start, r.end) for r in dc.leaks(df, bench).collect() if r.item_id != 95}
    want = short_places(docs, items[:-1])
    assert got == {k: v for k, v in want.items() if v} and (300, 90) in got and (301, 90) not in got
    dirty = {d for d, _ in got} | {305}
    assert {r.doc_id for r in dc.without_leaks(df, bench).collect()} == {d for d, _ in docs} - dirty


def test_repetitive_texts(spark):
    items = [(1, "abab" * 20), (2, "a" * 60), (3, "xyz" * 30)]
    docs = [(1, "ab" * 100), (2, "a" * 59), (3, "a" * 500), (4, "xyz" * 28 + "q"), (5, "ba" * 39)]
    check(spark, docs, items)


def test_query_on_the_given_tables(spark, sf_dir):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()
    items = duckdb.sql(f"SELECT item_id, text FROM '{sf_dir}/benchmark.parquet'").fetchall()
    got = {(r.doc_id, r.item_id): r.edits for r in QUERIES["op9_benchmark_leaks"](spark, sf_dir).collect()}
    verbatim = {(d, i) for d, t in docs for i, b in items if plain(b) in plain(t)}
    assert {k for k, e in got.items() if e == 0} == verbatim
    few = docs[:: max(1, len(docs) // 40)]
    want = expected(few, items)
    assert {k: e for k, e in got.items() if k[0] in {d for d, _ in few}} == want


def test_blocks_and_edges(spark, monkeypatch):
    bench = spark.createDataFrame([(1, "the quick brown fox jumps over the lazy dog"), (None, "same line same line same line"), (3, None), (4, "x"), (1, "The quick brown fox jumps over the lazy dog")], "item_id bigint, text string")
    docs = edge(spark)
    one = sorted(map(tuple, dc.leaks(docs, bench).collect()), key=str)
    assert one
    monkeypatch.setattr(dc, "BLOCK_CHARACTERS", 30)
    assert sorted(map(tuple, dc.leaks(docs, bench).collect()), key=str) == one
    dirty = {r[0] for r in one}
    clean = dc.without_leaks(docs, bench)
    assert clean.columns == docs.columns
    assert sorted((r.doc_id for r in clean.collect()), key=str) == sorted((r.doc_id for r in docs.collect() if r.doc_id not in dirty), key=str)
    assert dc.leaks(nothing(spark), bench).count() == 0
    assert dc.leaks(docs, bench.where("false")).count() == 0
    assert dc.without_leaks(docs, bench.where("false")).count() == docs.count()
