"""The Jaccard join against comparing all pairs."""

from __future__ import annotations

import random
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from edge import edge, edge_rows, nothing
from wardlake.llm import jaccard
from wardlake.llm.graph import components
from wardlake.llm.queries import QUERIES
from wardlake.llm.stored import stored


def plain_set(text, size):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return frozenset()
    return frozenset(tuple(words[k : k + size]) for k in range(max(1, len(words) - size + 1)))


def plain_components(rows, size, percent):
    sets = [(i, plain_set(t, size)) for i, t in rows]
    root = list(range(len(sets)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    where: dict = {}
    for k, (_, s) in enumerate(sets):
        for x in s:
            where.setdefault(x, []).append(k)
    pairs = {(a, b) for ks in where.values() for a in ks for b in ks if a < b}
    for a, b in pairs:
        x, y = sets[a][1], sets[b][1]
        both = len(x & y)
        if 100 * both >= percent * (len(x) + len(y) - both):
            root[max(find(a), find(b))] = min(find(a), find(b))
    least: dict = {}
    for k, (i, _) in enumerate(sets):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(s), least.get(find(k))) for k, (i, s) in enumerate(sets)), key=str)


def got(df, join):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in jaccard.near_duplicates(df, join).collect()), key=str)


def test_query_equals_all_pairs(spark, sf_dir):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()
    out = QUERIES["op3_jaccard_join"](spark, sf_dir).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in out), key=str) == plain_components(rows, 3, 90)


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80), (2, 60)])
def test_planted_copies(spark, size, percent):
    rng = random.Random(size)
    vocabulary = [f"w{k}" for k in range(400)]
    rows, base = [], [[rng.choice(vocabulary) for _ in range(rng.choice([4, 12, 40, 150]))] for _ in range(12)]
    line = [rng.choice(vocabulary) for _ in range(30)]
    for k in range(360):
        words = list(base[min(k % 30, 11)]) + (line if k % 5 == 0 else [])
        for _ in range(min(len(words) - 1, rng.choice([0, 0, 1, 2, 4, 8]))):
            at = rng.randrange(len(words))
            words[at : at + 1] = rng.choice([[], [rng.choice(vocabulary)], [words[at], rng.choice(vocabulary)]])
        rows.append((k, rng.choice([" ", "\n", "  "]).join(words)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got(df, jaccard.Join(size, percent)) == plain_components(rows, size, percent)


def test_edges(spark):
    rows = [(r[0], r[1]) for r in edge_rows()]
    assert got(edge(spark), jaccard.Join(3, 90)) == plain_components(rows, 3, 90)
    assert jaccard.near_duplicates(nothing(spark), jaccard.Join(3, 90)).count() == 0


def test_large_steps_are_deleted(spark, sf_dir, monkeypatch):
    made = []

    def recorded(df, name):
        made.append((name, stored(df, name)))
        return made[-1][1]

    monkeypatch.setattr(jaccard, "stored", recorded)
    assert QUERIES["op3_jaccard_join"](spark, sf_dir).count()
    hadoop = spark._jsparkSession.sessionState().newHadoopConf()
    there = set()
    for name, df in made:
        folder = spark._jvm.org.apache.hadoop.fs.Path(df.inputFiles()[0]).getParent()
        if folder.getFileSystem(hadoop).exists(folder):
            there.add(name)
    assert "texts" in there
    # whole prefixes, sketches of all classes, and members of sets
    assert not there & {"published", "classes", "shared", "sets"}


def test_one_of_each(spark):
    out = jaccard.one_of_each(edge(spark), jaccard.Join(3, 90))
    assert out.columns == edge(spark).columns
    expected = {i for i, _, c in plain_components([(r[0], r[1]) for r in edge_rows()], 3, 90) if i == c}
    ids = [r.doc_id for r in out.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(expected) and ids.count(None) == 1


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 460)]
    root = {x: x for p in links for x in p}
    for _ in range(500):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    df = spark.createDataFrame(links, "a bigint, b bigint")
    linked = {x for a, b in links if a != b for x in (a, b)}
    assert {r.node: r.root for r in components(df).collect()} == {k: v for k, v in root.items() if k in linked}
    assert components(spark.createDataFrame([], "a bigint, b bigint")) is None


def test_components_of_a_chain_in_order_take_few_steps(spark, monkeypatch):
    from wardlake.llm import graph

    steps = []
    monkeypatch.setattr(graph, "stored", lambda df, name, plain=graph.stored: steps.append(name) or plain(df, name))
    chain = spark.range(10_000).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    found = graph.components(chain)
    assert found.count() == 10_001 and found.where("root <> 0").isEmpty()
    assert steps.count("parents") <= 20


def thue_morse():
    """Two words of 1,024 letters whose polynomial hashes modulo a power of two are equal."""
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_structured_words_are_told_apart(spark):
    one, other = thue_morse()
    docs = spark.createDataFrame([(1, f"{one} {one} {one}"), (2, f"{other} {other} {other}"), (3, f"{one} {one} {one}")], "doc_id bigint, text string")
    assert {r.doc_id: r.component_id for r in jaccard.near_duplicates(docs, jaccard.Join(3, 90)).collect()} == {1: 1, 2: 2, 3: 1}
