"""The pipeline, stage by stage, against plain versions of what each stage decides."""

from __future__ import annotations

import base64

import public_tokenizers
import pytest
import tiktoken

import corpus_pipeline
from edge import edge, edge_rows, nothing
from test_decontaminate import expected as leaked
from test_jaccard import plain_components
from test_texts import plain_spans
from wardlake.llm.quality import quality

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def masked(text):
    made, at = "", 0
    for a, _, b in plain_spans(text):
        if a >= at:
            made += text[at:a] + "<secret>"
        at = max(at, b)
    return made + text[at:]


def test_stages_on_the_given_tables(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    scores = {r.doc_id: r.score for r in quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()}
    rows = {r.doc_id: r for r in docs.collect()}

    out = stages["quality classifier"](spark, docs, sf_dir)
    good = sorted(r.doc_id for r in out.collect())
    assert good == sorted(i for i, s in scores.items() if s >= 0.5) and out.columns == columns

    out = stages["n-gram Jaccard join"](spark, out, sf_dir)
    single = sorted(r.doc_id for r in out.collect())
    assert single == sorted(i for i, _, c in plain_components([(i, rows[i].text) for i in good], 5, 80) if i == c)
    assert out.columns == columns

    out = stages["benchmark decontamination"](spark, out, sf_dir)
    clean = {r.doc_id for r in out.collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    few = single[:60] + [i for i in single if i not in clean]
    bad = {i for i, _ in leaked([(i, rows[i].text) for i in few], items)}
    assert {i for i in few if i not in clean} == bad and out.columns == columns

    out = stages["secret scans"](spark, out, sf_dir)
    made = {r.doc_id: r for r in out.collect()}
    assert {i: r.text for i, r in made.items()} == {i: masked(rows[i].text) for i in clean}
    assert out.columns == columns and out.schema == docs.schema

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = {r.doc_id: r.ids for r in stages["byte-level BPE"](spark, out, sf_dir).collect()}
    assert out == {i: own.encode_ordinary(r.text) for i, r in made.items()}

    ran = corpus_pipeline.run(spark, sf_dir)
    assert {r.doc_id: r.ids for r in ran.collect()} == out


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_awkward_rows(spark, sf_dir, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    docs = edge(spark)
    out = stage(spark, docs, sf_dir)
    if name != "byte-level BPE":
        assert out.columns == docs.columns
    assert out.count() <= len(edge_rows())
    assert stage(spark, nothing(spark), sf_dir).count() == 0
