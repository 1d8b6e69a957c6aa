"""Suffix dedup against a count of all strings."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import duckdb
import pytest

from edge import edge, edge_rows, nothing
from wardlake.llm import suffixes
from wardlake.llm.queries import QUERIES


def plain(texts, length):
    """(removed, spans, kept) for each text."""
    raw = [(t or "").encode() for t in texts]
    times = Counter(b[k : k + length] for b in raw for k in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if times[b[k : k + length]] > 1:
                gone[k : k + length] = b"\x01" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for k in range(len(b)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((len(b) - len(kept), runs, kept))
    return out


def check(spark, rows, length, **options):
    got = suffixes.without_repeats(spark.createDataFrame(rows, "doc_id bigint, text string"), length, **options).collect()
    want = plain([t for _, t in rows], length)
    assert sorted(((r.doc_id, r.n_bytes - len(r.kept), len(r.spans), bytes(r.kept)) for r in got), key=str) == sorted(((i, *w) for (i, _), w in zip(rows, want)), key=str)


def planted(rng, n):
    letters = "abcdefgh é"
    def prose(k):
        return "".join(rng.choice(letters) for _ in range(k))
    shared = [prose(rng.choice([15, 24, 40, 90])) for _ in range(6)]
    rows = []
    for k in range(n):
        text = "".join(rng.choice([prose(rng.randrange(0, 60)), rng.choice(shared), rng.choice(shared)[5:35]]) for _ in range(rng.randrange(1, 6)))
        if k % 7 == 3 and rows:
            text = rows[-1][1]
        if k % 11 == 5 and rows:
            at = rng.randrange(len(rows[-2][1]) + 1)
            text = rows[-2][1][:at] + "#" + rows[-2][1][at:]
        rows.append((k, text))
    return rows + [(n, "a" * 100), (n + 1, "ab" * 70), (n + 2, "abc" * 9), (n + 3, None), (n + 4, ""), (n + 5, "xyz" * 200)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_planted_strings(spark, seed):
    check(spark, planted(random.Random(seed), 220), 20)


def test_groups_across_parts(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "PART_BYTES", 300)
    check(spark, planted(random.Random(4), 200), 20)


def test_false_marks_change_nothing(spark):
    check(spark, planted(random.Random(5), 150), 20, filter_bits=8)


def test_edges(spark):
    rows = [(r[0], r[1]) for r in edge_rows()]
    got = suffixes.without_repeats(edge(spark)).collect()
    want = plain([t for _, t in rows], 200)
    assert sorted(bytes(r.kept) for r in got) == sorted(w[2] for w in want)
    assert suffixes.without_repeats(nothing(spark)).count() == 0


def test_query_on_the_given_tables(spark, sf_dir):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet' ORDER BY doc_id").fetchall()
    got = {r.doc_id: r for r in QUERIES["op10_suffix_dedup"](spark, sf_dir).collect()}
    for (i, text), (removed, spans, kept) in zip(rows, plain([t for _, t in rows], 200)):
        r = got[i]
        assert (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) == (len((text or "").encode()), removed, spans, hashlib.sha256(kept).hexdigest())


def test_merge_never_rereads_known_prefixes(monkeypatch):
    rng = random.Random(6)
    runs = [sorted({bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 30))) for _ in range(50)}) for _ in range(5)]
    looked = []
    real = suffixes.common
    monkeypatch.setattr(suffixes, "common", lambda a, b, known: (looked.append(a[:known] == b[:known]), real(a, b, known))[1])
    def stream(run):
        last = b""
        for key in run:
            yield real(last, key, 0), suffixes.Record(key, len(key), False)
            last = key
    out = list(suffixes.merged([stream(r) for r in runs]))
    keys = [r.key for _, r in out]
    assert keys == sorted(k for r in runs for k in r) and all(looked)
    assert [s for s, _ in out[1:]] == [real(a, b, 0) for a, b in zip(keys, keys[1:])]
    blobs = suffixes.coded([suffixes.Record(k, len(k), False) for k in runs[0]])
    assert [r.key for _, r in suffixes.decoded(blobs)] == runs[0]
