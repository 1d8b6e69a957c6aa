"""Operators that work on each text, against plain Python."""

from __future__ import annotations

import base64
import hashlib
import re
import string
import time
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from edge import edge, edge_rows, nothing
from wardlake.llm import licenses, perplexity, secrets
from wardlake.llm.bpe import codec, tokenize
from wardlake.llm.queries import ORACLE, QUERIES

VOCABULARY = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def sample(sf_dir: str) -> list[tuple]:
    return duckdb.sql(f"SELECT doc_id, text, lang FROM '{sf_dir}/documents.parquet' ORDER BY doc_id").fetchall()


@pytest.fixture(scope="module")
def reference_codec():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_bpe_equals_the_public_library(spark, sf_dir, reference_codec):
    got = {r.doc_id: r for r in QUERIES["op8_byte_bpe"](spark, sf_dir).collect()}
    for doc_id, text, _ in sample(sf_dir):
        ids = reference_codec.encode_ordinary(text)
        row = got[doc_id]
        assert row.n_tokens == len(ids)
        assert row.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()


def test_bpe_long_pre_tokens(reference_codec):
    own = codec(VOCABULARY, public_tokenizers.PATTERN)
    for piece in ("aaaa" * 700, "abcdé" * 900, "the" * 1000, "x", "ß" * 777):
        assert own.merge(piece.encode()) == reference_codec.encode_ordinary(piece)
        assert own.decode(own.merge(piece.encode())) == piece.encode()


def test_bpe_edges(spark):
    out = tokenize(edge(spark), VOCABULARY, public_tokenizers.PATTERN, outputs=("ids", "decoded", "n_tokens")).collect()
    assert sorted(bytes(r.decoded).decode() for r in out) == sorted(t[1] or "" for t in edge_rows())
    assert all(len(r.ids) == r.n_tokens for r in out)
    assert tokenize(nothing(spark), VOCABULARY, public_tokenizers.PATTERN).count() == 0


def plain_license(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    found = []
    for phrase, label in (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")):
        p = phrase.split()
        found += [(k, label) for k in range(len(words)) if words[k : k + len(p)] == p]
    starts = [k for k, _ in found]
    return len(words), len(found), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in found}))


def test_license_base(spark, sf_dir):
    rows = [(i, t) for i, t, _ in sample(sf_dir)] + [(10**6 + k, r[1]) for k, r in enumerate(edge_rows())]
    out = licenses.license_scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    assert len(out) == len(rows)
    texts = dict(rows)
    for r in out:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_license(texts[r.doc_id])
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1


def edits_to_substring(needle: str, text: str) -> int:
    """Least edits from the needle to any part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(needle, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (a != b)))
        row = new
    return min(row)


@pytest.mark.parametrize("text", ["xx licensed undr the apache licence version 2 0 yy", "Permission is hereby granted, free of charge to any persn obtaining a copy", "no notice here at all", "generl public licensse", "all right reserved", "released under a mit license"])
def test_license_fuzzy_finds_what_a_full_search_finds(text):
    row = licenses.scan_text(text)
    words = " ".join(re.findall("[a-z0-9]+", text.lower()))
    near = {n.label for n in licenses.NOTICES if edits_to_substring(n.text, words) <= n.edits}
    assert set(filter(None, row["labels"].split(","))) == near
    for span in row["spans"]:
        assert 0 <= span["start_word"] < span["end_word"] <= row["n_words"]


def places_of(notice, words: str) -> int:
    """Groups of places at which a full search ends a notice within its edits."""
    row, near = list(range(len(notice.text) + 1)), []
    for j, b in enumerate(words):
        new = [0]
        for i, a in enumerate(notice.text, 1):
            new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (a != b)))
        row = new
        if row[-1] <= notice.edits:
            near.append(j)
    return sum(1 for a, b in zip([-99, *near], near) if b - a > len(notice.text) // 2)


def test_license_spans_of_adjacent_edited_notices():
    spans = licenses.scan_text("all rigts reserved " * 3 + "all rights reserved")["spans"]
    assert [(s["start_word"], s["end_word"], s["edits"]) for s in spans] == [(0, 3, 1), (3, 6, 1), (6, 9, 1), (9, 12, 0)]
    rng = np.random.default_rng(5)
    for notice in licenses.NOTICES:
        for _ in range(3):
            copies = []
            for _ in range(6):
                made = list(notice.text)
                for at in rng.choice(range(1, len(made) - 1), rng.integers(0, notice.edits + 1), replace=False):
                    made[at] = rng.choice(["", "z", made[at] + "z"]) if made[at] != " " else " "
                copies.append("".join(made))
            words = " ".join(copies)
            found = [s for s in licenses.scanner((notice,)).fuzzy(words)]
            assert len(found) == places_of(notice, words) == 6


def test_license_long_texts_take_linear_time():
    """A megabyte of edited notices; and the same spans as in short texts."""
    some = "all rigts reserved released undr the mit license general publc license cc by "
    start = time.process_time()
    row = licenses.scan_text(some * 14_000)
    assert time.process_time() - start < 10
    few = licenses.scan_text(some * 4)
    words = len(some.split())
    inner = [(s["label"], s["start_word"], s["end_word"], s["edits"]) for s in few["spans"]]
    expected = sorted((a, b % words + k * words, c - b + b % words + k * words, d) for a, b, c, d in set(x for x in inner if x[1] < words) for k in range(14_000))
    assert sorted((s["label"], s["start_word"], s["end_word"], s["edits"]) for s in row["spans"]) == expected
    assert row["n_base"] == 14_000 and row["last_word"] == words * 14_000 - 2


def test_license_edges(spark):
    assert licenses.license_scan(nothing(spark)).count() == 0
    assert licenses.license_scan(edge(spark)).count() == len(edge_rows())


def plain_counts(text):
    text = text or ""
    pattern = re.compile(r"[^\x20\x09-\x0D]+")
    words = pattern.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if pattern.search(line):
            dup += line in seen
            seen.add(line)
    grams = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
    times = Counter(grams)
    covered = {k + j for k, g in enumerate(grams) if times[g] > 1 for j in range(8)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered)


def test_quality_rule_counts(spark, sf_dir):
    rows = sample(sf_dir) + [(10**6 + k, r[1], r[2]) for k, r in enumerate(edge_rows())]
    out = perplexity.quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()
    assert len(out) == len(rows)
    texts = {i: t for i, t, _ in rows}
    for r in out:
        n, chars, symbols, dup, repeat = plain_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n, chars, symbols, dup, repeat)
        assert r.base_failed == (n < 20 or 100 * repeat > 30 * n)
        assert not (r.kept and r.base_failed)
    fine = [r for r in out if not r.base_failed]
    assert sum(r.kept for r in fine) > 0.9 * len(fine)


def plain_kneser_ney(texts: list[str], order: int) -> dict[tuple, float]:
    """Interpolated modified Kneser-Ney by the textbook, over tuples of symbols."""
    grams = Counter()
    for t in texts:
        s = [0] * (order - 1) + [ord(c) + 1 for c in t]
        grams.update(tuple(s[k : k + order]) for k in range(len(t)))
    tables = {order: grams}
    for n in range(order - 1, 0, -1):
        tables[n] = Counter(g[1:] for g in tables[n + 1])
    p = {}
    for n in range(1, order + 1):
        t, of = tables[n], Counter(tables[n].values())
        y = of[1] / (of[1] + 2 * of[2])
        raw = [1 - 2 * y * of[2] / of[1], 2 - 3 * y * of[3] / of[2], 3 - 4 * y * of[4] / of[3] if of[3] else 1.5]
        d = [min(max(x, 0.05), k - 0.05) for x, k in zip(raw, (1, 2, 3))]
        total, rest = Counter(), Counter()
        for g, c in t.items():
            total[g[:-1]] += c
            rest[g[:-1]] += d[min(c, 3) - 1]
        for g, c in t.items():
            back = p[g[1:]] if n > 1 else 1 / 0x110000
            p[g] = (c - d[min(c, 3) - 1]) / total[g[:-1]] + rest[g[:-1]] / total[g[:-1]] * back
    return p


def test_kneser_ney_probabilities(spark):
    texts = ["the cat sat on the mat", "the dog sat on the log", "a cat and a dog", "été et thé"] * 2 + ["banana bandana"]
    table = perplexity.probabilities(perplexity.count_ngrams(spark.createDataFrame([(t,) for t in texts], "text string")))
    expected = plain_kneser_ney(texts, perplexity.ORDER)
    got = {tuple((r.head << 63 | r.gram) >> (21 * k) & 0x1FFFFF for k in reversed(range(perplexity.ORDER))): r.p for r in table.collect()}
    assert got.keys() == {g for g in expected if len(g) == perplexity.ORDER}
    for gram, p in got.items():
        assert p == pytest.approx(expected[gram])


def test_perplexity_rejects_other_text(spark):
    prose = [(k, f"the river ran down to the sea and the boats went with it on day {k} of the year as they do", "en") for k in range(300)]
    odd = [(1000, "".join(chr(33 + (k * 7919 + k * k * 31) % 90) + (" " if k % 6 == 5 else "") for k in range(600)), "en")]
    out = {r.doc_id: r.kept for r in perplexity.quality_rules(spark.createDataFrame(prose + odd, "doc_id bigint, text string, lang string")).collect()}
    assert not out[1000] and all(out[k] for k in range(300))


def random_texts():
    """Words of random characters, marked 'en'."""
    rng = np.random.default_rng(11)
    alphabets = ["".join(map(chr, range(33, 127))), string.ascii_letters + string.digits + "+/", string.ascii_lowercase]
    random = ["".join(rng.choice(list(a), rng.integers(300, 3000))) for a in alphabets for _ in range(8)]
    return [(10**7 + k, " ".join(r[k : k + 6] for k in range(0, len(r), 6)), "en") for k, r in enumerate(random)]


def kept_of(spark, rows):
    out = perplexity.quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()
    return {r.doc_id: r.kept for r in out if not r.base_failed}


def test_perplexity_rejects_planted_texts(spark, sf_dir):
    docs = sample(f"{sf_dir}/../sf0.01")
    planted = random_texts()
    kept = kept_of(spark, docs + planted)
    assert not any(kept[k] for k, _, _ in planted)
    given = [kept[k] for k, _, _ in docs if k in kept]
    assert sum(given) > 0.9 * len(given)


def test_perplexity_bands_have_the_spread_of_their_language(spark, sf_dir):
    docs = sample(f"{sf_dir}/../sf0.01")
    other = [t for of in ("de", "es", "fr") for t in [t for _, t, lang in docs if lang == of and len(t) > 500][:10]]
    planted = [(2 * 10**7 + k, t, "en") for k, t in enumerate(other)]
    # copies of one text must not narrow the band
    copies = [(3 * 10**7 + k, docs[0][1], docs[0][2]) for k in range(2000)]
    kept = kept_of(spark, docs + planted + copies)
    assert not any(kept.get(k) for k, _, _ in planted)
    given = [kept[k] for k, _, _ in docs if k in kept]
    assert sum(given) > 0.9 * len(given)


def test_perplexity_keeps_every_ngram_at_any_size(spark, sf_dir, monkeypatch):
    rows = sample(sf_dir) + random_texts()
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    one = {r.doc_id: r.perplexity for r in perplexity.quality_rules(docs).collect()}
    counts = perplexity.count_ngrams(docs, "text", F.col("lang"), perplexity.FOLDS)
    n = counts.count()
    monkeypatch.setattr(perplexity, "RANGE", n // 3 + 1)
    table, ranges = perplexity.train(docs)
    assert ranges == 3 and sum(len(perplexity.load(table, k).hashes) for k in range(ranges)) == n
    assert {r.doc_id: r.perplexity for r in perplexity.quality_rules(docs).collect()} == pytest.approx(one, rel=3e-6)


def test_code_points_of_all_scripts_are_told_apart():
    text = "".join(map(chr, [*range(1, 0xD800), *range(0xE000, 0x30000, 7), 0x10FFFF]))
    data = np.frombuffer(text.encode(), np.uint8)
    found, starts = perplexity.symbols(data, np.array([0, len(data)]))
    assert found.tolist() == [ord(c) + 1 for c in text] and starts.tolist() == [0, len(text)]
    head, gram, _ = perplexity.ngrams(data, np.array([0, len(data)]))
    whole = [(int(h) << 63 | int(g)) for h, g in zip(head, gram)]
    padded = [0] * 4 + found.tolist()
    assert whole == [sum(padded[k + 4 - j] << (21 * j) for j in range(5)) for k in range(len(text))]


def test_perplexity_of_slices_shorter_than_an_ngram(spark):
    for n in range(6):
        data = np.frombuffer(b"abcde"[:n], np.uint8)
        assert len(perplexity.ngrams(data, np.array([0, n]))[0]) == n
    rows = [(1, "abc", "en"), (2, "many words " * 100_000, "en")]
    out = perplexity.quality_rules(spark.createDataFrame(rows, "doc_id bigint, text string, lang string").coalesce(1)).collect()
    assert {r.doc_id: r.n_words for r in out} == {1: 1, 2: 200_000}


def test_quality_rules_edges(spark):
    assert perplexity.quality_rules(nothing(spark)).count() == 0
    assert perplexity.quality_rules(edge(spark)).count() == len(edge_rows())


def plain_spans(text):
    text = text or ""
    out = []
    for rank, rule in enumerate(secrets.RULES):
        pattern = r"[0-9a-f]+" if rule.kind == "hex" else rule.pattern
        out += [(m.start(), rank, m.end()) for m in re.finditer(pattern, text) if len(m[rule.group]) >= rule.least]
    return sorted(out)


def test_secret_spans(spark, sf_dir, tmp_path):
    rows = [(i, t) for i, t, _ in sample(sf_dir)] + [(10**6 + k, r[1]) for k, r in enumerate(edge_rows())]
    texts = dict(rows)
    findings = secrets.scan_versions(spark.createDataFrame(rows, "doc_id bigint, text string"), str(tmp_path / "ledger"))
    got = secrets.digests(findings).collect()
    assert len(got) == len(rows)
    for r in got:
        spans = plain_spans(texts[r.doc_id])
        line = ",".join(f"{secrets.RULES[k].kind}:{a}:{b}" for a, k, b in spans)
        base = ",".join(f"{secrets.RULES[k].kind}:{a}:{b}" for a, k, b in spans if k < 3)
        assert (r.spans, r.base_sha256) == (line, hashlib.sha256(base.encode()).hexdigest())
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == j for _, k, _ in spans) for j in range(3))


def test_secret_sql_equals_query(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    expected = con.sql(ORACLE["op6_secret_ledger"])
    got = QUERIES["op6_secret_ledger"](spark, sf_dir).select(*expected.columns).collect()
    assert sorted(map(tuple, got)) == sorted(expected.fetchall())


def test_ledger_scans_only_what_is_new(spark, tmp_path):
    ledger = str(tmp_path / "ledger")
    one = spark.createDataFrame([("a", "token=abcdefgh1"), ("b", "clean"), ("c", "token=abcdefgh1")], "path string, text string")
    secrets.scan_versions(one, ledger, "path")
    assert spark.read.parquet(ledger).count() == 2
    two = spark.createDataFrame([("a", "clean"), ("d", "AKIA" + "A" * 16), (None, "token=abcdefgh1")], "path string, text string")
    out = {r.path: r.spans for r in secrets.scan_versions(two, ledger, "path").collect()}
    assert spark.read.parquet(ledger).count() == 3
    assert out["a"] is None and out["d"][0]["kind"] == "access" and out[None][0]["kind"] == "assign"
    secrets.scan_versions(two, ledger, "path", rules_version="2")
    assert spark.read.parquet(ledger).where("rules_version = '2'").count() == 3


def test_redaction(spark, tmp_path):
    out = secrets.redact(edge(spark), str(tmp_path / "ledger"))
    assert out.columns == edge(spark).columns
    def plain(text):
        if text is None:
            return None
        made, at = "", 0
        for a, _, b in plain_spans(text):
            if a < at:
                made += text[at : at] if b <= at else ""
            else:
                made += text[at:a] + "<secret>"
            at = max(at, b)
        return made + text[at:]
    assert sorted(str(r.text) for r in out.collect()) == sorted(str(plain(r[1])) for r in edge_rows())
    assert secrets.redact(nothing(spark), str(tmp_path / "other")).count() == 0


def test_secret_plan_stays_in_the_jvm(spark, tmp_path):
    plan = secrets.scan_versions(edge(spark), str(tmp_path / "ledger"))._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_structured_lines_and_texts_are_told_apart(spark):
    from test_jaccard import thue_morse
    from wardlake.llm.perplexity import quality_rules
    from wardlake.llm.suffixes import without_repeats

    one, other = thue_morse()
    docs = spark.createDataFrame([(1, f"{one}\n{other}", "en"), (2, f"{one}\n{one}", "en")], "doc_id bigint, text string, lang string")
    assert {r.doc_id: r.n_dup_lines for r in quality_rules(docs).collect()} == {1: 0, 2: 1}
    two = spark.createDataFrame([(1, one), (2, other)], "doc_id bigint, text string")
    assert {r.doc_id: bytes(r.kept) for r in without_repeats(two).collect()} == kept_by_force([one, other])


def kept_by_force(texts):
    """What stays when bytes of repeated 200-byte strings go."""
    seen = {}
    for k, t in enumerate(texts):
        for at in range(len(t) - 199):
            seen.setdefault(t[at : at + 200], []).append((k, at))
    gone = [set() for _ in texts]
    for places in seen.values():
        if len(places) > 1:
            for k, at in places:
                gone[k].update(range(at, at + 200))
    return {k + 1: "".join(c for i, c in enumerate(t) if i not in gone[k]).encode() for k, t in enumerate(texts)}


def test_a_ledger_entry_that_stands_twice_changes_nothing(spark, tmp_path):
    from wardlake.llm.secrets import scan_versions

    docs = spark.createDataFrame([(1, "password = hunter2hunter2"), (2, "nothing")], "doc_id bigint, text string")
    ledger = str(tmp_path / "ledger")
    once = sorted(map(str, scan_versions(docs, ledger).collect()))
    spark.read.parquet(ledger).write.mode("append").parquet(ledger)
    assert sorted(map(str, scan_versions(docs, ledger).collect())) == once
