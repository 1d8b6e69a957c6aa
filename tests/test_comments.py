"""Text rules, comment layers and terms."""

import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from test_cleaning import mapped
from wardlake.functions import defaults as d
from wardlake.functions import text as t
from wardlake.operators import terms
from wardlake.operators.dedup import keep_first
from wardlake.operators.terms import most_frequent, term_counts, term_ranks, tfidf_terms
from wardlake.plans.comments import comments_silver, comments_staging, sentiment_gold

STOPWORDS = (*t.Lexicon().words, *d.TFIDF_EXTRA_STOPWORDS)


def test_clean_text(spark):
    raw = [
        "Veja http://x.y/z @joão #saúde ok!", None, "a\u0085b c\td", "ehttps://q @a#b_c-d", "R$ 10,50 (sim)?", "@@x ##", "", "ção_1 ü ñ",
    ]
    want = ["Veja ok!", "", "a b c d", "e d", "R 10,50 sim ?", "", "", "ção_1 ü ñ"]
    assert mapped(spark, t.clean_text, raw) == want


def test_tokens_and_digest(spark):
    assert mapped(spark, t.tokens, ["O Pré é bom_1, a-bcd éàç."]) == [["pré", "bom_1", "bcd", "éàç"]]
    many = " ".join(f"w{i:03}" for i in range(50))
    assert mapped(spark, lambda v: t.digest(t.tokens(v)), [many]) == [" ".join(f"w{i:03}" for i in range(30))]


def test_lexicon_hits_are_substrings(spark):
    texts = ["excelentes talento fila", "bombom bom", "nada aqui"]
    assert mapped(spark, lambda v: t.lexicon_hits(t.tokens(v), d.POSITIVE_WORDS), texts) == [1, 2, 0]
    assert mapped(spark, lambda v: t.lexicon_hits(t.tokens(v), d.NEGATIVE_WORDS), texts) == [2, 0, 0]
    assert mapped(spark, lambda v: t.lexicon_hits(t.tokens(v), ()), texts) == [0, 0, 0]


def judged(spark, texts):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, texto_limpo string")
    rows = sorted(sentiment_gold(df).collect(), key=lambda r: r.i)
    return [(r.sentimento, r.score_sentimento) for r in rows]


def test_sentiment(spark):
    texts = [
        "Nao gostei da limpeza do quarto.", "Não gostei da limpeza do quarto.", "Normal, nem bom nem ruim.", "", "talento",
        "excelente", "nao gostei", "anormal normal excelente", "nem bom nem ruim excelente excelente",
    ]
    assert judged(spark, texts) == [
        ("negativo", -0.75), ("negativo", -0.75), ("neutro", 0.0), ("neutro", 0.0), ("negativo", -1.0),
        ("positivo", 1.0), ("negativo", -1.0), ("neutro", 0.0), ("neutro", 0.0),
    ]


def test_sentiment_limits_are_strict(spark):
    filler = [f"zz{i:02}" for i in range(17)]
    three_of_twenty = " ".join(["excelente"] * 3 + filler)
    three_of_nineteen = " ".join(["ruim"] * 3 + filler[:16])
    assert judged(spark, [three_of_twenty, three_of_nineteen]) == [("neutro", 0.15), ("negativo", -0.158)]


COMMENT = "comment_id string, post_id string, autor string, data_comentario string, curtidas string, texto_comentario string, pos int"


def test_silver_dedupes_before_length(spark):
    rows = [
        ("1", "p", "a", "2024-01-02", "5", "ok", 1),
        ("1", "p", "a", "2024-01-02", "5", "muito bom", 2),
        ("2", "p", "a", "sem data", "x", "primeiro texto", 3),
        ("2", "p", "b", "2024-01-02", "9", "segundo texto", 4),
        (None, "p", "a", None, None, "sem id um", 5),
        (None, "p", "a", None, None, "sem id dois", 6),
        ("3", "p", "a", None, None, None, 7),
        ("4", "p", "a", None, "3.7", "#tag http://x abc", 8),
    ]
    silver = comments_silver(spark.createDataFrame(rows, COMMENT), [F.asc("pos")])
    got = sorted((r.comment_id or "", r.texto_limpo, r.curtidas, r.data_comentario) for r in silver.collect())
    assert got == [("", "sem id um", 0, None), ("2", "primeiro texto", 0, None), ("4", "abc", 3, None)]


def test_silver_adds_missing_columns(spark):
    df = spark.createDataFrame([("1", "um texto", 1)], " Comment_ID string, TEXTO_COMENTARIO string, pos int".replace(" Comment_ID", "Comment_ID"))
    row = comments_silver(df, [F.asc("pos")]).first()
    assert (row.comment_id, row.post_id, row.autor, row.curtidas, row.texto_limpo) == ("1", None, None, 0, "um texto")


def test_keep_first_with_a_hot_key(spark):
    df = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("k"), (30000 - F.col("id")).alias("o")
    )
    kept = keep_first(df, ["k"], [F.asc("o")])
    # 20,000 ids are their own key, but one of them, 7, is the hot key as well.
    assert kept.count() == 20000
    assert kept.filter("k = 7").first().o == 30000 - 29997


def brute_tfidf(docs, top, stopwords, vocabulary=None):
    """Scores of one class's texts, straight from the definition."""
    bags = [Counter(w for w in re.findall(r"\w\w+", text.lower()) if w not in stopwords) for text in docs]
    total = Counter()
    for bag in bags:
        total.update(bag)
    terms = vocabulary or [w for w, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:top]]
    idf = {w: math.log((1 + len(docs)) / (1 + sum(w in b for b in bags))) + 1 for w in terms}
    scores = Counter()
    for bag in bags:
        weights = {w: bag[w] * idf[w] for w in terms}
        norm = math.sqrt(sum(x * x for x in weights.values()))
        if norm:
            for w, x in weights.items():
                scores[w] += x / norm
    return {w: scores[w] for w in terms}


TEXTS = {
    "positivo": [
        "A equipe do hospital foi ótima, a equipe salvou", "Equipe boa! Hospital limpo e hospital calmo.", "já já já é", "é a o", "que mas com",
    ],
    "negativo": ["Espera longa, espera sem fim", "Quarto frio; espera."],
    "neutro": ["um texto só"],
}


@pytest.mark.parametrize("top", [1, 3, 15])
def test_tfidf_against_brute_force(spark, top):
    df = spark.createDataFrame([(k, v) for k, vs in TEXTS.items() for v in vs], "sentimento string, texto_limpo string")
    got = {(r.sentimento, r.termo): r.score_tfidf for r in tfidf_terms(df, top=top, stopwords=STOPWORDS).collect()}
    want = {
        (k, w): s for k, vs in TEXTS.items() if len(vs) >= 2 for w, s in brute_tfidf(vs, top, STOPWORDS).items()
    }
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_tfidf_with_given_vocabulary(spark):
    df = spark.createDataFrame([(k, v) for k, vs in TEXTS.items() for v in vs], "sentimento string, texto_limpo string")
    listed = {"positivo": ["hospital", "limpo"], "negativo": ["espera", "frio", "fim"], "neutro": ["texto"]}
    vocabulary = spark.createDataFrame([(k, w) for k, ws in listed.items() for w in ws], "k string, w string")
    got = {(r.sentimento, r.termo): r.score_tfidf for r in tfidf_terms(df, vocabulary=vocabulary).collect()}
    want = {(k, w): s for k in ("positivo", "negativo") for w, s in brute_tfidf(TEXTS[k], 0, (), listed[k]).items()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_tfidf_without_any_term(spark):
    df = spark.createDataFrame([("positivo", "bom"), ("positivo", "a")], "sentimento string, texto_limpo string")
    assert tfidf_terms(df, stopwords=STOPWORDS).count() == 0


def test_term_counts_and_ranks(spark):
    rows = [("positivo", "equipe equipe, para casa abc"), ("positivo", "Equipe!"), ("negativo", "fila fila casa"), ("neutro", " "), ("neutro", None)]
    counts = term_counts(spark.createDataFrame(rows, "sentimento string, texto_limpo string"))
    assert [(r.sentimento, r.termo, float(r.score_tfidf)) for r in term_ranks(counts).collect()] == [
        ("negativo", "fila", 2.0), ("negativo", "casa", 1.0), ("positivo", "equipe", 3.0), ("positivo", "casa", 1.0),
    ]
    cut = term_counts(spark.createDataFrame(rows, "sentimento string, texto_limpo string"), top=3)
    assert {(r.sentimento, r.termo) for r in cut.collect()} == {("positivo", "equipe"), ("negativo", "fila"), ("negativo", "casa")}


def test_term_counts_take_every_word(spark):
    long_text = " ".join(f"palavra{k:03}" for k in range(200)) + " palavra150"
    counts = term_counts(spark.createDataFrame([("neutro", long_text)], "sentimento string, texto_limpo string"), top=1000)
    assert {r.termo: int(r.score_tfidf) for r in counts.collect()} == {f"palavra{k:03}": 1 + (k == 150) for k in range(200)}


def test_term_counts_beyond_a_million(spark):
    texts = spark.range(1001).select(F.lit("neutro").alias("sentimento"), F.repeat(F.lit("fila "), F.lit(1000)).alias("texto_limpo"))
    ranked = term_ranks(term_counts(texts)).collect()
    assert [(r.termo, int(r.score_tfidf), r.rank_termo) for r in ranked] == [("fila", 1_001_000, 1)]


def test_most_frequent_terms_of_a_class(spark):
    rows = [("c", f"t{k:05}", 1 + k % 50, 1) for k in range(8000)]
    counts = spark.createDataFrame(rows, "_class string, _term string, _occurrences int, _df int")
    want = [r[1] for r in sorted(rows, key=lambda r: (-r[2], r[1]))[:1500]]
    assert sorted(r._term for r in most_frequent(counts, 1500).collect()) == sorted(want)


def test_tfidf_joins_the_vocabulary(spark):
    """No broadcast is asked for, and no row carries the vocabulary."""
    df = spark.createDataFrame([("positivo", "bom dia"), ("positivo", "bom")], "sentimento string, texto_limpo string")
    text = tfidf_terms(df, top=5000)._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in text and "array_agg" not in text and "collect_list" not in text


def test_tfidf_tasks_follow_the_pairs(spark, monkeypatch):
    """Texts are counted before they are shuffled, and no task gets more than a set number of pairs."""
    monkeypatch.setattr(terms, "PAIRS_AT_ONCE", 40)
    rng = random.Random(3)
    docs = [" ".join(rng.choices([f"termo{k}" for k in range(12)], k=30)) for _ in range(100)]
    df = spark.createDataFrame([("positivo", text) for text in docs], "sentimento string, texto_limpo string")
    scored = tfidf_terms(df, top=8)
    got = {r.termo: r.score_tfidf for r in scored.collect()}
    want = brute_tfidf(docs, 8, ())
    assert got.keys() == want.keys() and all(abs(got[w] - want[w]) < 1e-9 for w in want)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    tasks = re.search(r"hashpartitioning\(_class#\d+, _doc#\d+L, (\d+)\), REPARTITION_BY_NUM", plan)
    pairs = sum(w in text.split() for text in docs for w in want)
    assert int(tasks.group(1)) == pairs // 40 + 1
    assert "regexp_extract_all" not in plan


def test_comment_staging_types(spark):
    df = spark.createDataFrame([("1", "p", "a", "2024-01-02", "5", "excelente equipe aqui", 1)], COMMENT)
    staged = comments_staging(sentiment_gold(comments_silver(df, [F.asc("pos")])))
    assert dict(staged.dtypes)["score_sentimento"] == "decimal(6,3)"
    assert str(staged.first().score_sentimento) == "0.333"


def test_hand_worked_results(spark):
    """Labels, scores and term weights worked out by hand from the definitions."""
    texts = [
        ("1", "Excelente equipe, muito bom", "positivo", 0.5),  # 2 of 4
        ("2", "Equipe excelente", "positivo", 0.5),  # 1 of 2
        ("3", "Fila enorme", "negativo", -1.0),
        ("4", "fila, fila e demora", "negativo", -1.0),
        ("5", "Não gostei do atendimento", "negativo", -0.667),  # two of three
        ("6", "nem bom nem ruim, normal", "neutro", 0.0),
        ("7", "Consulta marcada para segunda", "neutro", 0.0),
    ]
    df = spark.createDataFrame([(i, "p", "a", None, None, t, int(i)) for i, t, *_ in texts], COMMENT)
    gold = sentiment_gold(comments_silver(df, [F.asc("pos")]))
    got = {r.comment_id: (r.sentimento, float(r.score_sentimento)) for r in gold.collect()}
    assert got == {i: (label, score) for i, _, label, score in texts}
    # positive: both texts hold "equipe" and "excelente" (idf 1); only the first holds "muito" and
    # "bom" (idf ln(3/2) + 1).
    rare = math.log(3 / 2) + 1
    norm = math.sqrt(2 + 2 * rare * rare)
    want = {"equipe": 1 / norm + 1 / math.sqrt(2), "excelente": 1 / norm + 1 / math.sqrt(2), "muito": rare / norm, "bom": rare / norm}
    terms = {r.termo: r.score_tfidf for r in tfidf_terms(gold).collect() if r.sentimento == "positivo"}
    assert terms.keys() == want.keys() and max(abs(terms[k] - want[k]) for k in want) < 1e-12
