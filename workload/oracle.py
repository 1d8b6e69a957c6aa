"""The same queries in SQL over the same tables, written apart from the Spark code."""

from __future__ import annotations

from wardlake.functions.defaults import NEGATIVE_WORDS, POSITIVE_WORDS

ORACLE: dict[str, str] = {}

WORD = r"[\p{L}\p{N}_]"
SPACE = r"\x09-\x0d\x1c-\x20\x85\p{Z}"
BLANKS = "chr(9)||chr(10)||chr(11)||chr(12)||chr(13)||' '||chr(160)"


def title(value: str) -> str:
    runs = rf"regexp_extract_all({value}, '(\p{{L}}+|\P{{L}}+)')"
    return f"array_to_string(list_transform({runs}, lambda r: upper(r[1]) || lower(r[2:])), '')"


def band(age: str) -> str:
    return (
        f"CASE WHEN {age} IS NULL THEN 'Não informado' WHEN {age} <= 17 THEN '0-17' "
        f"WHEN {age} <= 39 THEN '18-39' WHEN {age} <= 59 THEN '40-59' ELSE '60+' END"
    )


def sex(raw: str) -> str:
    text = f"upper(trim({raw}, {BLANKS}))"
    return (
        f"CASE WHEN {text} IN ('M', 'MASCULINO', '1') THEN 'Masculino' "
        f"WHEN {text} IN ('F', 'FEMININO', '2') THEN 'Feminino' ELSE 'Não informado' END"
    )


def share(part: str, total: str) -> str:
    """Percentage with two decimals, half up."""
    return f"((20000 * CAST({part} AS BIGINT) + CAST({total} AS BIGINT)) // (2 * CAST({total} AS BIGINT))) / 100.0::DOUBLE"


def capital(name: str) -> str:
    return f"CASE WHEN contains(lower({name}), 'nation_1') THEN 'Capital' ELSE 'Interior' END"


def parts(date: str) -> str:
    return (
        f"CAST(year({date}) AS BIGINT) AS ano, CAST(month({date}) AS BIGINT) AS mes, "
        f"strftime({date}, '%Y-%m') AS ano_mes, CAST(quarter({date}) AS BIGINT) AS trimestre"
    )


# --- Admissions ----------------------------------------------------------------------

ADM = """adm AS (
  SELECT CAST(l_shipdate AS DATE) AS data_internacao, p_type AS especialidade_hospitalar,
         n_name AS municipio_residencia, CAST(n_nationkey AS VARCHAR) AS codigo_municipio_ibge,
         CASE WHEN p_size % 10 = 0 THEN NULL ELSE p_size * 2 END AS idade,
         CASE l_returnflag WHEN 'A' THEN 'F' WHEN 'R' THEN 'M' ELSE 'NI' END AS sexo_paciente,
         l_linenumber AS numero_internacoes
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey)"""

RAW = """raw AS (
  SELECT CASE WHEN numero_internacoes = 2 THEN strftime(data_internacao, '%d/%m/%Y')
              WHEN numero_internacoes = 6 THEN 'sem data'
              WHEN numero_internacoes <> 7 THEN CAST(data_internacao AS VARCHAR) END AS data_internacao,
         CASE WHEN numero_internacoes <> 5 THEN ' ' || lower(especialidade_hospitalar) || '-d''Água ' END AS especialidade_hospitalar,
         CASE WHEN codigo_municipio_ibge <> '3' THEN chr(9) || municipio_residencia || ' ' END AS municipio_residencia,
         CASE WHEN codigo_municipio_ibge <> '4' THEN codigo_municipio_ibge END AS codigo_municipio_ibge,
         CAST(idade AS VARCHAR) || '.75' AS idade,
         CASE WHEN numero_internacoes = 1 THEN 'masculino ' WHEN numero_internacoes = 3 THEN ' 2'
              ELSE lower(sexo_paciente) END AS sexo_paciente,
         CASE WHEN numero_internacoes = 4 THEN 'x'
              WHEN numero_internacoes <> 3 THEN CAST(numero_internacoes AS VARCHAR) || '.9' END AS numero_internacoes,
         'Hospital Escola' AS nome_do_estabelecimento
  FROM adm)"""

RAW_SILVER = f"""dated AS (
  SELECT * REPLACE (
           CAST(coalesce(try_strptime(data_internacao, '%Y-%m-%d'), try_strptime(data_internacao, '%d/%m/%Y')) AS DATE) AS data_internacao,
           coalesce(trim(municipio_residencia, {BLANKS}), 'Não informado') AS municipio_residencia,
           coalesce(codigo_municipio_ibge, '0000000') AS codigo_municipio_ibge,
           CAST(trunc(TRY_CAST(idade AS DOUBLE)) AS BIGINT) AS idade,
           coalesce(CAST(trunc(TRY_CAST(numero_internacoes AS DOUBLE)) AS BIGINT), 1) AS numero_internacoes),
         coalesce({title("trim(especialidade_hospitalar, " + BLANKS + ")")}, 'Não informado') AS especialidade_padrao,
         {sex("sexo_paciente")} AS sexo
  FROM raw),
raw_silver AS (
  SELECT *, CASE especialidade_padrao WHEN 'Economy-D''Água' THEN 'Clínico' ELSE 'Outros' END AS grupo_especialidade,
         {band("idade")} AS faixa_etaria, {parts("data_internacao")}, {capital("municipio_residencia")} AS capital_interior
  FROM dated WHERE data_internacao IS NOT NULL)"""

STG = f"""named AS (
  SELECT *, CASE especialidade_hospitalar WHEN 'STANDARD' THEN 'Clínica Padrão' WHEN 'PROMO' THEN 'Promoção'
                 WHEN 'SMALL' THEN 'Pequena Cirurgia' ELSE {title("especialidade_hospitalar")} END AS especialidade_padrao
  FROM adm),
stg AS (
  SELECT data_internacao, especialidade_hospitalar, especialidade_padrao,
         CASE especialidade_padrao WHEN 'Clínica Padrão' THEN 'Clínico' WHEN 'Pequena Cirurgia' THEN 'Cirúrgico'
              WHEN 'Economy' THEN 'Clínico' ELSE 'Outros' END AS grupo_especialidade,
         CAST(numero_internacoes AS BIGINT) AS numero_internacoes, municipio_residencia, codigo_municipio_ibge,
         CAST(idade AS BIGINT) AS idade, {band("idade")} AS faixa_etaria, {sex("sexo_paciente")} AS sexo,
         {parts("data_internacao")}, {capital("municipio_residencia")} AS capital_interior
  FROM named)"""

STAGING = f"WITH {ADM}, {STG}"

ORACLE["q_normalize_columns"] = f"WITH {ADM}, {RAW} SELECT * FROM raw"
ORACLE["q_missing_columns"] = f"""WITH {ADM}
SELECT especialidade_hospitalar, CAST(numero_internacoes AS BIGINT) AS numero_internacoes,
       '0000000' AS codigo_municipio_ibge, CAST(NULL AS VARCHAR) AS autor FROM adm"""
FORMS = """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d, o_orderkey % 12 AS form, CASE o_orderkey % 12
    WHEN 0 THEN strftime(o_orderdate, '%Y-%m-%d') WHEN 1 THEN strftime(o_orderdate, '%d/%m/%Y')
    WHEN 2 THEN strftime(o_orderdate, '%Y-%m-%d 10:30') WHEN 3 THEN strftime(o_orderdate, '%Y/%m/%d')
    WHEN 4 THEN strftime(o_orderdate, '%Y-%m-%dT23:00:00Z') WHEN 5 THEN strftime(o_orderdate, '%Y-%m-%d 10:00:00.123')
    WHEN 6 THEN strftime(o_orderdate, '%Y%m%d') WHEN 7 THEN chr(9) || strftime(o_orderdate, '%Y-%m-%dT01:02:03-03:00 ')
    WHEN 8 THEN '31/02/1995' WHEN 9 THEN '  ' WHEN 11 THEN strftime(o_orderdate, '%Y-%m-%d 25:00') END AS texto FROM orders"""
ORACLE["q_date_coerce"] = f"SELECT o_orderkey, texto, strftime(d, '%Y-%m-%d') AS data FROM ({FORMS}) WHERE form < 8"
ORACLE["q_date_rejects"] = f"""SELECT o_orderkey, texto,
    CASE form WHEN 9 THEN 'blank' WHEN 10 THEN 'missing' ELSE 'unreadable' END AS problema FROM ({FORMS}) WHERE form >= 8"""
ORACLE["q_numeric_coerce"] = """
SELECT event_id, CAST(CASE event_type WHEN 'click' THEN trunc(value) WHEN 'view' THEN trunc(-value) ELSE 1 END AS BIGINT) AS n
FROM events"""
ORACLE["q_nan_to_null"] = "SELECT event_id, CASE WHEN event_type <> 'error' THEN value END AS value FROM events"
ORACLE["q_null_sentinels"] = """
SELECT c_custkey, CASE c_mktsegment WHEN 'MACHINERY' THEN '' WHEN 'BUILDING' THEN 'Não informado' ELSE c_mktsegment END AS municipio_residencia,
       CASE WHEN c_nationkey = 7 THEN '0000000' ELSE CAST(c_nationkey AS VARCHAR) END AS codigo_municipio_ibge
FROM customer"""
ORACLE["q_specialty_standard"] = f"""
WITH named AS (SELECT p_partkey, p_size, CASE WHEN p_size > 25 THEN p_type || '-d''ÁGUA 3rd x' ELSE p_type END AS v FROM part)
SELECT p_partkey, CASE WHEN p_size = 50 THEN 'Não informado' WHEN v = 'STANDARD' THEN 'Clínica Padrão' WHEN v = 'PROMO' THEN 'Promoção'
       WHEN v = 'SMALL' THEN 'Pequena Cirurgia' ELSE {title("v")} END AS especialidade_padrao
FROM named"""
ORACLE["q_specialty_group"] = f"""{STAGING}
SELECT especialidade_padrao, grupo_especialidade, grupo_especialidade AS grupo_por_join, count(*) AS n_rows
FROM stg GROUP BY ALL"""
ORACLE["q_age_band"] = f"""
WITH aged AS (SELECT p_partkey, CASE WHEN p_size % 10 <> 0
    THEN CAST(trunc(TRY_CAST(CAST((p_size - 2) * 2 AS VARCHAR) || '.9' AS DOUBLE)) AS BIGINT) END AS idade FROM part)
SELECT p_partkey, idade, {band("idade")} AS faixa_etaria FROM aged"""
ORACLE["q_sex_standard"] = """
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Feminino' WHEN 'O' THEN 'Masculino' ELSE 'Não informado' END AS sexo FROM orders"""
ORACLE["q_capital_flag"] = f"""{STAGING}
SELECT municipio_residencia, capital_interior, count(*) AS n_rows FROM stg GROUP BY ALL"""
ORACLE["q_date_parts"] = f"""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS data, {parts("o_orderdate")} FROM orders"""
ORACLE["q_period_filter"] = """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate
FROM lineitem WHERE year(l_shipdate) IN (1996, 1997, 2000)"""
ORACLE["q_admissions_silver"] = f"""WITH {ADM}, {RAW}, {RAW_SILVER}
SELECT * REPLACE (strftime(data_internacao, '%Y-%m-%d') AS data_internacao) FROM raw_silver"""
ORACLE["q_fact_grain"] = f"""{STAGING}
SELECT * EXCLUDE (especialidade_hospitalar) REPLACE (strftime(data_internacao, '%Y-%m-%d') AS data_internacao) FROM stg"""
ORACLE["q_staging_load"] = f"""{STAGING}
SELECT * REPLACE (strftime(data_internacao, '%Y-%m-%d') AS data_internacao) FROM stg"""
ORACLE["q_gold_monthly"] = f"""{STAGING}
SELECT ano_mes, especialidade_padrao, municipio_residencia, faixa_etaria, sexo, capital_interior,
       CAST(sum(numero_internacoes) AS BIGINT) AS qtd_internacoes
FROM stg GROUP BY ALL"""

# --- Sources and sinks ---------------------------------------------------------------

ORDERS = """
SELECT o_orderkey, o_custkey, o_orderpriority, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate,
       CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS o_totalprice"""
ORACLE["q_csv_roundtrip"] = f"{ORDERS} FROM orders"
ORACLE["q_csv_text_roundtrip"] = "SELECT doc_id, text FROM documents"
ORACLE["q_parquet_roundtrip"] = f"{ORDERS}, CAST(year(o_orderdate) AS BIGINT) AS ano FROM orders"
ORACLE["q_partition_pruning"] = """
SELECT CAST(1996 AS BIGINT) AS ano, o_orderpriority, count(*) AS n_orders
FROM orders WHERE year(o_orderdate) = 1996 GROUP BY o_orderpriority"""
ORACLE["q_multi_file_union"] = """
SELECT c_custkey, 'São ' || c_name AS c_name, c_mktsegment,
       CAST(CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN c_nationkey END AS BIGINT) AS c_nationkey
FROM customer"""
ORACLE["q_source_fallback"] = "SELECT 'customer' AS source, c_custkey, c_name FROM customer"
FLAT = """
SELECT conv_id || '-' || turn AS comment_id, CAST(conv_id AS VARCHAR) AS post_id,
       CASE WHEN role <> 'system' THEN role ELSE '' END AS autor,
       '2024-01-0' || CAST(turn % 9 + 1 AS VARCHAR) AS data_comentario,
       CAST(CASE WHEN turn > 0 THEN turn ELSE 0 END AS BIGINT) AS curtidas, coalesce(text, '') AS texto_comentario
FROM conversations"""
ORACLE["q_json_flatten"] = FLAT
ORACLE["q_json_flatten_first_posts"] = f"""WITH posts AS (
  SELECT DISTINCT conv_id, turn // 50 AS page FROM conversations),
placed AS (
  SELECT conv_id, page, row_number() OVER (PARTITION BY conv_id // 20, page ORDER BY conv_id) AS place FROM posts)
SELECT flat.* FROM ({FLAT}) flat JOIN conversations c ON flat.comment_id = c.conv_id || '-' || c.turn
JOIN placed p ON c.conv_id = p.conv_id AND c.turn // 50 = p.page WHERE p.place <= 10"""
ORACLE["q_provenance"] = r"""
WITH files AS (
  SELECT c_nationkey, count(*) AS n_rows,
    'c_custkey;c_name' || chr(10) || string_agg(c_custkey || ';' || c_name || chr(10), '' ORDER BY c_custkey) AS bytes
  FROM customer GROUP BY c_nationkey
)
SELECT CAST(c_nationkey AS BIGINT) AS c_nationkey, n_rows, CAST(strlen(bytes) AS BIGINT) AS n_bytes, md5(bytes) AS file_hash
FROM files"""

# --- Text and sentiment --------------------------------------------------------------


def clean(text: str) -> str:
    """The cleaning rules one by one."""
    result = f"coalesce({text}, '')"
    for pattern, new in [
        (rf"http[^{SPACE}]+", ""),
        (rf"@{WORD}+", ""),
        (rf"#{WORD}+", ""),
        (rf"[^\p{{L}}\p{{N}}_{SPACE}.,!?]", " "),
        (rf"[{SPACE}]+", " "),
    ]:
        result = f"regexp_replace({result}, '{pattern}', '{new}', 'g')"
    return f"trim({result})"


def tokens(text: str) -> str:
    return f"list_filter(regexp_extract_all(lower({text}), '{WORD}+'), lambda w: length(w) > 2)"


def hits(words: str, lexicon: tuple[str, ...]) -> str:
    return f"CAST(len(list_filter({words}, lambda w: regexp_matches(w, '{'|'.join(lexicon)}'))) AS BIGINT)"


TEST_POSITIVE = ("the", "tion", "que", "der")
TEST_NEGATIVE = ("of", "and", "ent", "ich")
ALL_TEXTS = r"""texts AS (
  SELECT 'd' || doc_id AS id, text FROM documents UNION ALL SELECT 'c' || conv_id || '-' || turn, text FROM conversations),
marked AS (SELECT id, 'Veja@joão_1 ahttps://x.y/é?z ' || text || ' #saúde-já' AS text FROM texts)"""

ORACLE["q_clean_text"] = f"WITH {ALL_TEXTS} SELECT id, {clean('text')} AS texto_limpo FROM marked"
ORACLE["q_tokens"] = f"WITH {ALL_TEXTS} SELECT id, array_to_string({tokens('text')}, ' ') AS tokens FROM marked"
ORACLE["q_token_digest"] = f"""WITH {ALL_TEXTS}, worded AS (SELECT id, {tokens('text')} AS w FROM marked)
SELECT id, array_to_string(w[1:30], ' ') AS tokens, CAST(len(w) AS BIGINT) AS qtd_tokens FROM worded"""
ORACLE["q_lexicon_hits"] = f"""WITH {ALL_TEXTS}, worded AS (SELECT id, {tokens('text')} AS w FROM marked)
SELECT id, {hits('w', TEST_POSITIVE)} AS positivos, {hits('w', TEST_NEGATIVE)} AS negativos FROM worded"""
ORACLE["q_lexicon_hits_large"] = f"""WITH {ALL_TEXTS}, worded AS (SELECT id, {tokens('text')} AS w FROM marked),
lexicon AS (SELECT DISTINCT unnest({tokens('text')}) AS word FROM benchmark),
distinct_tokens AS (SELECT DISTINCT unnest(w) AS token FROM worded),
found AS (SELECT DISTINCT token FROM distinct_tokens, lexicon WHERE length(word) > 4 AND contains(token, word)),
hits AS (SELECT id, count(*) AS n FROM (SELECT id, unnest(w) AS token FROM worded) JOIN found USING (token) GROUP BY id)
SELECT id, coalesce(n, 0) AS acertos FROM worded LEFT JOIN hits USING (id)"""
ORACLE["q_dedup_first"] = """
SELECT doc_id, lang, source, text FROM documents WHERE doc_id IN (SELECT min(doc_id) FROM documents GROUP BY text)"""

COM = f"""com AS (
  SELECT CAST(doc_id AS VARCHAR) AS comment_id, source AS post_id, lang AS autor,
         CASE WHEN lang <> 'es' THEN DATE '2024-01-01' + CAST(doc_id % 365 AS INTEGER) END AS data_comentario,
         CAST(CASE WHEN lang <> 'fr' THEN n_chars % 20 ELSE 0 END AS BIGINT) AS curtidas,
         text AS texto_original, {clean('text')} AS texto_limpo
  FROM documents),
kept AS (SELECT * FROM com WHERE length(texto_limpo) >= 3)"""


def judged(source: str, positive: tuple[str, ...], negative: tuple[str, ...]) -> str:
    """CTEs that end with ``gold``: label, score, digest and count for each row of a CTE."""
    return f"""worded AS (SELECT *, {tokens('texto_limpo')} AS w FROM {source}),
counted AS (SELECT *, CAST(len(w) AS BIGINT) AS n, {hits('w', positive)} AS pos, {hits('w', negative)}
    + CASE WHEN contains(lower(texto_limpo), 'nao gostei') OR contains(lower(texto_limpo), 'não gostei') THEN 2 ELSE 0 END AS neg FROM worded),
scored AS (SELECT *, CASE WHEN n = 0 OR contains(lower(texto_limpo), 'nem bom nem ruim') OR list_contains(w, 'normal') THEN 0.0::DOUBLE
    ELSE CAST(pos - neg AS DOUBLE) / CAST(n AS DOUBLE) END AS s FROM counted),
gold AS (SELECT * EXCLUDE (w, n, pos, neg, s),
    CASE WHEN s > 0.15::DOUBLE THEN 'positivo' WHEN s < -0.15::DOUBLE THEN 'negativo' ELSE 'neutro' END AS sentimento,
    CAST(printf('%.3f', least(greatest(s, -1.0::DOUBLE), 1.0::DOUBLE)) AS DOUBLE) + 0.0::DOUBLE AS score_sentimento,
    array_to_string(w[1:30], ' ') AS tokens, n AS qtd_tokens FROM scored)"""


GOLD = f"{COM}, {judged('kept', TEST_POSITIVE, TEST_NEGATIVE)}"

ORACLE["q_comments_silver"] = f"""WITH first AS (
  SELECT min(doc_id) AS doc_id, source || '-' || length(text) AS comment_id FROM documents GROUP BY source, length(text)),
{COM}
SELECT first.comment_id, post_id, autor, strftime(data_comentario, '%Y-%m-%d') AS data_comentario, curtidas,
       texto_original AS texto_comentario, first.doc_id AS posicao, texto_original, texto_limpo
FROM kept JOIN first ON kept.comment_id = CAST(first.doc_id AS VARCHAR)"""
ORACLE["q_sentiment"] = f"""WITH {GOLD}
SELECT comment_id, sentimento, score_sentimento, tokens, qtd_tokens FROM gold"""
ORACLE["q_sentiment_default_lexicon"] = f"""WITH {COM},
phrased AS (SELECT * EXCLUDE (texto_limpo), texto_limpo AS t, CASE autor WHEN 'es' THEN 'Não gostei da fila, péssima demora.'
    WHEN 'fr' THEN 'Excelente, muito bom! Recomendo.' WHEN 'de' THEN 'Normal, nem bom nem ruim.'
    ELSE 'Atendimento eficiente, mas lento.' END AS phrase FROM kept),
told AS (SELECT * EXCLUDE (t, phrase), t || ' ' || phrase AS texto_limpo FROM phrased),
{judged('told', POSITIVE_WORDS, NEGATIVE_WORDS)}
SELECT comment_id, sentimento, score_sentimento, qtd_tokens FROM gold"""
ORACLE["q_staging_comments_load"] = f"""WITH {GOLD}
SELECT comment_id, post_id, autor, strftime(data_comentario, '%Y-%m-%d') AS data_comentario, curtidas, texto_original,
       texto_limpo, sentimento, score_sentimento, tokens, qtd_tokens FROM gold"""
ORACLE["q_fact_comments"] = f"""WITH {GOLD}
SELECT row_number() OVER (ORDER BY comment_id) AS id_comentario, comment_id, post_id, autor,
       strftime(data_comentario, '%Y-%m-%d') AS data_comentario, curtidas, texto_original,
       texto_limpo, sentimento, score_sentimento, tokens, qtd_tokens FROM gold"""

ORACLE["q_fact_comments_repeated"] = f"""WITH {GOLD}, numbered AS (SELECT post_id, row_number() OVER (ORDER BY post_id) AS n FROM gold)
SELECT post_id AS comment_id, count(*) AS n_rows, count(*) AS n_keys, min(n) AS first_key, max(n) AS last_key FROM numbered GROUP BY post_id"""

STOP = ", ".join(f"'{w}'" for w in (*TEST_POSITIVE, *TEST_NEGATIVE, "que", "mas", "com", "para", "uma", "muito"))


def tfidf(docs: str, vocabulary: str, stop: str) -> str:
    """TF-IDF of ``docs`` (id, class, text); ``vocabulary`` selects (class, term, df)."""
    dropped = f"WHERE t NOT IN ({stop})" if stop else ""
    return f"""docs AS ({docs}),
sizes AS (SELECT class, count(*) AS n FROM docs GROUP BY class HAVING count(*) >= 2),
words AS (SELECT id, class, unnest(regexp_extract_all(lower(text), '{WORD}{{2,}}')) AS t FROM docs),
tf AS (SELECT id, class, t, count(*) AS tf FROM words {dropped} GROUP BY ALL),
counts AS (SELECT class, t, sum(tf) AS cf, count(*) AS df FROM tf GROUP BY ALL),
vocabulary AS ({vocabulary}),
weights AS (SELECT tf.id, tf.class, tf.t, tf.tf * (ln((1.0::DOUBLE + n) / (1.0::DOUBLE + v.df)) + 1.0::DOUBLE) AS w
    FROM tf JOIN vocabulary v ON tf.class = v.class AND tf.t = v.t JOIN sizes ON tf.class = sizes.class),
norms AS (SELECT id, sqrt(sum(w * w)) AS norm FROM weights GROUP BY id),
scores AS (SELECT class, t, round(sum(w / norm), 6) AS score FROM weights JOIN norms ON weights.id = norms.id GROUP BY class, t)"""


ORACLE["q_tfidf_terms"] = f"""WITH {GOLD},
{tfidf("SELECT comment_id AS id, sentimento AS class, texto_limpo AS text FROM gold",
       "SELECT class, t, df FROM counts QUALIFY row_number() OVER (PARTITION BY class ORDER BY cf DESC, t) <= 15", STOP)}
SELECT class AS sentimento, t AS termo, score AS score_tfidf FROM scores"""
LANGUAGE_DOCS = "SELECT doc_id AS id, lang AS class, text FROM documents"
ORACLE["q_tfidf_given_vocabulary"] = f"""WITH {tfidf(
    LANGUAGE_DOCS, "SELECT class, t, df FROM counts WHERE t IN ('the', 'que', 'der', 'et', 'und', 'la', 'of', 'los')", "")}
SELECT class AS lang, t AS termo, score AS score_tfidf FROM scores"""
ORACLE["q_tfidf_large_vocabulary"] = f"""WITH {tfidf(
    LANGUAGE_DOCS, "SELECT class, t, df FROM counts WHERE length(t) = 8", "")}
SELECT class AS lang, t AS termo, score AS score_tfidf FROM scores"""
ORACLE["q_tfidf_many_terms"] = f"""WITH {tfidf(
    LANGUAGE_DOCS, "SELECT class, t, df FROM counts QUALIFY row_number() OVER (PARTITION BY class ORDER BY cf DESC, t) <= 2000", "")}
SELECT class AS lang, t AS termo, score AS score_tfidf FROM scores"""

TERMS = f"""{GOLD},
unfolded AS (SELECT sentimento, unnest({tokens('texto_limpo')}) AS termo FROM gold),
terms AS (SELECT sentimento, termo, CAST(count(*) AS DOUBLE) AS score_tfidf FROM unfolded
    WHERE length(termo) > 3 AND termo NOT IN ('que', 'mas', 'com', 'para', 'uma', 'muito', 'mais', 'sobre', 'este', 'essa')
    GROUP BY ALL ORDER BY count(*) DESC, sentimento, termo LIMIT 45)"""
ORACLE["q_term_counts"] = f"WITH {TERMS} SELECT * FROM terms"
ORACLE["q_term_ranks"] = f"""WITH {TERMS}
SELECT *, rank() OVER (PARTITION BY sentimento ORDER BY score_tfidf DESC) AS rank_termo FROM terms"""

# --- Star ----------------------------------------------------------------------------

SEASON = """CASE WHEN mes IN (12, 1, 2) THEN 'Verão' WHEN mes IN (3, 4, 5) THEN 'Outono'
    WHEN mes IN (6, 7, 8) THEN 'Inverno' ELSE 'Primavera' END"""
MONTHS = """['Janeiro', 'Fevereiro', 'Março', 'Abril', 'Maio', 'Junho', 'Julho', 'Agosto', 'Setembro', 'Outubro', 'Novembro', 'Dezembro'][mes]"""
# Keys straight from the rows: the dense rank of a natural key is its surrogate key, so no
# dimension is built or joined to get facts and totals.
KEYED = f"""{ADM}, {STG},
keyed AS (SELECT *, 'RN' AS uf, {MONTHS} AS nome_mes, {SEASON} AS estacao_br, coalesce(idade, -1) AS age_key,
    dense_rank() OVER (ORDER BY data_internacao) AS id_tempo,
    dense_rank() OVER (ORDER BY especialidade_padrao) AS id_especialidade,
    dense_rank() OVER (ORDER BY faixa_etaria, sexo, coalesce(idade, -1)) AS id_paciente,
    dense_rank() OVER (ORDER BY municipio_residencia) AS id_municipio
  FROM stg)"""
SUM = "CAST(sum(numero_internacoes) AS BIGINT)"
PROFILE = f"""SELECT faixa_etaria, sexo, {SUM} AS total_internacoes,
       {share('sum(numero_internacoes)', 'sum(sum(numero_internacoes)) OVER ()')} AS pct_total"""
PLACES = f"""SELECT municipio_residencia, capital_interior, uf, {SUM} AS total_internacoes,
       {share('sum(numero_internacoes)', 'sum(sum(numero_internacoes)) OVER ()')} AS pct_total
FROM keyed GROUP BY municipio_residencia, capital_interior, uf"""
KINDS = f"""SELECT especialidade_padrao, grupo_especialidade, {SUM} AS total_internacoes,
       rank() OVER (ORDER BY sum(numero_internacoes) DESC) AS ranking
FROM keyed GROUP BY especialidade_padrao, grupo_especialidade"""

ORACLE["q_dim_time"] = f"""WITH {KEYED}
SELECT DISTINCT id_tempo, strftime(data_internacao, '%Y-%m-%d') AS data_internacao, ano, mes, trimestre, ano_mes, nome_mes, estacao_br FROM keyed"""
ORACLE["q_dim_specialty"] = f"WITH {KEYED} SELECT DISTINCT id_especialidade, especialidade_padrao, grupo_especialidade FROM keyed"
ORACLE["q_dim_patient"] = f"WITH {KEYED} SELECT DISTINCT id_paciente, faixa_etaria, sexo, age_key AS idade FROM keyed"
ORACLE["q_dim_municipality"] = f"""WITH {KEYED}
SELECT DISTINCT id_municipio, municipio_residencia, codigo_municipio_ibge, capital_interior, uf FROM keyed"""
ORACLE["q_dim_municipality_resolved"] = f"""{STAGING}, marked AS (
  SELECT *, CASE WHEN sexo = 'Não informado' AND length(codigo_municipio_ibge) = 1 THEN '0000000' ELSE codigo_municipio_ibge END AS code FROM stg)
SELECT row_number() OVER (ORDER BY municipio_residencia) AS id_municipio, municipio_residencia,
       coalesce(max(code) FILTER (code <> '0000000'), '0000000') AS codigo_municipio_ibge, capital_interior, 'RN' AS uf
FROM marked GROUP BY municipio_residencia, capital_interior"""
FACT = f"""SELECT id_tempo, id_especialidade, id_paciente, id_municipio, {SUM} AS qtd_internacoes FROM keyed
GROUP BY id_tempo, id_especialidade, id_paciente, id_municipio"""
ORACLE["q_fact_admissions"] = f"WITH {KEYED} {FACT}"

TWO_GROUPS = f"""{KEYED}, halves AS (
  SELECT especialidade_padrao, numero_internacoes, CASE WHEN mes > 6 THEN 'Segundo' ELSE grupo_especialidade END AS g FROM keyed)"""
ORACLE["q_fact_two_groups"] = f"""WITH {TWO_GROUPS}
SELECT especialidade_padrao, min(g) AS grupo_especialidade, {SUM} AS total_internacoes,
       rank() OVER (ORDER BY sum(numero_internacoes) DESC) AS ranking
FROM halves GROUP BY especialidade_padrao"""
ORACLE["q_check_two_groups"] = f"""WITH {TWO_GROUPS}
SELECT especialidade_padrao, count(DISTINCT g) AS n_values, min(g) AS lowest_value, max(g) AS highest_value
FROM halves GROUP BY especialidade_padrao HAVING count(DISTINCT g) > 1"""

# --- Marts ---------------------------------------------------------------------------

ORACLE["q_top_specialties"] = f"WITH {KEYED} {KINDS}"
ORACLE["q_patient_profile"] = f"""WITH {KEYED} {PROFILE}
FROM keyed GROUP BY faixa_etaria, sexo"""
ORACLE["q_municipality"] = f"WITH {KEYED} {PLACES}"
ORACLE["q_monthly_seasonality"] = f"""WITH {KEYED}
SELECT ano, mes, ano_mes, nome_mes, estacao_br, {SUM} AS total_internacoes
FROM keyed GROUP BY ano, mes, ano_mes, nome_mes, estacao_br"""
ORACLE["q_season_totals"] = f"""WITH {KEYED}
SELECT estacao_br, {SUM} AS total_internacoes FROM keyed GROUP BY estacao_br"""
ORACLE["q_sliced_profile"] = f"""WITH {KEYED} {PROFILE}
FROM keyed WHERE ano IN (1996, 1997) AND capital_interior = 'Capital' GROUP BY faixa_etaria, sexo"""
ORACLE["q_top_n_municipality"] = f"WITH {KEYED} {PLACES} ORDER BY total_internacoes DESC, municipio_residencia LIMIT 5"
ORACLE["q_top_n_specialties"] = f"WITH {KEYED} {KINDS} ORDER BY total_internacoes DESC, especialidade_padrao LIMIT 10"

SAMPLE = """SELECT comment_id, strftime(data_comentario, '%Y-%m-%d') AS data_comentario, autor, curtidas, sentimento,
       left(texto_limpo, 200) AS texto_resumo FROM gold"""
MOODS = f"""SELECT sentimento, qtd_comentarios, {share('qtd_comentarios', 'sum(qtd_comentarios) OVER ()')} AS pct_comentarios,
       sign(mils) * ((2 * abs(mils) + qtd_comentarios) // (2 * qtd_comentarios)) / 1000.0::DOUBLE + 0.0::DOUBLE AS score_medio
FROM (SELECT sentimento, count(*) AS qtd_comentarios, CAST(sum(CAST(round(score_sentimento * 1000) AS BIGINT)) AS BIGINT) AS mils
      FROM gold GROUP BY sentimento)"""
ORACLE["q_comment_sample"] = f"WITH {GOLD} {SAMPLE}"
ORACLE["q_comment_sample_positive"] = f"WITH {GOLD} {SAMPLE} WHERE sentimento = 'positivo'"
ORACLE["q_sentiment_distribution"] = f"WITH {GOLD} {MOODS}"
ORACLE["q_decision_summary"] = f"""WITH {KEYED}, {GOLD}, places AS ({PLACES}), kinds AS ({KINDS}), moods AS ({MOODS})
SELECT (SELECT {SUM} FROM keyed) AS total_internacoes,
       (SELECT especialidade_padrao FROM kinds ORDER BY total_internacoes DESC, especialidade_padrao LIMIT 1) AS especialidade_lider,
       (SELECT municipio_residencia FROM places ORDER BY total_internacoes DESC, municipio_residencia LIMIT 1) AS municipio_lider,
       (SELECT sentimento FROM moods ORDER BY qtd_comentarios DESC, sentimento LIMIT 1) AS sentimento_predominante,
       (SELECT CAST(round(CAST(pct_comentarios AS DECIMAL(10,2)), 1) AS DOUBLE) FROM moods WHERE sentimento = 'positivo') AS pct_positivo,
       (SELECT CAST(round(CAST(pct_comentarios AS DECIMAL(10,2)), 1) AS DOUBLE) FROM moods WHERE sentimento = 'negativo') AS pct_negativo"""

ORACLE["q_warehouse"] = f"""WITH {KEYED}, {TERMS}, places AS ({PLACES}), kinds AS ({KINDS})
SELECT 'specialty' AS mart, especialidade_padrao AS label, total_internacoes AS measure FROM kinds
UNION ALL SELECT 'profile', faixa_etaria || ' ' || sexo, CAST(sum(numero_internacoes) AS BIGINT) FROM stg GROUP BY faixa_etaria, sexo
UNION ALL SELECT 'municipality', municipio_residencia, total_internacoes FROM places
UNION ALL SELECT 'month', ano_mes, CAST(sum(numero_internacoes) AS BIGINT) FROM stg GROUP BY ano_mes
UNION ALL SELECT 'sentiment', sentimento, count(*) FROM gold GROUP BY sentimento
UNION ALL SELECT 'term', sentimento || ' ' || termo, CAST(score_tfidf AS BIGINT) FROM terms
UNION ALL SELECT 'comment', comment_id, curtidas FROM gold
UNION ALL SELECT 'leader', (SELECT especialidade_padrao FROM kinds ORDER BY total_internacoes DESC, especialidade_padrao LIMIT 1)
    || ' ' || (SELECT municipio_residencia FROM places ORDER BY total_internacoes DESC, municipio_residencia LIMIT 1),
    (SELECT CAST(sum(numero_internacoes) AS BIGINT) FROM stg)"""

# --- Data quality --------------------------------------------------------------------

REQUIRED = ("data_internacao", "especialidade_hospitalar", "municipio_residencia", "idade", "numero_internacoes")
ORACLE["q_check_not_null"] = f"WITH {ADM}, {RAW} " + " UNION ALL ".join(
    f"SELECT '{name}' AS column_name, count(*) FILTER ({name} IS NULL) AS n_null FROM raw" for name in REQUIRED
)
ADMISSIONS_REQUIRED = (
    "data_internacao", "especialidade_padrao", "numero_internacoes", "municipio_residencia", "faixa_etaria", "sexo", "ano", "mes",
    "ano_mes", "trimestre", "capital_interior",
)
ORACLE["q_check_required"] = f"""WITH {ADM}, {RAW}, {RAW_SILVER}, {GOLD},
thinned AS (SELECT * REPLACE (CASE WHEN idade > 20 THEN sexo END AS sexo) FROM raw_silver),
faded AS (SELECT * REPLACE (nullif(sentimento, 'neutro') AS sentimento) FROM gold)
""" + " UNION ALL ".join(
    [f"SELECT 'internacoes' AS tabela, '{n}' AS column_name, count(*) FILTER ({n} IS NULL) AS n_null FROM thinned" for n in ADMISSIONS_REQUIRED]
    + [f"SELECT 'comentarios', '{n}', count(*) FILTER ({n} IS NULL) FROM faded" for n in ("comment_id", "sentimento")]
)
ORACLE["q_check_null_conflicts"] = """WITH o AS (SELECT DISTINCT o_custkey, nullif(o_orderstatus, 'P') AS status FROM orders)
SELECT o_custkey, count(*) AS n_values, min(status) AS lowest_value, max(status) AS highest_value
FROM o GROUP BY o_custkey HAVING count(*) > 1"""
ORACLE["q_check_unique"] = "SELECT text, count(*) AS n_rows FROM documents GROUP BY text HAVING count(*) > 1"
ORACLE["q_check_unique_fact"] = f"""WITH {KEYED}
SELECT 'fact' AS layer, count(*) AS n_rows FROM ({FACT}) UNION ALL SELECT 'repeated', 0"""
ORACLE["q_check_conflicts"] = f"""{STAGING}, marked AS (
  SELECT municipio_residencia, CASE WHEN sexo = 'Não informado' AND length(codigo_municipio_ibge) = 1 THEN '0000000' ELSE codigo_municipio_ibge END AS code FROM stg)
SELECT municipio_residencia, count(DISTINCT code) AS n_values, min(code) AS lowest_value, max(code) AS highest_value
FROM marked GROUP BY municipio_residencia HAVING count(DISTINCT code) > 1"""
ORACLE["q_check_reconcile"] = f"""{STAGING}
SELECT CAST(sum(numero_internacoes) AS BIGINT) AS detail_total, CAST(sum(numero_internacoes) AS BIGINT) AS summary_total,
       CAST(0 AS BIGINT) AS difference FROM stg"""
ORACLE["q_layer_counts"] = f"""WITH {ADM}, {RAW}, {RAW_SILVER}, {COM}
SELECT 'bronze' AS layer, count(*) AS n_rows FROM raw UNION ALL SELECT 'silver', count(*) FROM raw_silver
UNION ALL SELECT 'comments', count(*) FROM kept
UNION ALL SELECT 'gold', count(*) FROM (SELECT DISTINCT ano_mes, especialidade_padrao, municipio_residencia, faixa_etaria, sexo,
    CASE WHEN contains(lower(municipio_residencia), 'natal') THEN 'Capital' ELSE 'Interior' END AS flag FROM raw_silver)"""
