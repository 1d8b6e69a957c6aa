"""One query for each operator, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.llm.audit import FILTERS, interactions, orders
from wardlake.llm.bpe import tokenize
from wardlake.llm.codes import compress
from wardlake.llm.conversations import CLOSING, OPENING, collapsed
from wardlake.llm.decontaminate import leaks
from wardlake.llm.jaccard import Join, near_duplicates
from wardlake.llm.licenses import license_scan
from wardlake.llm.perplexity import quality_rules
from wardlake.llm.quality import quality
from wardlake.llm.secrets import BASE_RULES, RULES, digests, scan_versions
from wardlake.llm.suffixes import without_repeats
from wardlake.llm.tokenfiles import documents_of, read_ids, write_ids
from wardlake.llm.toxicity import toxicity
from wardlake.sources.storage import new_path

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
FILE_VOCABULARY = "byte_bpe_50k.json"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity_cnn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_quality_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), Join(3, 90)).drop("cls")


def op4_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents")).drop("spans")


def op5_perplexity_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op6_secret_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = new_path(spark, "ledger")
    return digests(scan_versions(table(spark, sf_dir, "documents"), ledger))


def _secret_sql() -> str:
    rules = " UNION ALL ".join(
        "SELECT doc_id, {k} AS rank, '{kind}' AS kind, {least} AS least, string_split_regex(t, '{p}') AS pieces,"
        " regexp_extract_all(t, '{p}', 0) AS wholes, regexp_extract_all(t, '{p}', {g}) AS found FROM d"
        " WHERE regexp_matches(t, '{p}')".format(k=k, kind=r.kind, least=r.least, p=r.pattern.replace("'", "''"), g=r.group)
        for k, r in enumerate(RULES)
    )
    line = "coalesce(string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank){}, '')"
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({rules}),
n AS (SELECT *, unnest(range(1, len(wholes) + 1)) AS i FROM m),
p AS (
  SELECT doc_id, rank, kind, length(found[i]) AS size, least,
    CAST(list_sum(list_transform(pieces[1:i], lambda x: length(x))) AS BIGINT)
      + CAST(coalesce(list_sum(list_transform(wholes[1:i - 1], lambda x: length(x))), 0) AS BIGINT) AS s,
    length(wholes[i]) AS w
  FROM n
),
f AS (SELECT doc_id, rank, kind, s, s + w AS e FROM p WHERE size >= least)
SELECT d.doc_id,
  {", ".join(f"count(*) FILTER (WHERE rank = {k}) AS n_{r.kind}" for k, r in enumerate(BASE_RULES))},
  sha256({line.format(f" FILTER (WHERE rank < {len(BASE_RULES)})")}) AS base_sha256,
  {line.format("")} AS spans
FROM d LEFT JOIN f ON d.doc_id = f.doc_id
GROUP BY d.doc_id
"""


def op7_snapshot_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collapsed(table(spark, sf_dir, "conversations"))


def _conversation_sql() -> str:
    """Prefixes as whole texts; a part has 512 turns, as the query's."""
    line = f"'{OPENING}' || coalesce(role, '') || chr(10) || coalesce(text, '') || '{CLOSING.strip()}' || chr(10)"
    same = "coalesce('r' || length(role) || ':' || role, 'n') || coalesce('t' || length(text) || ':' || text, 'n')"
    return f"""
WITH turns AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
placed AS (
  SELECT *, {line} AS line, {same} AS same,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS place,
    count(*) OVER (PARTITION BY conv_id) AS n_turns
  FROM turns
),
rolled AS (
  SELECT *, sha256(string_agg(same, '') OVER (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING)) AS prefix
  FROM placed
),
wholes AS (SELECT prefix, n_turns, min(conv_id) AS conv_id, count(*) AS n_copies FROM rolled WHERE place = n_turns GROUP BY ALL),
kept AS (SELECT * FROM wholes WHERE (prefix, n_turns) NOT IN (SELECT prefix, place FROM rolled WHERE place < n_turns))
SELECT k.conv_id, (p.place - 1) // 512 AS part, k.n_turns, k.n_copies, string_agg(p.line, '' ORDER BY p.place) AS rendered
FROM kept k JOIN placed p ON p.conv_id IS NOT DISTINCT FROM k.conv_id
GROUP BY ALL
"""


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return tokenize(
        docs,
        public_tokenizers.path(VOCABULARY),
        public_tokenizers.PATTERN,
        outputs=("n_tokens", "ids_sha256", "decoded_sha256"),
    )


def op9_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op11_code_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings"))


def _code_sql() -> str:
    """Vectors of 64 components in 16 parts of four, 64 entries, two rounds."""
    steps = []
    for k in range(3):
        steps.append(f"""
near{k} AS (
  SELECT p.slot, x0, x1, x2, x3, n, min(((x0 - c0) ** 2 + (x1 - c1) ** 2 + (x2 - c2) ** 2 + (x3 - c3) ** 2)::BIGINT * 64 + entry) AS best
  FROM parts p JOIN book{k} b ON p.slot = b.slot GROUP BY ALL
)""")
        if k < 2:
            floors = ", ".join(
                f"coalesce((s{i} - ((s{i} % m) + m) % m) // m, c{i})::BIGINT AS c{i}" for i in range(4)
            )
            sums = ", ".join(f"sum(x{i} * n)::BIGINT AS s{i}" for i in range(4))
            steps.append(f"""
sums{k} AS (SELECT slot, best % 64 AS entry, sum(n)::BIGINT AS m, {sums} FROM near{k} GROUP BY ALL),
book{k + 1} AS (SELECT b.slot, b.entry, {floors} FROM book{k} b LEFT JOIN sums{k} s ON b.slot = s.slot AND b.entry = s.entry)""")
    four = ", ".join(f"v[slot * 4 + {i + 1}] AS {{0}}{i}" for i in range(4))
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
place AS (SELECT unnest(range(16)) AS slot),
cut AS (SELECT vec_id, label, slot, {four.format("x")} FROM kept, place),
parts AS (SELECT slot, x0, x1, x2, x3, count(*) AS n FROM cut GROUP BY ALL),
seeds AS (SELECT v, row_number() OVER (ORDER BY vec_id, v) - 1 AS entry FROM kept QUALIFY entry < 64),
book0 AS (SELECT slot, entry, {four.format("c")} FROM seeds, place),
{",".join(steps)},
digest AS (SELECT sha256(string_agg(concat_ws(',', c0, c1, c2, c3), ',' ORDER BY slot, entry)) AS codebooks_sha256 FROM book2),
coded AS (
  SELECT vec_id, label, string_agg(format('{{:02x}}', best % 64), '' ORDER BY c.slot) AS code, sum(best // 64)::BIGINT AS error
  FROM cut c JOIN near2 n ON c.slot = n.slot AND c.x0 = n.x0 AND c.x1 = n.x1 AND c.x2 = n.x2 AND c.x3 = n.x3
  GROUP BY vec_id, label
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded, digest
"""


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return interactions(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _audit_sql() -> str:
    bit = {f: 1 << k for k, f in enumerate(FILTERS)}
    steps = ", ".join(
        f"('{order}', {step}, '{order[step - 1]}', {bit[order[step - 1]]}, {sum(bit[f] for f in order[: step - 1])})"
        for order, step in orders(FILTERS)
    )
    return f"""
WITH d AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
g AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
m AS (
  SELECT part, good, toxic,
    CASE WHEN len(words) < 50 THEN 1 ELSE 0 END
    + CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END
    + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 4 ELSE 0 END
    + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
    + CASE WHEN d.doc_id > min(d.doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask
  FROM d LEFT JOIN g ON d.doc_id = g.doc_id
),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (WHERE good) AS n_good, count(*) FILTER (WHERE toxic) AS n_toxic FROM m GROUP BY ALL),
s(filter_order, step, letter, own, before) AS (VALUES {steps}),
r AS (
  SELECT part, filter_order, step, letter,
    coalesce(sum(n) FILTER (WHERE mask & (own | before) = 0), 0)::BIGINT AS kept,
    coalesce(sum(n) FILTER (WHERE mask & own <> 0 AND mask & before = 0), 0)::BIGINT AS removed,
    coalesce(sum(n) FILTER (WHERE mask & own <> 0 AND mask & before <> 0), 0)::BIGINT AS redundant,
    coalesce(sum(n) FILTER (WHERE mask = own), 0)::BIGINT AS unique_fails,
    coalesce(sum(n_good) FILTER (WHERE mask & own <> 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
    coalesce(sum(n_toxic) FILTER (WHERE mask & own <> 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost
  FROM c, s GROUP BY ALL
)
SELECT * EXCLUDE (letter, step), step::INTEGER AS step, (sum(removed) OVER (PARTITION BY part, letter))::BIGINT AS shapley FROM r
"""


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token_ids")
    write_ids(table(spark, sf_dir, "documents"), path, public_tokenizers.path(FILE_VOCABULARY))
    return documents_of(read_ids(spark, path))


QUERIES = {
    "op1_toxicity_cnn": op1_toxicity_cnn,
    "op2_quality_kernel": op2_quality_kernel,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_license_notices": op4_license_notices,
    "op5_perplexity_bands": op5_perplexity_bands,
    "op6_secret_ledger": op6_secret_ledger,
    "op7_snapshot_collapse": op7_snapshot_collapse,
    "op8_byte_bpe": op8_byte_bpe,
    "op9_benchmark_leaks": op9_benchmark_leaks,
    "op10_suffix_dedup": op10_suffix_dedup,
    "op11_code_trie": op11_code_trie,
    "op12_filter_audit": op12_filter_audit,
    "op13_token_files": op13_token_files,
}
#: SQL for the operators that SQL can express.
ORACLE: dict[str, str] = {
    "op6_secret_ledger": _secret_sql(),
    "op7_snapshot_collapse": _conversation_sql(),
    "op11_code_trie": _code_sql(),
    "op12_filter_audit": _audit_sql(),
}
