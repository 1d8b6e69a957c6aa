"""Comments: bronze text to the silver layer, and the sentiment gold frame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.functions import cleaning as c
from wardlake.functions import defaults as d
from wardlake.functions import text as t
from wardlake.operators.dedup import keep_first
from wardlake.operators.schema import is_text, with_missing
from wardlake.plans.admissions import dated

STAGING_TYPES = {name: kind for name, kind, _ in d.COMMENT_TABLE}
STAGING_REQUIRED = tuple(name for name, _, required in d.COMMENT_TABLE if required)
COMMENT_COLUMNS = (*list(STAGING_TYPES)[:5], "texto_comentario")


def comments_silver(
    df: DataFrame,
    order: Sequence[Column],
    formats: Sequence[str] = d.DATE_FORMATS,
    min_length: int = d.MIN_TEXT_LENGTH,
) -> DataFrame:
    """Cleaned comments, the first of each id in the given order, without very short texts.

    Length is judged after deduplication: a short first text removes its id. Texts are
    cleaned after the duplicates are gone, and each only once: a filter on the cleaned text
    would be pushed below the cleaning and repeat it, so the text is unfolded from an array
    that is empty when the text is too short.
    """
    df = df.toDF(*[name.strip().lower() for name in df.columns])
    df = with_missing(df, dict.fromkeys(COMMENT_COLUMNS))
    first = keep_first(df, ["comment_id"], order)
    original = F.coalesce(F.col("texto_comentario").cast("string"), F.lit(""))
    long_enough = F.filter(F.array("_clean"), lambda x: F.char_length(x) >= min_length)
    typed = first.withColumns(
        {
            "texto_original": original,
            "data_comentario": dated(first, "data_comentario", formats),
            "curtidas": F.coalesce(c.whole_number(F.col("curtidas"), is_text(first, "curtidas")), F.lit(0)),
            "processed_at": c.processing_time(),
            "_clean": t.clean_text(original),
        }
    )
    return typed.select("*", F.explode(long_enough).alias("texto_limpo")).drop("_clean")


def sentiment_gold(silver: DataFrame, lexicon: t.Lexicon = t.Lexicon()) -> DataFrame:
    """Comments with label, score, token digest and token count; one narrow pass.

    Each step names what the next one uses several times, so that the lower-case text, the
    tokens and the score are computed once per row.
    """
    lowered, words = F.col("_lowered"), F.col("_words")
    read = silver.withColumn("_lowered", F.lower("texto_limpo")).withColumns(
        {
            "_words": t.words(lowered, 3),
            "_negated": t.any_phrase(lowered, lexicon.negated_phrases),
            "_fixed": t.any_phrase(lowered, [lexicon.neutral_phrase]),
        }
    )
    scored = read.withColumn(
        "_score",
        t.score(
            t.lexicon_hits(words, lexicon.positive),
            t.lexicon_hits(words, lexicon.negative),
            F.col("_negated"),
            (F.size(words) == 0) | F.col("_fixed") | F.array_contains(words, lexicon.neutral_token),
            F.size(words),
        ),
    )
    return scored.select(
        *silver.columns,
        t.mood(F.col("_score")).alias("sentimento"),
        t.shown_score(F.col("_score")).alias("score_sentimento"),
        t.digest(words).alias("tokens"),
        F.size(words).alias("qtd_tokens"),
    )


def comments_staging(gold: DataFrame) -> DataFrame:
    """The staging columns in their table types."""
    return gold.select(*[F.col(name).cast(kind).alias(name) for name, kind in STAGING_TYPES.items()])
