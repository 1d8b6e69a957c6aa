"""Column expressions for social text: cleaning, tokens, lexicon sentiment."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from wardlake.functions import defaults as d


@dataclass(frozen=True)
class Lexicon:
    """Words and phrases that decide the sentiment of a text."""

    positive: Sequence[str] = d.POSITIVE_WORDS
    negative: Sequence[str] = d.NEGATIVE_WORDS
    negated_phrases: Sequence[str] = d.NEGATED_PHRASES
    neutral_phrase: str = d.NEUTRAL_PHRASE
    neutral_token: str = d.NEUTRAL_TOKEN

    @property
    def words(self) -> tuple[str, ...]:
        return (*self.positive, *self.negative)


def clean_text(c: Column) -> Column:
    """Text without links, mentions and hashtags, other symbols as single blanks.

    Links go first, on their own, because a link may start inside a mention. Mentions and
    hashtags cannot create one another when removed, so one expression takes both; symbols
    and white space both end as one blank, so one expression takes these too. Texts without
    ``http``, ``@`` or ``#`` skip the expressions that need them.
    """
    text = F.coalesce(c.cast("string"), F.lit(""))
    linked = F.contains(text, F.lit("http"))
    tagged = F.contains(text, F.lit("@")) | F.contains(text, F.lit("#"))
    unlinked = F.when(linked, F.regexp_replace(text, rf"http[^{d.SPACE}]++", "")).otherwise(text)
    untagged = F.when(tagged, F.regexp_replace(unlinked, rf"[@#][{d.WORD}]++", "")).otherwise(unlinked)
    return F.trim(F.regexp_replace(untagged, rf"[^{d.WORD}.,!?]++", " "))


def words(lowered: Column, shortest: int) -> Column:
    """Runs of at least ``shortest`` word characters of a lower-case text."""
    return F.regexp_extract_all(lowered, F.lit(rf"[{d.WORD}]{{{shortest},}}+"), F.lit(0))


def tokens(c: Column) -> Column:
    """Lower-case words of three characters or more."""
    return words(F.lower(c), 3)


def lexicon_hits(tokens: Column, lexicon: Sequence[str]) -> Column:
    """Number of tokens that contain at least one lexicon word."""
    listed = F.array(*[F.lit(w) for w in lexicon]).cast("array<string>")
    return F.size(F.filter(tokens, lambda t: F.exists(listed, lambda w: F.contains(t, w))))


def digest(tokens: Column, first: int = d.DIGEST_TOKENS) -> Column:
    return F.array_join(F.slice(tokens, 1, first), " ")


def round3(c: Column) -> Column:
    """Three decimals, ties to even, judged on the exact binary value.

    ``bround`` judges the shortest decimal form instead: it takes 1/80 (a little above
    0.0125) for a tie and gives 0.012, where the exact value gives 0.013. Formatting judges
    the exact value, but for 0.0005, which it takes for a tie with zero; so magnitudes below
    0.001 are decided here. Adding zero turns a negative zero into zero. For magnitudes
    below 1000.
    """
    tiny = F.when(F.abs(c) >= 0.0005, F.signum(c) * 0.001).otherwise(F.lit(0.0))
    return F.when(F.abs(c) < 0.001, tiny).otherwise(F.format_number(c, 3).cast("double")) + F.lit(0.0)


def any_phrase(lowered: Column, phrases: Sequence[str]) -> Column:
    """Whether a lower-case text contains one of a few phrases."""
    found = F.lit(False)
    for phrase in phrases:
        found = found | F.contains(lowered, F.lit(phrase))
    return found


def score(positive: Column, negative: Column, negated: Column, neutral: Column, n_tokens: Column) -> Column:
    """Positive less negative hits per token; a negated phrase weighs on the negative side,
    a neutral text scores zero."""
    weighted = negative + F.when(negated, F.lit(d.NEGATED_WEIGHT)).otherwise(F.lit(0))
    return F.when(neutral, F.lit(0.0)).otherwise((positive - weighted) / F.greatest(n_tokens, F.lit(1)))


def mood(score: Column) -> Column:
    """Label of a score; both limits belong to the neutral class."""
    return (
        F.when(score > d.SCORE_THRESHOLD, F.lit(d.POSITIVE))
        .when(score < -d.SCORE_THRESHOLD, F.lit(d.NEGATIVE))
        .otherwise(F.lit(d.NEUTRAL))
    )


def shown_score(score: Column) -> Column:
    """Score as stored: within one of zero, three decimals."""
    return round3(F.greatest(F.least(score, F.lit(1.0)), F.lit(-1.0)))
