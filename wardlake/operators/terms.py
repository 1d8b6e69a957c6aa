"""Characteristic terms of each class of texts: counts and TF-IDF."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardlake.functions import defaults as d
from wardlake.functions.text import words
from wardlake.operators.keys import rank_within, running_total
from wardlake.sources.storage import publish, TEXT_CODEC


def term_counts(
    comments: DataFrame,
    label: str = "sentimento",
    text: str = "texto_limpo",
    longer_than: int = 3,
    stopwords: Sequence[str] | DataFrame = d.COUNT_STOPWORDS,
    top: int = d.COUNT_TERMS,
) -> DataFrame:
    """The most frequent (class, term) pairs of all words of the texts.

    Ties at the cut are broken by class and term. The score's type holds any count. A long stop list is a frame of one column; it is
    left out by an anti-join after counting, so that it meets each distinct term once.
    """
    term = comments.select(label, F.explode(words(F.lower(text), longer_than + 1)).alias("termo"))
    listed = isinstance(stopwords, DataFrame)
    kept = term if listed else term.filter(~F.col("termo").isin(*stopwords))
    counted = kept.groupBy(label, "termo").agg(F.count(F.lit(1)).alias("_n"))
    if listed:
        counted = counted.join(stopwords.toDF("termo").distinct(), "termo", "left_anti")
    first = counted.orderBy(F.desc("_n"), label, "termo").limit(top)
    return first.select(label, "termo", F.col("_n").cast("decimal(25,6)").alias("score_tfidf"))


def term_ranks(terms: DataFrame, label: str = "sentimento", score: str = "score_tfidf") -> DataFrame:
    """Rank of each term within its class by descending score; ties share a rank.

    The terms are stored once. A class of any size is ranked by many tasks.
    """
    stored = publish(terms.select(label, "termo", score), "terms").frame
    ranked = rank_within(stored, [label], score, "rank_termo")
    return ranked.orderBy(label, F.desc(score), "termo")


def tfidf_terms(
    docs: DataFrame,
    label: str = "sentimento",
    text: str = "texto_limpo",
    classes: Sequence[str] = (d.POSITIVE, d.NEGATIVE, d.NEUTRAL),
    top: int = d.TFIDF_TERMS,
    stopwords: Sequence[str] = (),
    vocabulary: DataFrame | None = None,
) -> DataFrame:
    """Terms of each class with the sum of their L2-normalized TF-IDF weights.

    Per class with at least two documents: the vocabulary is the ``top`` terms by number of
    occurrences (ties by term), or the given frame of (class, term); idf is
    ``ln((1 + N) / (1 + df)) + 1`` over all its documents; each document's weights are
    normalized over the vocabulary.

    The words of each document are counted within its row, and these bags are stored. One pass
    over them counts the terms. The second joins them with the vocabulary, a stored frame like
    any other, and only the pairs that match are shuffled, to have each document's norm. The sum
    of document frequencies is the number of these pairs, and so gives the number of tasks, none
    of which gets much more than ``PAIRS_AT_ONCE``. Neither the vocabulary nor ``top`` is bounded
    by a task's memory. The frame is read a second time to count the documents of the classes, so
    pass a stored one.
    """
    chosen = docs.filter(F.col(label).isin(*classes)).select(F.col(label).alias("_class"), F.col(text).alias("_text"))
    sorted_words = chosen.select(
        "_class",
        F.monotonically_increasing_id().alias("_doc"),
        F.sort_array(words(F.lower("_text"), 2)).alias("_words"),
    )
    bags = publish(counted_words(sorted_words, "_words", "_bag"), "bags", TEXT_CODEC).frame
    pairs = bags.select("_class", "_doc", F.inline("_bag").alias("_term", "_n"))
    if stopwords:
        pairs = pairs.filter(~F.col("_term").isin(*stopwords))

    counts = pairs.groupBy("_class", "_term").agg(F.sum("_n").alias("_occurrences"), F.count(F.lit(1)).alias("_df"))
    if vocabulary is None:
        kept = most_frequent(counts, top)
    else:
        kept = counts.join(vocabulary.toDF("_class", "_term").distinct(), ["_class", "_term"], "left_semi")
    weighted = publish(kept.select("_class", "_term", "_df"), "vocabulary").frame

    sizes = chosen.agg(F.array(*[F.count_if(F.col("_class") == c) for c in classes]).cast("array<bigint>")).scalar()
    listed_classes = F.array(*[F.lit(c) for c in classes]).cast("array<string>")
    n_docs = F.get(sizes, (F.array_position(listed_classes, F.col("_class")) - 1).cast("int"))
    idf = F.log((1 + F.col("_docs")) / (1 + F.col("_df"))) + 1
    n_pairs = weighted.agg(F.sum("_df")).first()[0] or 0
    found = (
        pairs.join(weighted.withColumn("_docs", n_docs).filter("_docs >= 2"), ["_class", "_term"])
        .select("_class", "_doc", "_term", (F.col("_n") * idf).alias("_weight"))
        .repartition(n_pairs // PAIRS_AT_ONCE + 1, "_class", "_doc")
    )
    norm = F.sqrt(F.sum(F.col("_weight") * F.col("_weight")).over(Window.partitionBy("_class", "_doc")))
    return (
        found.select(F.col("_class").alias(label), F.col("_term").alias("termo"), (F.col("_weight") / norm).alias("_share"))
        .groupBy(label, "termo")
        .agg(F.sum("_share").alias("score_tfidf"))
        .orderBy(label, F.desc("score_tfidf"), "termo")
    )


def counted_words(df: DataFrame, words: str, name: str) -> DataFrame:
    """The frame with each row's distinct words and their numbers, ``name``, instead of its sorted words."""
    sorted_words = F.col(words)
    begins = lambda word, k: F.when((k == 0) | (word != F.get(sorted_words, k - 1)), k)
    kept = [c for c in df.columns if c != words]
    started = df.select(*df.columns, F.array_compact(F.transform(sorted_words, begins)).alias("_starts"))
    end = lambda k: F.coalesce(F.get("_starts", k + 1), F.size(sorted_words))
    counted = lambda at, k: F.struct(F.get(sorted_words, at).alias("_term"), (end(k) - at).alias("_n"))
    return started.select(*kept, F.transform("_starts", counted).alias(name))


#: Pairs of a document and a term that one task sorts by document.
PAIRS_AT_ONCE = 500_000

#: Most rows of a class that one task may sort.
SORTED_AT_ONCE = 100_000


def most_frequent(counts: DataFrame, top: int, shards: int = 64) -> DataFrame:
    """The ``top`` terms of each class by occurrences, ties by term, whatever ``top``.

    A small ``top`` is cut within shards of a class first, then over what these keep, at most
    ``SORTED_AT_ONCE`` rows. A larger one is selected, see ``select_most_frequent``.
    """
    if shards * top > SORTED_AT_ONCE:
        return select_most_frequent(counts, top)
    order = (F.desc("_occurrences"), F.col("_term"))
    shard = F.pmod(F.xxhash64("_term"), F.lit(shards))
    within = Window.partitionBy("_class", "_shard").orderBy(*order)
    over = Window.partitionBy("_class").orderBy(*order)
    first = counts.withColumn("_shard", shard).withColumn("_place", F.row_number().over(within)).filter(F.col("_place") <= top)
    return first.withColumn("_place", F.row_number().over(over)).filter(F.col("_place") <= top).drop("_shard", "_place")


def select_most_frequent(counts: DataFrame, top: int) -> DataFrame:
    """The same rows by distributed selection: no task sorts or gathers the terms of a class.

    A histogram of the occurrences gives each class the number at which its ``top`` terms end.
    Terms above it are taken as they are. Those with just that number are numbered by term
    over many tasks, and the first ones fill what is left.
    """
    stored = publish(counts, "counts").frame
    histogram = stored.groupBy("_class", "_occurrences").agg(F.count(F.lit(1)).alias("_ties"))
    upto = running_total(histogram, ["_class"], [F.desc("_occurrences")], F.col("_ties"), "_upto")
    started = upto.where(F.col("_upto") - F.col("_ties") < top)  # the last of these numbers is the cut
    cut = started.groupBy(F.col("_class").alias("_of")).agg(
        F.min(F.struct("_occurrences", (F.lit(top) - F.col("_upto") + F.col("_ties")).alias("room"), "_ties")).alias("_cut")
    )
    cut = publish(cut, "cuts").frame  # a row per class
    known = stored.join(cut, F.col("_class").eqNullSafe(F.col("_of")))
    whole = (F.col("_occurrences") > F.col("_cut._occurrences")) | (
        (F.col("_occurrences") == F.col("_cut._occurrences")) & (F.col("_cut._ties") <= F.col("_cut.room"))
    )
    above = known.where(whole).select(*counts.columns)
    tied = known.where((F.col("_occurrences") == F.col("_cut._occurrences")) & (F.col("_cut._ties") > F.col("_cut.room")))
    numbered = running_total(tied.select(*counts.columns, F.col("_cut.room").alias("_room")), ["_class"], [F.asc("_term")], F.lit(1), "_place")
    return above.unionByName(numbered.where(F.col("_place") <= F.col("_room")).select(*counts.columns))
