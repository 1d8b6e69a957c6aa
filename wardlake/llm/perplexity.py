"""Quality rules: counts of each text and bands on its n-gram perplexity.

The models are modified Kneser-Ney models over characters. Texts are dealt into two folds by
their hash, each language has one model for each fold, and a model counts the other fold only: no
text is scored by counts of its own, nor by those of equal texts. Python tasks turn texts into
n-grams of whole code points and sum them within the task; Spark sums them over the corpus, derives continuation
counts, discounts and interpolated probabilities by grouping and joining. The tables hold the
n-grams of both folds, so each has a probability in either model, by lower orders where a model has
not counted it.

Every n-gram of a language keeps an entry of its own, known by 64 bits. The entries are dealt by
these into ranges of about ``RANGE``; one range after another is broadcast as sorted arrays, and a
pass over the texts adds what it holds to their sums. So a task needs the same memory at any size,
and a corpus with more n-grams takes more passes; between passes the texts are stored with their
sums.

A text is rejected if its mean log probability leaves the band of its language: median plus or
minus ``SPREAD`` times the distance of the quartiles, of its different texts (copies count once, so that
many of one text do not narrow the band).

Defined results: a null or empty text has no words, fails the base rules and no band; texts of one
character are scored as any other; null languages form a language of their own; a language with
texts in one fold only is scored by uniform probabilities; repeated rows give repeated results; other columns are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.llm.arrays import NOT_SPACE, Rolling, Words, byte_class, mix, row_sums, slices, windows
from wardlake.llm.stored import drop_stored, stored

ORDER = 5
#: A symbol is a code point plus 1; 0 is the place before a text.
SYMBOL_BITS = 21
SYMBOLS = 0x110000
#: Symbols in a packed number; an n-gram is two, the earlier symbols in ``head``, the latest in ``gram``.
PACKED = 3
#: N-grams that are broadcast at once (16 bytes each).
RANGE = 1 << 22
#: The folds of the texts; the model of a fold counts all others.
FOLDS = ("0", "1")
SPREAD = 5.0
#: N-grams that a counting task holds before it sums them up.
HELD = 2_000_000

SYMBOL_BYTES = byte_class(*((ord(c), ord(c)) for c in "#*$%&|<>"))
REPEAT_WINDOW = 8


class Model(NamedTuple):
    """One range of n-grams: sorted hashes, and the log probabilities of each for the texts of
    either fold."""

    hashes: np.ndarray
    log_p: np.ndarray


def symbols(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The symbols of a slice and the bounds of the rows."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[bounds]
    return points.astype(np.int64) + 1, starts


def ngrams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The n-gram that ends at each character (head and gram, the latest symbol in the lowest bits), and
    the bounds of the rows."""
    points, starts = symbols(data, bounds)
    n = len(points)
    depth = np.arange(n) - np.repeat(starts[:-1], np.diff(starts))
    head, gram = np.zeros(n, np.int64), points.copy()
    for k in range(1, min(ORDER, n)):
        part, place = (gram, k) if k < PACKED else (head, k - PACKED)
        part[k:] |= np.where(depth[k:] >= k, points[: n - k], 0) << (SYMBOL_BITS * place)
    return head, gram, starts


def gram_hashes(lang: np.ndarray | int, head: np.ndarray, gram: np.ndarray) -> np.ndarray:
    return mix(mix(mix(np.atleast_1d(lang).astype(np.uint64)) + head.astype(np.uint64)) + gram.astype(np.uint64))


class Counts(NamedTuple):
    """N-grams in the order of their hashes, and their counts."""

    hashes: np.ndarray
    head: np.ndarray
    gram: np.ndarray
    n: np.ndarray


def _summed(parts: list[Counts]) -> Counts:
    hashes, head, gram, n = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(hashes, kind="stable")
    hashes = hashes[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    return Counts(hashes[first], head[order[first]], gram[order[first]], np.add.reduceat(n[order], first))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[int, int], list[Counts]] = {}
    size = 0
    for batch in batches:
        for part, data, bounds in slices(batch):
            if not len(data):
                continue
            head, gram, starts = ngrams(data, bounds)
            hashes = gram_hashes(0, head, gram)
            rows: dict[tuple[int, int], list[int]] = {}
            for r, of in enumerate(zip(part.column(0).to_pylist(), part.column(1).to_pylist())):
                if starts[r + 1] > starts[r]:
                    rows.setdefault(of, []).append(r)
            for of, mine in rows.items():
                at = np.concatenate([np.arange(starts[r], starts[r + 1]) for r in mine])
                at = at[np.argsort(hashes[at])]
                first = np.flatnonzero(np.concatenate([[True], hashes[at[1:]] != hashes[at[:-1]]]))
                n = np.diff(np.append(first, len(at)))
                held.setdefault(of, []).append(Counts(hashes[at[first]], head[at[first]], gram[at[first]], n))
                size += len(first)
            if size > HELD:
                held = {of: [_summed(parts)] for of, parts in held.items()}
                size = 0
    for (lang, fold), parts in held.items():
        _, *columns = _summed(parts)
        for low in range(0, len(columns[0]), 100_000):
            made = [pa.array(c[low : low + 100_000].astype(np.int64)) for c in columns]
            n = len(made[0])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(n, lang)), pa.array(np.full(n, fold, np.int32)), *made], names=["lang", "fold", "head", "gram", "n"]
            )


GRAM, CONTEXT, SUFFIX = ("head", "gram"), ("context_head", "context"), ("suffix_head", "suffix")


def latest(n: int) -> tuple[Column, Column]:
    """Head and gram of the latest n symbols of an n-gram."""
    masks = [F.lit((1 << (SYMBOL_BITS * min(max(k, 0), PACKED))) - 1) for k in (n - PACKED, n)]
    return tuple(F.col(c).bitwiseAND(mask) for c, mask in zip(GRAM, masks))


def earliest() -> tuple[Column, Column]:
    """Head and gram of an n-gram without its latest symbol."""
    moved = F.shiftleft(F.col("head").bitwiseAND(F.lit((1 << SYMBOL_BITS) - 1)), SYMBOL_BITS * (PACKED - 1))
    return F.shiftright("head", SYMBOL_BITS), F.shiftright("gram", SYMBOL_BITS).bitwiseOR(moved)


def count_ngrams(df: DataFrame, text: str = "text", lang: Column | None = None, folds: tuple[str, ...] = ("",)) -> DataFrame:
    """(lang, head, gram, n of each fold): how often each n-gram of the highest order stands in the texts
    of a language (by its hash) outside the fold; a single fold stands for all texts."""
    one = len(folds) == 1
    return (
        df.select(
            (F.lit(0).cast("bigint") if lang is None else F.xxhash64(lang)).alias("lang"),
            (F.lit(-1) if one else fold_of(F.col(text))).alias("fold"),
            F.col(text).alias("text"),
        )
        .mapInArrow(_count, "lang bigint, fold int, head bigint, gram bigint, n bigint")
        .groupBy("lang", *GRAM)
        .agg(*(F.sum(F.when(F.col("fold") != k, F.col("n")).otherwise(0)).alias(f"n{m}") for k, m in enumerate(folds)))
    )


def fold_of(text: Column) -> Column:
    """Equal texts share their fold."""
    return F.pmod(F.xxhash64(text), F.lit(len(FOLDS))).cast("int")


def _discounts(table: DataFrame, folds: tuple[str, ...]) -> DataFrame:
    """By language, discounts for counts of 1, 2, and 3 or more, from the counts of counts."""
    times = [F.sum((F.col(f"n{m}") == k).cast("bigint")).alias(f"t{k}{m}") for m in folds for k in (1, 2, 3, 4)]
    made = []
    for m in folds:
        n1, n2, n3, n4 = (F.col(f"t{k}{m}") for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        raw = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, F.when(n3 > 0, 3 - 4 * y * n4 / n3).otherwise(1.5)]
        for k, (d, plain) in enumerate(zip(raw, (0.5, 0.75, 0.9)), start=1):
            bound = F.least(F.greatest(d, F.lit(0.05)), F.lit(k - 0.05))
            made.append(F.when((n1 > 0) & (n2 > 0), bound).otherwise(plain).alias(f"d{k}{m}"))
    return table.groupBy("lang").agg(*times).select("lang", *made)


def probabilities(counts: DataFrame, folds: tuple[str, ...] = ("",)) -> DataFrame:
    """(lang, head, gram, n, p of each fold): interpolated modified Kneser-Ney probability of the last
    symbol of each n-gram, for each fold by the counts ``n`` outside it.

    Below the highest order, the count of a gram is the number of different symbols before it. A
    gram or context that a model has not counted is left to the next lower order.
    """
    tables = [counts]
    for n in range(ORDER - 1, 0, -1):
        lower = tables[0].groupBy("lang", *(c.alias(name) for c, name in zip(latest(n), GRAM))).agg(
            *(F.sum((F.col(f"n{m}") > 0).cast("bigint")).alias(f"n{m}") for m in folds)
        )
        tables.insert(0, stored(lower, f"grams{n}"))
    p = None
    for order, table in enumerate(tables, start=1):
        rows = table.join(F.broadcast(_discounts(table, folds)), "lang").withColumns(dict(zip(CONTEXT, earliest())))
        for m in folds:
            n = F.col(f"n{m}")
            discount = F.when(n == 0, 0.0).when(n == 1, F.col(f"d1{m}")).when(n == 2, F.col(f"d2{m}")).otherwise(F.col(f"d3{m}"))
            rows = rows.withColumn(f"off{m}", discount)
        contexts = rows.groupBy("lang", *CONTEXT).agg(
            *(F.sum(f"n{m}").alias(f"total{m}") for m in folds), *(F.sum(f"off{m}").alias(f"rest{m}") for m in folds)
        )
        rows = rows.join(contexts, ["lang", *CONTEXT])
        if p is not None:
            back = p.select("lang", *(F.col(c).alias(name) for c, name in zip(GRAM, SUFFIX)), *(F.col(f"p{m}").alias(f"back{m}") for m in folds))
            rows = rows.withColumns(dict(zip(SUFFIX, latest(order - 1)))).join(back, ["lang", *SUFFIX])
        made = []
        for m in folds:
            n, off, total, rest = (F.col(f"{c}{m}") for c in ("n", "off", "total", "rest"))
            lower_p = F.lit(1 / SYMBOLS) if p is None else F.col(f"back{m}")
            made += [n, F.when(total > 0, (n - off) / total + rest / total * lower_p).otherwise(lower_p).alias(f"p{m}")]
        p = rows.select("lang", *GRAM, *made)
    return p


def entries(table: DataFrame, ranges: int) -> DataFrame:
    """(part, hash, log probability of each fold) of every n-gram, dealt into ranges."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lang, head, gram, *p = (batch.column(k).to_numpy() for k in range(3 + len(FOLDS)))
            hashes = gram_hashes(lang, head, gram)
            logs = [pa.array(np.log(x).astype(np.float32)) for x in p]
            yield pa.RecordBatch.from_arrays(
                [pa.array((hashes % np.uint64(ranges)).astype(np.int32)), pa.array(hashes.view(np.int64)), *logs],
                names=["part", "hash", *(f"log_p{m}" for m in FOLDS)],
            )

    schema = ", ".join(["part int, hash bigint", *(f"log_p{m} float" for m in FOLDS)])
    return table.select("lang", *GRAM, *(f"p{m}" for m in FOLDS)).mapInArrow(run, schema)


def train(df: DataFrame, text: str = "text", lang: str = "lang") -> tuple[DataFrame, int]:
    """The entries of the models of all languages, and the number of their ranges."""
    counts = stored(count_ngrams(df, text, F.col(lang), FOLDS), "grams")
    ranges = max(1, -(-counts.count() // RANGE))
    return stored(entries(probabilities(counts, FOLDS), ranges), "entries"), ranges


def load(table: DataFrame, part: int) -> Model:
    """One range of the entries."""
    rows = table.where(F.col("part") == part).drop("part").toArrow()
    hashes = rows.column("hash").to_numpy().view(np.uint64)
    order = np.argsort(hashes)
    return Model(hashes[order], np.stack([rows.column(f"log_p{m}").to_numpy()[order].astype(np.float32) for m in FOLDS], axis=1))


def log_probabilities(model: Model, fold: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Those of the n-grams (by hash) in this range, and 0 for those of other ranges."""
    if not len(model.hashes):
        return np.zeros(len(grams), np.float32)
    # each n-gram of a slice is sought once, in order
    hashes, which = np.unique(grams, return_inverse=True)
    at = np.minimum(np.searchsorted(model.hashes, hashes), len(model.hashes) - 1)
    found = np.where((model.hashes[at] == hashes)[:, None], model.log_p[at], np.float32(0))
    return found[which, fold]


def base_counts(data: np.ndarray, bounds: np.ndarray) -> dict[str, np.ndarray]:
    """Words, their characters, symbols, repeated lines and words in repeated windows, by row."""
    words = Words(data, bounds, NOT_SPACE)
    n_rows = len(bounds) - 1
    rolling = Rolling(data)
    in_word = NOT_SPACE[data] & ((data & 0xC0) != 0x80)

    # lines: between line feeds and the bounds of rows
    feeds = np.flatnonzero(data == 10)
    start = np.unique(np.concatenate([bounds[:-1], feeds + 1]))
    start = start[start < len(data)]
    end = np.concatenate([start[1:], [len(data)]])[: len(start)]
    end = np.where((end > start) & (data[np.maximum(end - 1, 0)] == 10), end - 1, end) if len(start) else start
    row = np.searchsorted(bounds, start, side="right") - 1
    inked = np.searchsorted(words.start, end) > np.searchsorted(words.start, start)
    start, end, row = start[inked], end[inked], row[inked]
    key = mix(rolling(start, end) + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    seen = np.unique(key, return_index=True)[1]
    again = np.ones(len(key), bool)
    again[seen] = False

    hashes, at = windows(words, rolling(words.start, words.end), REPEAT_WINDOW)
    hashes = mix(hashes + words.row[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, at[twice], 1)
    np.add.at(cover, at[twice] + REPEAT_WINDOW, -1)
    covered = np.cumsum(cover)[:-1] > 0
    return {
        "n_words": words.counts.astype(np.int64),
        "word_chars": row_sums(in_word, bounds),
        "n_symbols": row_sums(SYMBOL_BYTES[data], bounds),
        "n_dup_lines": np.bincount(row[again], minlength=n_rows).astype(np.int64),
        "n_repeat_words": row_sums(covered, words.first),
    }


COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def add_range(df: DataFrame, model: Model) -> DataFrame:
    """The frame with what a range holds of each text added to ``_sum``."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in slices(batch, "_text"):
                head, gram, starts = ngrams(data, bounds)
                n = np.diff(starts)
                lang, fold = (np.repeat(part.column(c).to_numpy(), n) for c in ("_lang", "_fold"))
                sums = np.concatenate([[0.0], np.cumsum(log_probabilities(shared.value, fold, gram_hashes(lang, head, gram)), dtype=np.float64)])
                made = {"_sum": pa.array(part.column("_sum").to_numpy() + sums[starts[1:]] - sums[starts[:-1]]), "_length": pa.array(n.astype(np.int64))}
                yield pa.RecordBatch.from_arrays([made.get(c, part.column(c)) for c in part.schema.names], names=part.schema.names)

    return df.mapInArrow(run, df.schema)


def measure(df: DataFrame, model: tuple[DataFrame, int], keep: tuple[str, ...] = ("doc_id", "lang"), text: str = "text", lang: str = "lang") -> DataFrame:
    """The counts of each text, its hash and its mean log probability (null without characters)."""
    kinds = [*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), "text_hash bigint"]
    schema = ", ".join([*kinds, *(f"{c} bigint" for c in COUNTS), "log_p double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in slices(batch, "_text"):
                counts = base_counts(data, bounds)
                total, n = (part.column(c).to_numpy() for c in ("_sum", "_length"))
                # rounded, so that equal texts have equal means wherever they stand
                mean = np.round(total / np.maximum(n, 1), 6)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[: len(keep) + 1], *(pa.array(counts[c]) for c in COUNTS), pa.array(mean, mask=n == 0)],
                    names=[*keep, "text_hash", *COUNTS, "log_p"],
                )

    summed = df.select(
        *keep, F.xxhash64(text).alias("text_hash"), F.xxhash64(lang).alias("_lang"), fold_of(F.col(text)).alias("_fold"),
        F.lit(0.0).alias("_sum"), F.lit(0).cast("bigint").alias("_length"), F.col(text).alias("_text"),
    )
    table, ranges = model
    before = None
    for k in range(ranges):
        summed = add_range(summed, load(table, k))
        if k < ranges - 1:
            summed = stored(summed, f"sums{k}")
            if before is not None:
                drop_stored(before)
            before = summed
    return summed.mapInArrow(run, schema)


def bands(measured: DataFrame, spread: float = SPREAD) -> DataFrame:
    """The lowest and highest mean log probability that each language accepts."""
    quartiles = F.percentile_approx("log_p", [0.25, 0.5, 0.75], 10_000)
    width = (F.col("q")[2] - F.col("q")[0]) * spread
    return measured.select("lang", "text_hash", "log_p").distinct().groupBy("lang").agg(quartiles.alias("q")).select(
        "lang", (F.col("q")[1] - width).alias("least_log_p"), (F.col("q")[1] + width).alias("most_log_p")
    )


def quality_rules(df: DataFrame) -> DataFrame:
    """Counts, perplexity, and both verdicts for every document (doc_id, lang, text)."""
    docs = df.select("doc_id", "lang", "text")
    measured = stored(measure(docs, train(docs)), "measured")
    limits = bands(measured).withColumnRenamed("lang", "_lang")
    failed = (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))
    inside = F.coalesce(F.col("log_p").between(F.col("least_log_p"), F.col("most_log_p")), F.lit(True))
    return measured.join(limits, F.col("lang").eqNullSafe(F.col("_lang")), "left").select(
        "doc_id",
        *COUNTS,
        failed.alias("base_failed"),
        (~failed & inside).alias("kept"),
        F.exp(-F.col("log_p")).alias("perplexity"),
        F.exp(-F.col("most_log_p")).alias("least_perplexity"),
        F.exp(-F.col("least_log_p")).alias("most_perplexity"),
    )
