"""Toxicity: a convolutional text classifier over hashed words, trained in numpy.

A word is embedded as the sum of learned vectors of hashes of itself and of its first bytes (so
that forms of one stem share a vector); hashes too rare in the training sample stay zero. Filters
of widths 1, 2 and 3 run over the words; their responses are max-pooled over blocks of ``BLOCK``
words, and the block maxima of a text are pooled again (largest, mean, logarithm of the sum), so
that a text of any length is scored whole. Thresholds are calibrated by language on rows of the
sample that the filters were not trained on.

The sample is bounded by ``SAMPLE`` rows of each label, chosen by a hash of the id; losses are
weighted back to the shares of all labelled rows. The model (a table of 2**HASH_BITS row numbers
and the vectors) has a fixed bound and is broadcast.

Defined results: null and empty texts get the score of a text without words; without labelled
rows of both kinds every score is the share of label 1 (0.5 without labels); labels repeated for
an id count by their largest; a null id or label is no label; repeated rows give repeated results.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.llm.arrays import ALNUM, LOWER, Rolling, Words, slices

SAMPLE = 4_000
HASH_BITS = 22
PREFIXES = (4, 5, 6, 7, 8)
DIMENSIONS = 8
WIDTHS = (1, 2, 3)
FILTERS = 8
BLOCK = 8
EPOCHS = 6
RATE = 0.02
#: Rows of the sample in which a hash has to stand to get a vector.
LEAST_ROWS = 3
DEFAULT_THRESHOLD = 0.3


class Model(NamedTuple):
    rows: np.ndarray  # row of the vectors for each hash, 0 without one
    vectors: np.ndarray
    filters: list[np.ndarray]  # for each width, (width, DIMENSIONS, FILTERS)
    bias: np.ndarray
    weights: np.ndarray
    offset: float
    thresholds: dict[str | None, float]


def word_hashes(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of words and their first bytes in a padded layout, the first block of each row, and
    which places hold a word.

    Every row starts a block and ends with at least two empty places, so that no filter at a word
    reaches into the next row. Hash 0 stands for nothing.
    """
    low = LOWER[data]
    words = Words(low, bounds, ALNUM)
    blocks = (words.counts + max(WIDTHS) - 1 + BLOCK - 1) // BLOCK
    first = np.concatenate([[0], np.cumsum(np.maximum(blocks, 1))])
    place = np.arange(len(words)) - words.first[words.row] + first[words.row] * BLOCK
    out = np.zeros((first[-1] * BLOCK, 1 + len(PREFIXES)), np.int32)
    if len(words):
        rolling = Rolling(low)
        shift = np.uint64(64 - HASH_BITS)
        out[place, 0] = rolling(words.start, words.end) >> shift
        for k, n in enumerate(PREFIXES, start=1):
            long = words.end - words.start > n
            start = words.start[long]
            out[place[long], k] = (rolling(start, start + n) ^ np.uint64(n << 60)) >> shift
    real = np.zeros(len(out), bool)
    real[place] = True
    return out, first, real


def _pool(model: Model, numbers: np.ndarray, first: np.ndarray, real: np.ndarray):
    """Inputs of the last layer for each row, with what the training needs to go back."""
    x = model.vectors[numbers[:, 0]]
    for k in range(1, numbers.shape[1]):
        x = x + model.vectors[numbers[:, k]]
    made = []
    for width, own in zip(WIDTHS, model.filters):
        y = x @ own[0]
        for j in range(1, width):
            y[:-j] += x[j:] @ own[j]
        made.append(y)
    y = (np.concatenate(made, axis=1) + model.bias) * real[:, None]
    y = y.reshape(-1, BLOCK, y.shape[1])
    best = np.maximum(y.max(axis=1), 0)
    n = np.diff(first)[:, None]
    total = np.add.reduceat(best, first[:-1], axis=0)
    pooled = np.concatenate([np.maximum.reduceat(best, first[:-1], axis=0), total / n, np.log1p(total), np.log(n)], axis=1)
    return pooled, (x, y, best, total, n)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def score_slice(model: Model, data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    hashes, first, real = word_hashes(data, bounds)
    pooled, _ = _pool(model, model.rows[hashes], first, real)
    return _sigmoid(pooled @ model.weights + model.offset)


class _Adam:
    def __init__(self, *parts: np.ndarray) -> None:
        self.parts = parts
        self.first = [np.zeros_like(p) for p in parts]
        self.second = [np.zeros_like(p) for p in parts]
        self.steps = 0

    def step(self, *gradients: np.ndarray) -> None:
        self.steps += 1
        for part, g, a, b in zip(self.parts, gradients, self.first, self.second):
            a *= 0.9
            a += 0.1 * g
            b *= 0.999
            b += 0.001 * g * g
            part -= RATE * (a / (1 - 0.9**self.steps)) / (np.sqrt(b / (1 - 0.999**self.steps)) + 1e-8)


def _constant(share: float) -> Model:
    """A model that scores every text alike."""
    n = FILTERS * len(WIDTHS)
    share = min(max(share, 1e-6), 1 - 1e-6)
    return Model(
        np.zeros(1 << HASH_BITS, np.int32),
        np.zeros((1, DIMENSIONS), np.float32),
        [np.zeros((w, DIMENSIONS, FILTERS), np.float32) for w in WIDTHS],
        np.zeros(n, np.float32),
        np.zeros(3 * n + 1, np.float32),
        math.log(share / (1 - share)),
        {},
    )


def fit(texts: pa.Array, labels: np.ndarray, langs: list[str | None], weights: np.ndarray, seed: int = 1) -> Model:
    """Train on the texts; each fifth row is left out to calibrate the thresholds."""
    share = float((labels * weights).sum() / weights.sum()) if len(labels) else 0.5
    if len(np.unique(labels)) < 2:
        return _constant(share)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(labels))
    held, trained = np.sort(order[: len(order) // 5]), np.sort(order[len(order) // 5 :])

    # rows of the sample with each hash, by label; only hashes in enough rows get a vector
    is_trained = np.zeros(len(labels), bool)
    is_trained[trained] = True
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    in_rows = np.zeros((2, 1 << HASH_BITS), np.int32)
    low = 0
    for part, data, bounds in slices(batch):
        hashes, first, _ = word_hashes(data, bounds)
        row = low + np.repeat(np.arange(len(part)), np.diff(first) * BLOCK)
        low += len(part)
        used = is_trained[row]
        pairs = np.unique((hashes[used].astype(np.int64) << 32 | row[used, None]).ravel())
        toxic = labels[pairs & 0xFFFFFFFF] > 0
        for k, mine in enumerate((pairs[~toxic], pairs[toxic])):
            np.add.at(in_rows[k], mine >> 32, 1)
    in_rows[:, 0] = 0
    active = np.flatnonzero(in_rows.any(axis=0))
    df, df1 = in_rows[:, active].sum(axis=0), in_rows[1, active]
    del in_rows
    keep = df >= LEAST_ROWS
    active, df, df1 = active[keep], df[keep], df1[keep]
    n1 = int(labels[trained].sum())
    n0 = len(trained) - n1
    odds = np.log((df1 + 0.5) / (n1 + 1)) - np.log((df - df1 + 0.5) / (n0 + 1))
    z = odds / np.sqrt(1 / (df1 + 0.5) + 1 / (df - df1 + 0.5))

    start = _constant(share)
    rows = start.rows
    rows[active] = np.arange(1, len(active) + 1)
    vectors = rng.normal(0, 0.02, (len(active) + 1, DIMENSIONS)).astype(np.float32)
    vectors[1:, 0] += np.sign(z) * np.maximum(np.abs(z) - 3, 0) / 6
    vectors[0] = 0
    filters = [rng.normal(0, 0.3, f.shape).astype(np.float32) for f in start.filters]
    for f in filters:
        f[0, 0, : FILTERS // 2] += 1.0
    bias = np.full(FILTERS * len(WIDTHS), -0.1, np.float32)
    out = rng.normal(0, 0.05, 3 * len(bias) + 1).astype(np.float32)
    offset = np.array([start.offset], np.float32)
    model = Model(rows, vectors, filters, bias, out, 0.0, {})
    # layout of every text, texts end to end
    laid, words, at = [], [], [0]
    for _, data, bounds in slices(batch):
        hashes, first, real = word_hashes(data, bounds)
        laid.append(rows[hashes])
        words.append(real)
        at.extend(first[1:] + at[-1])
    numbers, words, at = np.concatenate(laid), np.concatenate(words), np.array(at)
    del laid
    adam = _Adam(vectors, *filters, bias, out, offset)
    m = len(bias)

    def batch_of(chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        first = np.concatenate([[0], np.cumsum(at[chosen + 1] - at[chosen])])
        take = np.repeat(at[chosen] - first[:-1], np.diff(first)) + np.arange(first[-1])
        own = numbers.reshape(-1, BLOCK, numbers.shape[1])[take].reshape(-1, numbers.shape[1])
        return own, first, words.reshape(-1, BLOCK)[take].ravel()

    for _ in range(EPOCHS):
        mixed = rng.permutation(trained)
        for chosen in np.array_split(mixed, max(1, len(mixed) // 64)):
            own, first, real = batch_of(chosen)
            pooled, (x, y, best, total, n) = _pool(model, own, first, real)
            p = _sigmoid(pooled @ out + offset[0])
            d = (weights[chosen] * (p - labels[chosen]) / weights[chosen].sum()).astype(np.float32)
            d_out = pooled.T @ d + 1e-4 * out
            d_pool = d[:, None] * out
            of = np.repeat(np.arange(len(chosen)), np.diff(first))
            d_best = (d_pool[:, m : 2 * m] / n + d_pool[:, 2 * m : 3 * m] / (1 + total))[of]
            d_best += d_pool[of, :m] * (best == pooled[of, :m]) * (best > 0)
            d_best *= best > 0
            block, f = np.nonzero(d_best)
            g = d_best[block, f]
            place = block * BLOCK + y[block, :, f].argmax(axis=1)
            d_x = np.zeros_like(x)
            d_filters = []
            for k, (width, own_filter) in enumerate(zip(WIDTHS, filters)):
                mine = (f >= k * FILTERS) & (f < (k + 1) * FILTERS)
                response = np.zeros((len(x), FILTERS), np.float32)
                response[place[mine], f[mine] - k * FILTERS] = g[mine]
                d_own = np.zeros_like(own_filter)
                for j in range(width):
                    moved = response[: len(x) - j]
                    d_own[j] = x[j:].T @ moved
                    d_x[j:] += moved @ own_filter[j].T
                d_filters.append(d_own)
            d_vectors = np.zeros_like(vectors)
            touched = np.flatnonzero(np.abs(d_x).sum(axis=1))
            for k in range(own.shape[1]):
                np.add.at(d_vectors, own[touched, k], d_x[touched])
            d_vectors += 1e-5 * vectors
            d_vectors[0] = 0
            adam.step(d_vectors, *d_filters, np.bincount(f, g, minlength=m).astype(np.float32), d_out, d.sum(keepdims=True))
            vectors[0] = 0
    model = model._replace(offset=float(offset[0]))

    thresholds: dict[str | None, float] = {}
    scores = np.concatenate([_sigmoid(_pool(model, *batch_of(c))[0] @ out + offset[0]) for c in np.array_split(held, len(held) // 64 + 1) if len(c)] or [np.zeros(0)])
    for lang in set(langs):
        mine = np.array([langs[k] == lang for k in held], bool)
        if mine.any() and labels[held[mine]].any():
            thresholds[lang] = _best_threshold(scores[mine], labels[held[mine]], weights[held[mine]])
    return model._replace(thresholds=thresholds)


def _best_threshold(scores: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> float:
    """The score from which on flagging gives the largest F1."""
    order = np.argsort(-scores, kind="stable")
    s, hit, all_ = scores[order], np.cumsum((labels * weights)[order]), np.cumsum(weights[order])
    f1 = 2 * hit / (all_ + (labels * weights).sum())
    last = np.concatenate([s[1:] < s[:-1], [True]])
    k = int(np.argmax(np.where(last, f1, -1)))
    below = s[k + 1] if k + 1 < len(s) else 0.0
    return float((s[k] + below) / 2)


def is_held_out(modulus: int, rest: int) -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == rest, F.lit(False))


def train(df: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from rows of ``labels`` (doc_id, toxic) and their texts in ``df`` (doc_id, text, lang)."""
    known = labels.where("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("label"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count("*").alias("n")).collect()}
    chosen = None
    for label in (0, 1):
        part = known.where(F.col("label") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
        chosen = part if chosen is None else chosen.union(part)
    # at most 2 * sample short rows
    got = (
        df.select("doc_id", "text", "lang")
        .join(F.broadcast(chosen), "doc_id")
        .dropDuplicates(["doc_id"])
        .orderBy("doc_id")
        .select("text", "lang", "label")
        .toArrow()
    )
    y = got.column("label").to_numpy().astype(np.float32)
    weights = np.array([counts.get(int(v), 0) / max(1, (y == v).sum()) for v in y], np.float32)
    texts = got.column("text").combine_chunks()
    return fit(texts, y, got.column("lang").to_pylist(), weights / max(weights.sum(), 1e-9) * len(y))


def score(df: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id", "lang"), text: str = "text") -> DataFrame:
    """``score`` for every row, 0 to 1."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in slices(batch, "_text"):
                found = score_slice(shared.value, data, bounds).astype(np.float64)
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(found)], names=[*keep, "score"])

    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)


def toxicity(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents; rows whose crc32 leaves 2 on division by 4 are never learned from.

    ``threshold`` is the calibrated one of the language, ``flagged`` the verdict by it.
    """
    model = train(df, labels.where(~is_held_out(4, 2)))
    pairs = [(str(k), float(v)) for k, v in model.thresholds.items() if k is not None]
    spark = df.sparkSession
    limits = spark.createDataFrame(pairs, "_lang string, _threshold double")
    return (
        score(df, model)
        .join(F.broadcast(limits), F.col("lang") == F.col("_lang"), "left")
        .withColumn("threshold", F.coalesce("_threshold", F.lit(DEFAULT_THRESHOLD)))
        .select(
            "doc_id",
            is_held_out(4, 2).alias("held_out"),
            "score",
            (F.col("score") >= 0.3).cast("int").alias("predicted"),
            "threshold",
            (F.col("score") >= F.col("threshold")).cast("int").alias("flagged"),
        )
    )
