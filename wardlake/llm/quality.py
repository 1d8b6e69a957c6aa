"""Quality classifier: ridge regression on random Fourier features, calibrated isotonically.

Python tasks turn every whole text into a row of document statistics, which is stored: it is small
beside the texts, and training, calibration and scoring read it instead of them. Statistics are
standardized by means and deviations that Spark takes over all rows. Cosines of random projections
approximate a Gaussian kernel on them. Each task sums the normal equations of its labelled rows,
Spark adds the sums, and the driver solves one system of ``FEATURES`` + 1 unknowns. Raw scores of
the labelled rows are counted in ``BINS`` bins, and pooling adjacent violators over the bins gives
the calibrated score, linear between the centres of the pools.

Defined results: null and empty texts have statistics of their own (all zero) and are scored like
others; without labels every score is 0.5, with labels of one kind their share; labels repeated
for an id count by their largest; a null id or label is no label; repeated rows give repeated
results; other columns are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.arrays import NOT_SPACE, Rolling, Words, byte_class, mix, row_sums, slices
from wardlake.llm.perplexity import base_counts
from wardlake.llm.stored import stored
from wardlake.llm.toxicity import is_held_out

FEATURES = 256
BANDWIDTH = 2.5
RIDGE = 1e-3
BINS = 1_000
SEED = 11
#: Standardized statistics are cut here, so that no odd text leaves the kernel's range.
EXTREME = 4.0

_CLASSES = {
    "upper": byte_class((65, 90)),
    "letters": byte_class((65, 90), (97, 122), (0xC0, 0xFF)),
    "digits": byte_class((48, 57)),
    "bars": byte_class((ord("|"), ord("|"))),
    "bangs": byte_class((ord("!"), ord("!"))),
    "stops": byte_class(*((ord(c), ord(c)) for c in ".,;:?")),
    "feeds": byte_class((10, 10)),
    "beyond": byte_class((0xC0, 0xFF)),
}
STATISTICS = (
    "log_words", "word_length", "length_spread", "upper", "capitals", "digits", "symbols", "bars", "bangs", "stops",
    "lines", "beyond", "dup_lines", "repeats", "distinct", "longest",
)


def statistics(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One row of ``STATISTICS`` for each text of a slice."""
    words = Words(data, bounds, NOT_SPACE)
    base = base_counts(data, bounds)
    sums = {name: row_sums(table[data], bounds) for name, table in _CLASSES.items()}
    n_rows = len(bounds) - 1
    n = np.maximum(words.counts, 1)
    chars = np.maximum(base["word_chars"], 1)
    length = words.end - words.start
    mean = row_sums(length, words.first) / n
    square = row_sums(length.astype(np.int64) ** 2, words.first) / n
    longest = np.zeros(n_rows)
    np.maximum.at(longest, words.row, length)
    capital = _CLASSES["upper"][data[words.start]]
    hashes = mix(Rolling(data)(words.start, words.end) + words.row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    kinds = np.bincount(words.row[np.unique(hashes, return_index=True)[1]], minlength=n_rows)
    rows = [
        np.log1p(words.counts), np.log1p(mean), np.sqrt(np.maximum(square - mean**2, 0)), sums["upper"] / np.maximum(sums["letters"], 1),
        row_sums(capital, words.first) / n, sums["digits"] / chars, base["n_symbols"] / n, sums["bars"] / n, sums["bangs"] / n,
        sums["stops"] / n, sums["feeds"] / n, sums["beyond"] / chars, base["n_dup_lines"] / (sums["feeds"] + 1),
        base["n_repeat_words"] / n, kinds / n, np.log1p(longest),
    ]
    return np.stack(rows, axis=1).astype(np.float64)


def measure(df: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """``stats``: the statistics of every text."""
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), "stats array<double>"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in slices(batch, "_text"):
                values = statistics(data, bounds)
                offsets = np.arange(0, values.size + 1, values.shape[1], dtype=np.int32)
                column = pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.ravel()))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], column], names=[*keep, "stats"])

    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)


class Kernel(NamedTuple):
    """Standardization and random projections."""

    mean: np.ndarray
    spread: np.ndarray
    directions: np.ndarray
    phases: np.ndarray

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        x = np.clip((stats - self.mean) / self.spread, -EXTREME, EXTREME)
        z = np.cos(x @ self.directions + self.phases) * np.sqrt(2 / len(self.phases))
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)


class Model(NamedTuple):
    kernel: Kernel
    weights: np.ndarray
    centres: np.ndarray  # of pools of raw scores, ascending
    values: np.ndarray  # calibrated scores there

    def raw(self, stats: np.ndarray) -> np.ndarray:
        return self.kernel(stats) @ self.weights

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(stats), self.centres, self.values), 0.0, 1.0)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def kernel_of(measured: DataFrame) -> Kernel:
    columns = [f(F.col("stats")[k]) for k in range(len(STATISTICS)) for f in (F.mean, F.stddev_pop)]
    row = np.array([0.0 if v is None else v for v in measured.select(*columns).first()]).reshape(-1, 2)
    rng = np.random.default_rng(SEED)
    directions = rng.normal(0, 1 / BANDWIDTH, (len(STATISTICS), FEATURES))
    return Kernel(row[:, 0], np.where(row[:, 1] > 1e-9, row[:, 1], 1.0), directions, rng.uniform(0, 2 * np.pi, FEATURES))


def normal_equations(labelled: DataFrame, kernel: Kernel) -> np.ndarray:
    """Sums of products of the features, a constant and the label (last) over (stats, label)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES + 2, FEATURES + 2))
        for batch in batches:
            if len(batch):
                z = np.concatenate([kernel(_matrix(batch.column(0))), batch.column(1).to_numpy()[:, None]], axis=1)
                total += z.T @ z
        i, j = np.triu_indices(len(total))
        yield pa.RecordBatch.from_arrays([pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])], names=["i", "j", "v"])

    sums = (
        labelled.select("stats", F.col("label").cast("double"))
        .mapInArrow(run, "i int, j int, v double")
        .groupBy("i", "j")
        .agg(F.sum("v").alias("v"))
        .toArrow()
    )
    total = np.zeros((FEATURES + 2, FEATURES + 2))
    i, j, v = (sums.column(c).to_numpy() for c in "ijv")
    total[i, j] = v
    total[j, i] = v
    return total


def pool_adjacent(at: np.ndarray, n: np.ndarray, hits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Centres and rates of the pools of an isotonic fit, by ascending place."""
    pools: list[list[float]] = []
    for x, a, b in zip(at, n, hits):
        pools.append([x * a, a, b])
        while len(pools) > 1 and pools[-2][2] * pools[-1][1] >= pools[-1][2] * pools[-2][1]:
            last = pools.pop()
            pools[-1] = [p + q for p, q in zip(pools[-1], last)]
    return np.array([p[0] / p[1] for p in pools]), np.array([p[2] / p[1] for p in pools])


def train(measured: DataFrame, labels: DataFrame) -> Model:
    """A model from ``labels`` (doc_id, quality) and statistics (doc_id, stats)."""
    known = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("label"))
    labelled = stored(measured.join(known, "doc_id").select("stats", "label"), "labelled")
    kernel = kernel_of(measured)
    total = normal_equations(labelled, kernel)
    n, hits = total[FEATURES, FEATURES], total[FEATURES, FEATURES + 1]
    if n == 0 or hits in (0, n):
        share = 0.5 if n == 0 else float(hits > 0)
        return Model(kernel, np.zeros(FEATURES + 1), np.zeros(1), np.full(1, share))
    ridge = RIDGE * n * np.eye(FEATURES + 1)
    ridge[-1, -1] = 0
    weights = np.linalg.solve(total[:-1, :-1] + ridge, total[:-1, -1])
    model = Model(kernel, weights, np.zeros(1), np.zeros(1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                bins = np.floor(np.clip(model.raw(_matrix(batch.column(0))), -0.5, 1.5) * BINS).astype(np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(bins), batch.column(1)], names=["bin", "label"])

    counts = labelled.select("stats", F.col("label").cast("bigint")).mapInArrow(run, "bin int, label bigint").groupBy("bin")
    rows = sorted(counts.agg(F.count("*").alias("n"), F.sum("label").alias("hits")).collect())
    at, n_bin, hit_bin = np.array(rows, float).T
    centres, values = pool_adjacent((at + 0.5) / BINS, n_bin, hit_bin)
    return model._replace(centres=centres, values=values)


def score(measured: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    schema = ", ".join([*(f"`{c}` {measured.schema[c].dataType.simpleString()}" for c in keep), "score double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                found = model(_matrix(batch.column(len(keep))))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(found)], names=[*keep, "score"])

    return measured.select(*keep, "stats").mapInArrow(run, schema)


def good(df: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows whose text scores ``least`` or more; all columns stay, and no text is shuffled.

    Labels are learned from as in ``quality``.
    """
    model = train(stored(measure(df), "statistics"), labels.where(~is_held_out(3, 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in slices(batch):
                yield part.filter(pa.array(model(statistics(data, bounds)) >= least))

    return df.mapInArrow(run, df.schema)


def quality(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Scores of all documents; rows whose crc32 leaves 1 on division by 3 are never learned from."""
    measured = stored(measure(df), "statistics")
    model = train(measured, labels.where(~is_held_out(3, 1)))
    return score(measured, model).select(
        "doc_id", is_held_out(3, 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )
