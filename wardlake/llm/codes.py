"""Vector compression by product codes: parts of integer vectors, each named by its nearest entry.

A vector's components become integers, ``floor(scale * x)``, and are cut into equal parts; every
part position has a codebook. The distinct parts of a chunk of rows, sorted, are the leaves of a
lexicographic trie, one level for each component of a part. A depth-first walk carries for each node the
vector of distances to all entries, summed over the components on the way down, so parts that begin alike
share that work; siblings are walked in runs, so a level holds at most ``NODES`` such vectors. A leaf
takes the argmin, and its weight (the rows that hold the part) times the part goes into the sums
from which the next codebook is made.

Chunks are made within tasks and only sums by position and entry leave them, so no vector is
shuffled before it is a code; the driver holds codebooks, whose size depends on the dimension alone.

Defined results: rows without a vector, or with a null or non-finite component, are dropped. The dimension is that
of the smallest id whose vector can be cut into the parts; a vector of another length, or with a component
beyond ``+-LARGEST``, keeps its row but has neither code nor error. Null ids come last; equal ids are
ordered by their vectors, and repeated rows count as often as they stand there. With fewer rows than entries the codebooks are shorter. Error sums
beyond 64 bits are null. An empty table gives an empty result. Other columns are dropped, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.stored import stored

#: Nodes of a level that are walked at once.
NODES = 2048
#: Components of the vectors that share a trie.
CHUNK = 1 << 21
#: Largest component, either side of 0, before scaling; squares of scaled ones then fit 64 bits.
LARGEST = 2.0**19


class Codes(NamedTuple):
    parts: int = 16
    entries: int = 64
    rounds: int = 2
    scale: int = 256


def walk(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each sorted distinct part, the lower one of equals, and its squared distance."""
    n, width = parts.shape
    entry, distance = np.zeros(n, np.int64), np.zeros(n, np.int64)
    fork = np.zeros(n, np.int64)  # the level at which a part leaves the path of the one before
    if n > 1:
        fork[1:] = np.argmax(parts[1:] != parts[:-1], axis=1)

    def visit(nodes: np.ndarray, sums: np.ndarray, end: int, level: int) -> None:
        if level == width:
            entry[nodes] = sums.argmin(1)
            distance[nodes] = sums.min(1)
            return
        low = int(nodes[0])
        opens = fork[low:end] <= level
        opens[0] = True
        below = low + np.flatnonzero(opens)
        above = np.searchsorted(nodes, below, side="right") - 1
        for k in range(0, len(below), NODES):
            run = below[k : k + NODES]
            step = parts[run, level][:, None] - book[:, level]
            last = int(below[k + NODES]) if k + NODES < len(below) else end
            visit(run, sums[above[k : k + NODES]] + step * step, last, level + 1)

    if n:
        visit(np.zeros(1, np.int64), np.zeros((1, len(book)), np.int64), n, 0)
    return entry, distance


def distinct(parts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct parts, how often each stands there, and the place of each row's part."""
    order = np.lexsort(parts.T[::-1])
    ordered = parts[order]
    new = np.ones(len(parts), bool)
    new[1:] = (ordered[1:] != ordered[:-1]).any(1)
    place = np.empty(len(parts), np.int64)
    place[order] = np.cumsum(new) - 1
    starts = np.flatnonzero(new)
    return ordered[starts], np.diff(np.append(starts, len(parts))), place


def _chunks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[pa.Table]:
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += len(batch)
        if rows * dim >= CHUNK:
            yield pa.Table.from_batches(held)
            held, rows = [], 0
    if rows:
        yield pa.Table.from_batches(held)


def _integers(chunk: pa.Table, dim: int, scale: int) -> np.ndarray:
    vectors = chunk.column("vector").combine_chunks()
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return np.floor(values * scale).astype(np.int64).reshape(-1, dim)


def _usable(dim: int) -> F.Column:
    return (F.size("vector") == dim) & F.forall("vector", lambda x: F.abs(x) <= LARGEST)


def codebooks(kept: DataFrame, dim: int, how: Codes) -> np.ndarray:
    """Entries by part position, entry and component, after all rounds; ``kept`` has id and vector."""
    width = dim // how.parts
    rows = kept.where(_usable(dim)).orderBy(F.asc_nulls_last("id"), "vector").limit(how.entries).select("vector").collect()
    first = np.array([r.vector for r in rows], np.float64).reshape(len(rows), dim)
    books = np.floor(first * how.scale).astype(np.int64).reshape(-1, how.parts, width).swapaxes(0, 1)
    sums = [f"s{k}" for k in range(width)]

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(books.shape[:2], np.int64)
        total = np.zeros(books.shape, np.int64)
        for chunk in _chunks(batches, dim):
            numbers = _integers(chunk, dim, how.scale)
            for p in range(how.parts):
                leaves, weight, _ = distinct(numbers[:, p * width : (p + 1) * width])
                entry, _ = walk(leaves, books[p])
                np.add.at(count[p], entry, weight)
                np.add.at(total[p], entry, leaves * weight[:, None])
        at, entry = np.nonzero(count)
        columns = [at, entry, count[at, entry], *total[at, entry].T]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["at", "entry", "n", *sums])

    schema = "at bigint, entry bigint, n bigint, " + ", ".join(f"{s} bigint" for s in sums)
    for _ in range(how.rounds):
        moved = kept.where(_usable(dim)).select("vector").mapInArrow(weigh, schema)
        moved = moved.groupBy("at", "entry").agg(*[F.sum(c).alias(c) for c in ("n", *sums)]).collect()
        books = books.copy()
        for row in moved:
            books[row.at, row.entry] = np.array(row[3:], np.int64) // row.n
    return books


def compress(
    vectors: DataFrame, id_column: str = "vec_id", vector: str = "embedding", label: str = "label", how: Codes = Codes()
) -> DataFrame:
    """One row per vector: id, code (two hex digits a part), squared error, the error of all
    vectors of its label, and the digest of the codebooks."""
    element = vectors.schema[vector].dataType.elementType.typeName()
    column = F.col(vector) if element in ("float", "double") else F.col(vector).cast("array<double>")
    kept = vectors.select(F.col(id_column).alias("id"), F.col(label).alias("label"), column.alias("vector")).where(
        F.col("vector").isNotNull() & F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    )
    whole = (F.size("vector") > 0) & (F.size("vector") % how.parts == 0)
    first = kept.where(whole).orderBy(F.asc_nulls_last("id"), "vector").select(F.size("vector").alias("dim")).first()
    dim = first.dim if first else how.parts
    width = dim // how.parts
    books = codebooks(kept, dim, how)
    digits = np.array([f"{k:02x}" for k in range(max(len(books[0]), 1))], dtype=object)

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for chunk in _chunks(batches, dim):
            numbers = _integers(chunk, dim, how.scale)
            error = np.zeros(len(numbers), np.int64)
            code = np.full(len(numbers), "", dtype=object)
            for p in range(how.parts):
                leaves, _, place = distinct(numbers[:, p * width : (p + 1) * width])
                entry, distance = walk(leaves, books[p])
                error += distance[place]
                code += digits[entry][place]
            made = pa.table(
                [chunk.column("id"), chunk.column("label"), pa.array(code, pa.string()), pa.array(error)],
                names=["id", "label", "code", "error"],
            )
            yield from made.to_batches()

    kinds = {f.name: f.dataType.simpleString() for f in kept.schema}
    schema = f"id {kinds['id']}, label {kinds['label']}, code string, error bigint"
    coded = kept.where(_usable(dim)).mapInArrow(name, schema)
    if not books.shape[1]:
        coded = coded.limit(0)
    other = kept.where(~_usable(dim)).select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("bigint").alias("error"))
    coded = stored(coded.union(other), "codes")
    labels = coded.groupBy(F.col("label").alias("_of")).agg(F.try_sum("error").alias("label_error"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    return coded.join(labels, F.col("label").eqNullSafe(F.col("_of")), "left").select(
        F.col("id").alias(id_column), "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
