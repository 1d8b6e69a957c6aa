"""How filters interact: what each removes, alone and behind others, in every order they could have.

A document has a mask with a bit for each filter it fails. Whatever the order of the filters, the mask says
what becomes of the document at each step; so every mask maps to wide integers with one field for each of
the steps of all orders (600 for five filters), 1 where the document is kept, removed, or would have been removed
again. These integers, times the number of documents with the mask, are summed by part and then
unpacked. A field has 64 bits and holds a count of rows, so none flows over into the next.

Documents are counted by part and mask before that, so a part sends at most a row per mask and task, and
the hot part of a third of all rows costs no more than others. Equal texts are found by digest:
each digest's smallest id is aggregated, and rows look themselves up by digest and id together, so
a text that a third of the rows share spreads over all tasks.

Defined results: a null text is empty (and thus a copy of any other empty text), a null part is the
empty string. Rows with equal ids are not copies of each other; a null id comes after all others. Labels that stand there
twice count if any of them says so; without a label a document is neither good nor toxic. Empty tables give no
rows. Texts of any length are read in pieces of ``PIECE`` bytes; memory grows with the distinct
words of a text only. Other columns are dropped, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import permutations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.arrays import utf8
from wardlake.llm.stored import stored

#: Bytes of a text whose words are listed at once.
PIECE = 1 << 20
#: Filters on a text alone, and the one on copies, by the letters of an order.
TEXT_FILTERS, COPY_FILTER = "ABCD", "E"
FILTERS = TEXT_FILTERS + COPY_FILTER
FIELD = 64

_SPACE = b" \t\n\v\f\r"
_CAPITALS = bytes(range(65, 91))
_MARKS = b"#$%&*|"
_WITHIN = bytes(range(0x80, 0xC0))  # bytes that do not begin a code point


class Limits(NamedTuple):
    words: int = 50
    distinct_percent: int = 65
    capital_percent: int = 5


def count_words(data: bytes) -> tuple[int, int]:
    """Words between ASCII white space, and how many different ones."""
    if len(data) <= PIECE:
        words = data.split()
        return len(words), len(set(words))
    n, seen, at = 0, set(), 0
    while at < len(data):
        end = at + PIECE
        while end < len(data) and data[end] not in _SPACE:
            end += 1
        words = data[at:end].split()
        n += len(words)
        seen.update(words)
        at = end
    return n, len(seen)


def text_mask(data: bytes, limits: Limits) -> int:
    """Bits of the filters on a text alone that it fails."""
    words, different = count_words(data)
    capitals = len(data) - len(data.translate(None, _CAPITALS))
    points = len(data.translate(None, _WITHIN))
    failed = (
        words < limits.words,
        100 * different < limits.distinct_percent * words,
        100 * capitals > limits.capital_percent * points,
        len(data.translate(None, _MARKS)) < len(data),
    )
    return sum(1 << k for k, bad in enumerate(failed) if bad)


@lru_cache(maxsize=2)
def orders(filters: str) -> list[tuple[str, int]]:
    """(order, step) of each field."""
    return [("".join(o), step) for o in permutations(filters) for step in range(1, len(filters) + 1)]


@lru_cache(maxsize=2)
def outcomes(filters: str) -> list[tuple[int, int, int]]:
    """For each mask the wide integers of the fields at which a document is kept, removed, or
    fails a filter after it was removed."""
    bits = {f: 1 << k for k, f in enumerate(filters)}
    table = []
    for mask in range(1 << len(filters)):
        kept = removed = redundant = 0
        for at, (order, step) in enumerate(orders(filters)):
            one = 1 << (FIELD * at)
            gone = any(mask & bits[f] for f in order[: step - 1])
            fails = bool(mask & bits[order[step - 1]])
            kept += one * (not gone and not fails)
            removed += one * (fails and not gone)
            redundant += one * (fails and gone)
        table.append((kept, removed, redundant))
    return table


def unpack(wide: int, filters: str) -> np.ndarray:
    return np.frombuffer(wide.to_bytes(len(orders(filters)) * FIELD // 8, "little"), "<i8")


def tally(part: str, masks: list[tuple[int, int, int, int]], filters: str = FILTERS) -> dict[str, np.ndarray | list]:
    """All fields of one part from its (mask, rows, good rows, toxic rows)."""
    table = outcomes(filters)
    kept = removed = redundant = good = toxic = 0
    alone = dict.fromkeys(filters, 0)
    for mask, n, n_good, n_toxic in masks:
        kept += n * table[mask][0]
        removed += n * table[mask][1]
        redundant += n * table[mask][2]
        good += n_good * table[mask][1]
        toxic += n_toxic * table[mask][1]
        if mask.bit_count() == 1:
            alone[filters[mask.bit_length() - 1]] += n
    gone = unpack(removed, filters)
    letters = [order[step - 1] for order, step in orders(filters)]
    total = dict.fromkeys(filters, 0)
    for letter, n in zip(letters, gone.tolist()):
        total[letter] += n
    return {
        "part": [part] * len(letters),
        "filter_order": [order for order, _ in orders(filters)],
        "step": np.array([step for _, step in orders(filters)], np.int32),
        "kept": unpack(kept, filters),
        "removed": gone,
        "redundant": unpack(redundant, filters),
        "unique_fails": np.array([alone[f] for f in letters], np.int64),
        "good_lost": unpack(good, filters),
        "toxic_lost": unpack(toxic, filters),
        "shapley": np.array([total[f] for f in letters], np.int64),
    }


SCHEMA = (
    "part string, filter_order string, step int, kept bigint, removed bigint, redundant bigint, "
    "unique_fails bigint, good_lost bigint, toxic_lost bigint, shapley bigint"
)


def masks(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", part: str = "source", limits: Limits = Limits()
) -> DataFrame:
    """Documents by part and mask: (part, mask, n, n_good, n_toxic)."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, bounds = utf8(batch.column(2))
            bits, digests = [], []
            for low, high in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                data = values[low:high].tobytes()
                bits.append(text_mask(data, limits))
                digests.append(hashlib.sha256(data).digest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(bits, pa.int32()), pa.array(digests, pa.binary())],
                names=["id", "part", "mask", "digest"],
            )

    read = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.col(text))
    kind = read.schema["id"].dataType.simpleString()
    facts = stored(read.mapInArrow(measure, f"id {kind}, part string, mask int, digest binary"), "masks")
    first = facts.groupBy(F.col("digest").alias("_digest")).agg(F.min("id").alias("_first"), F.lit(True).alias("_is_first"))
    good = F.coalesce(F.max(F.col("quality") == 1), F.lit(False))
    toxic = F.coalesce(F.max(F.col("toxic") == 1), F.lit(False))
    marks = labels.groupBy(F.col(id_column).alias("_id")).agg(good.alias("_good"), toxic.alias("_toxic"))
    copy = F.when(F.col("_is_first").isNull(), 1 << FILTERS.index(COPY_FILTER)).otherwise(0)
    seen = (
        facts.join(first, (F.col("digest") == F.col("_digest")) & F.col("id").eqNullSafe(F.col("_first")), "left")
        .select("id", "part", (F.col("mask") + copy).alias("mask"))
        .join(marks, F.col("id") == F.col("_id"), "left")
    )
    return seen.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("_good").alias("n_good"), F.count_if("_toxic").alias("n_toxic")
    )


def interactions(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", part: str = "source", limits: Limits = Limits()
) -> DataFrame:
    """One row per part, order of the filters and step, zeros included."""

    def sum_up(key: tuple, table: pa.Table) -> pa.Table:
        rows = [table.column(c).to_pylist() for c in ("mask", "n", "n_good", "n_toxic")]
        return pa.table(tally(key[0].as_py(), list(zip(*rows))))

    return masks(docs, labels, id_column, text, part, limits).groupBy("part").applyInArrow(sum_up, SCHEMA)
