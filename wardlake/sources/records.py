"""Delimited files whose quoted values hold line breaks, parsed by many tasks within one file.

Whether a line of such a file begins a record depends on all quotes before it. So the files are
read as lines, split inside files as Spark splits any text, in two passes. A line, started
outside or inside of a quoted value, ends outside or inside: two flags, which expressions take
from it alone. The first pass folds the flags of each block of a file into those of the block, and a
prefix combination over the blocks tells where each of them truly starts. With that the second
pass joins the lines of every block to records. A record that crosses the end of a block comes as pieces
from its blocks; only these are shuffled. Records are parsed by Spark's own delimited parser.

Where Spark splits a file depends on the bytes of all files of a read and on the cores at hand. So
both passes read the same files, and the second one, which is stored, also tells its blocks: where
they are not those of the first, because machines came or went meanwhile, both are read again.

The driver holds one row per block, as it does for the splits of any scan. A file is read twice.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wardlake.sources.storage import publish

QUOTE = '"'


class Block(NamedTuple):
    """A block of a file: where it ends by where it starts, and whether a record ends in it if it starts inside one."""

    path: str
    start: int
    from_outside: bool
    from_inside: bool
    closes: bool


#: Encodings whose line breaks, quotes and separators are single bytes, with Spark's names.
CHARSETS = {"utf-8": "UTF-8", "iso8859-1": "ISO-8859-1", "ascii": "US-ASCII"}


def charset(encoding: str) -> str | None:
    """Spark's name of an encoding in which a file can be split at line breaks."""
    try:
        return CHARSETS.get(codecs.lookup(encoding).name)
    except LookupError:
        return None


def _ends_inside(line: Column, sep: str) -> tuple[Column, Column]:
    """Whether a line ends within a quoted value, if it starts outside or inside of one.

    A quoted value starts right behind a separator. A quote that is neither doubled nor before a
    separator ends it, and the rest up to the separator is read as it stands.
    """
    d = re.escape(sep)
    body = r'[^"]*+(?:""[^"]*+)*+'
    whole = rf'(?:(?:"{body}"[^{d}]*+|[^"{d}][^{d}]*+|){d})*+'
    opened = rf'{whole}"{body}\z'
    quoted = line.contains(QUOTE)
    outside = quoted & line.rlike(rf"\A{opened}")
    inside = ~quoted | line.rlike(rf'\A{body}(?:\z|"[^{d}]*+{d}{opened})')
    return outside, inside


def _lines(spark: SparkSession, paths: Sequence[str], sep: str, encoding: str) -> DataFrame:
    raw = spark.read.text(list(paths), lineSep="\n")
    text = F.col("value") if charset(encoding) == "UTF-8" else F.decode(F.col("value").cast("binary"), charset(encoding))
    lines = raw.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), text.alias("line"))
    outside, inside = _ends_inside(F.col("line"), sep)
    return lines.select("path", "start", outside.alias("outside"), inside.alias("inside"), "line")


def _states(outside: np.ndarray, inside: np.ndarray, begin: bool) -> np.ndarray:
    """Whether each line ends within a quoted value, for a run of lines that starts so or not."""
    places = np.arange(len(outside))
    fixed = np.where(outside == inside, places, -1)
    last = np.maximum.accumulate(fixed)  # the line before that ends alike from both
    turns = np.cumsum(outside & ~inside)
    at = np.maximum(last, 0)
    known = np.where(last >= 0, outside[at], begin)
    return known ^ ((turns - np.where(last >= 0, turns[at], 0)) % 2 == 1)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[str, int, int, int]]:
    """(path, start, low, high) of the lines of one block within a batch."""
    if not len(batch):
        return
    path, start = batch.column(0), batch.column(1).to_numpy()
    new = np.ones(len(batch), bool)
    new[1:] = (start[1:] != start[:-1]) | pc.not_equal(path.slice(1), path.slice(0, len(batch) - 1)).to_numpy(zero_copy_only=False)
    cuts = [*np.flatnonzero(new).tolist(), len(batch)]
    for low, high in zip(cuts[:-1], cuts[1:]):
        yield path[low].as_py(), int(start[low]), low, high


def _flags(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return batch.column(2).to_numpy(zero_copy_only=False), batch.column(3).to_numpy(zero_copy_only=False)


def _fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block of the lines' flags."""
    key, state = None, (False, True, False)

    def row() -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist([dict(zip(Block._fields, (*key, *state)))])

    for batch in batches:
        outside, inside = _flags(batch)
        for path, start, low, high in _runs(batch):
            if (path, start) != key:
                if key is not None:
                    yield row()
                key, state = (path, start), (False, True, False)
            from_outside = _states(outside[low:high], inside[low:high], state[0])
            from_inside = _states(outside[low:high], inside[low:high], state[1])
            state = (bool(from_outside[-1]), bool(from_inside[-1]), state[2] or not from_inside.all())
    if key is not None:
        yield row()


class Crossing(NamedTuple):
    """Blocks that start or end inside a record, and the block where that record started."""

    starts_inside: dict[tuple[str, int], int]
    ends_inside: set[tuple[str, int]]


def combine(blocks: Sequence[Block]) -> Crossing:
    """The true state at the start of each block, from the first block of its file on."""
    starts, ends = {}, set()
    path, inside, owner = None, False, 0
    for block in sorted(blocks):
        if block.path != path:
            path, inside = block.path, False
        begins_inside = inside
        if begins_inside:
            starts[block.path, block.start] = owner
        inside = block.from_inside if begins_inside else block.from_outside
        if inside:
            ends.add((block.path, block.start))
            if not begins_inside or block.closes:
                owner = block.start
    return Crossing(starts, ends)


def _joined(lines: pa.Array, starts: np.ndarray) -> pa.Array:
    """The lines from each start to the next one, with their line breaks."""
    if len(starts) == len(lines):
        return lines
    bounds = pa.array([*starts.tolist(), len(lines)], pa.int32())
    return pc.binary_join(pa.ListArray.from_arrays(bounds, lines), "\n")


def _assembler(crossing: Crossing) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Whole records of the blocks, without each file's first one, and the pieces of records that cross their ends.

    Rows are (kind, path, start, row, record); ``start`` is that of the block where the record started and
    ``row`` its place there, or the piece's block. A row of its own names each block.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, inside, rows, held, head = None, False, 0, [], False

        def made(start: int, records: pa.Array, first: int, kind: str = RECORD) -> Iterator[pa.RecordBatch]:
            n = len(records)
            places = np.arange(first, first + n)
            if kind == RECORD and start == 0 and first == 0 and n:  # the header
                records, places, n = records.slice(1), places[1:], n - 1
            if n:
                columns = [pa.repeat(pa.scalar(kind), n), pa.repeat(pa.scalar(key[0]), n), pa.array(np.full(n, start)), pa.array(places), records]
                yield pa.RecordBatch.from_arrays(columns, names=["kind", "path", "start", "row", "record"])

        def flush(last: bool) -> Iterator[pa.RecordBatch]:
            """The record held at the end of a block, or when the next one starts."""
            nonlocal held, rows, head
            if held:
                whole = pa.array(["\n".join(held)], pa.string())
                if head:
                    yield from made(crossing.starts_inside[key], whole, key[1], PIECE)
                elif last and key in crossing.ends_inside:
                    if key[1] == 0 and rows == 0:
                        raise ValueError(f"the header of {key[0]} does not end within the first block")
                    yield from made(key[1], whole, key[1], PIECE)
                else:
                    yield from made(key[1], whole, rows)
                    rows += 1
            held, head = [], False

        for batch in batches:
            outside, inner = _flags(batch)
            for path, start, low, high in _runs(batch):
                if (path, start) != key:
                    yield from flush(True)
                    key, rows = (path, start), 0
                    inside = head = key in crossing.starts_inside
                    yield from made(start, pa.array([""]), start, BLOCK)
                after = _states(outside[low:high], inner[low:high], inside)
                begins = np.flatnonzero(~np.concatenate([[inside], after[:-1]]))
                lines = batch.column(4).slice(low, high - low)
                inside = bool(after[-1])
                if not len(begins):
                    held += lines.to_pylist()
                    continue
                held += lines.slice(0, int(begins[0])).to_pylist()
                yield from flush(False)
                done = _joined(lines.slice(int(begins[0]), int(begins[-1] - begins[0])), begins[:-1] - begins[0])
                if len(begins) > 1:
                    yield from made(start, done, rows)
                    rows += len(begins) - 1
                held = lines.slice(int(begins[-1])).to_pylist()
        yield from flush(True)

    return run


RECORD, PIECE, BLOCK = "record", "piece", "block"
_RECORDS = "kind string, path string, start bigint, row bigint, record string"
#: How often files are read again when the blocks change between the passes.
ATTEMPTS = 5


def _assembled(spark: SparkSession, paths: Sequence[str], sep: str, encoding: str) -> DataFrame:
    """Records and pieces, stored, from two passes that saw the same blocks."""
    kinds = "path string, start bigint, from_outside boolean, from_inside boolean, closes boolean"
    for _ in range(ATTEMPTS):
        flags = _lines(spark, paths, sep, encoding).select("path", "start", "outside", "inside")
        blocks = [Block(*row) for row in flags.mapInArrow(_fold, kinds).collect()]
        lines = _lines(spark, paths, sep, encoding)
        stored = publish(lines.mapInArrow(_assembler(combine(blocks)), _RECORDS), "records").frame
        seen = stored.where(F.col("kind") == BLOCK).select("path", "start").collect()
        if sorted(map(tuple, seen)) == sorted(block[:2] for block in blocks):
            return stored
    raise RuntimeError(f"the blocks of the files changed in each of {ATTEMPTS} readings")


def read_records(spark: SparkSession, paths: Sequence[str], columns: Sequence[str], sep: str, encoding: str) -> DataFrame:
    """The named columns of all records but each file's first, and ``_place``: where the record
    starts (path, block, row)."""
    stored = _assembled(spark, paths, sep, encoding)
    records = stored.where(F.col("kind") == RECORD).select("path", "start", "row", "record")
    ordered = F.array_sort(F.array_agg(F.struct("row", "record")))
    whole = F.array_join(F.transform(ordered, lambda p: p["record"]), "\n")
    last = F.lit((1 << 63) - 1).alias("row")  # nothing starts behind it in its block
    crossed = stored.where(F.col("kind") == PIECE).groupBy("path", "start").agg(whole.alias("record"))
    records = records.unionByName(crossed.select("path", "start", last, "record"))
    text = F.regexp_replace("record", r"\r\z", "")
    fields = ", ".join(f"c{k} STRING" for k in range(len(columns)))
    options = {"sep": sep, "quote": QUOTE, "escape": QUOTE, "multiLine": "true", "header": "false"}
    parsed = (
        records.select(F.struct(F.col("path").alias("file"), "start", "row").alias("_place"), text.alias("_text"))
        .where("_text <> ''")
        .select("_place", F.from_csv("_text", fields, options).alias("_row"))
    )
    return parsed.select(*[F.col(f"_row.c{k}").alias(name) for k, name in enumerate(columns)], "_place")
