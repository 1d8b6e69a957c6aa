"""Suffix-array dedup: bytes covered by a string of ``length`` bytes that starts twice or more.

Sorting every suffix to a depth of ``length`` would exchange ``length`` times the corpus, so the
suffixes sorted are those at anchors. The anchor of a string is the place of its gram of
``length // 2`` bytes with the least hash (the first of equals): equal strings have it at the same
place, so they meet below one anchor gram. The starts that share an anchor form a block; its record
is the suffix at the anchor, as far as its strings reach, followed by what lies before it, reversed.

1. Spark counts the anchor grams. Those that occur twice are marked in a bitmap of fixed size
   (``2**FILTER_BITS`` bits, broadcast); a false mark costs work, not truth.
2. Each task sorts the records with a marked gram into runs (equal records once, with a mark) and
   writes them front-coded: only what differs from the record before.
3. A sample of keys cuts the order into parts. Runs are cut there and exchanged, still front-coded.
   Each part is merged by a loser tree that knows every candidate's common prefix with the last
   record and compares only beyond it; the front coding supplies these prefixes.
4. Neighbours with the gram in common form a group. A record met twice is repeated as a whole. In
   groups of several records, the strings of all are compared. The groups at the ends of a part
   may go on in other parts (a passage in a third of all documents fills many): their strings are
   compared by a shuffle on digests instead.
5. The repeated strings go back to their blocks by a join on the digest of the record, and to the
   documents as spans.

Defined results: null and empty texts have no bytes; texts shorter than ``length`` keep all; a row
repeated with equal text loses what other rows with that text lose, since each is the other's
copy; other columns are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from bisect import bisect_right
from collections.abc import Iterator
from hashlib import blake2b
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.arrays import Rolling, mix, slices
from wardlake.llm.bitmaps import is_marked, marked_bits
from wardlake.llm.stored import drop_stored, stored

LENGTH = 200
FILTER_BITS = 28
#: Bytes of records that a task sorts at a time, and that a part aims at.
RUN_BYTES = 24 << 20
PART_BYTES = 6 << 20
MOST_PARTS = 100_000
#: Records in a row of a run.
ROW_RECORDS = 256
#: Rows sampled for each part boundary.
SAMPLES = 8

_U64 = np.uint64
#: The low bits of a marked gram, for its place: as many as the longest string of Spark needs.
_PLACE = _U64((1 << 31) - 1)


class Blocks(NamedTuple):
    """Blocks of a slice: first and last start, anchor, hash of the anchor gram."""

    low: np.ndarray
    high: np.ndarray
    anchor: np.ndarray
    gram: np.ndarray


def blocks_of(data: np.ndarray, bounds: np.ndarray, length: int, rolling: Rolling) -> Blocks:
    size = length // 2
    reach = length - size + 1
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return Blocks(none, none, none, none.view(_U64))
    at = np.arange(len(data) - size + 1)
    grams = rolling(at, at + size)
    marked = (grams & ~_PLACE) | at.astype(_U64)  # least by hash, then by place
    padded = np.concatenate([marked, np.full(-len(marked) % reach, np.iinfo(_U64).max)]).reshape(-1, reach)
    before = np.minimum.accumulate(padded, axis=1).ravel()
    after = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(marked) - reach + 1
    anchor = (np.minimum(after[:n], before[reach - 1 : reach - 1 + n]) & _PLACE).astype(np.int64)
    start = np.arange(n)
    row = np.searchsorted(bounds, start, side="right") - 1
    inside = start + length <= bounds[row + 1]
    change = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1])
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= change | ~inside[:-1]
    closes[:-1] &= change | ~inside[1:]
    low = np.flatnonzero(opens)
    return Blocks(low, np.flatnonzero(closes), anchor[low], grams[anchor[low]])


# ---- 1. grams that occur twice ---------------------------------------------------------------


def repeated_grams(texts: DataFrame, length: int, bits: int = FILTER_BITS) -> np.ndarray:
    """The bitmap of anchor grams that stand in the texts twice or more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, data, bounds in slices(batch):
                grams, n = np.unique(blocks_of(data, bounds, length, Rolling(data)).gram, return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(grams.view(np.int64)), pa.array(n.astype(np.int32))], names=["gram", "n"])

    counts = texts.select("text").mapInArrow(count, "gram bigint, n int").groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1")
    return marked_bits(counts.select("gram"), bits)


# ---- 2. sorted, front-coded runs ---------------------------------------------------------------


class Record(NamedTuple):
    """A block's strings: the suffix at the anchor and what lies before it, reversed."""

    key: bytes
    right: int  # length of the suffix
    many: bool  # met twice or more

    def digest(self) -> bytes:
        return blake2b(self.key, digest_size=16, salt=self.right.to_bytes(4, "big")).digest()

    def context(self) -> bytes:
        return self.key[: self.right - 1 : -1] + self.key[: self.right] if self.right < len(self.key) else self.key


def common(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, from a known part of it on."""
    end = min(len(a), len(b))
    at = known
    while at < end and a[at : at + 32] == b[at : at + 32]:
        at += 32
    if at >= end:
        return end
    x, y = a[at : min(at + 32, end)], b[at : min(at + 32, end)]
    differ = int.from_bytes(x, "big") ^ int.from_bytes(y, "big")
    return at + len(x) - (differ.bit_length() + 7) // 8


def coded(records: list[Record]) -> bytes:
    """Front coding: for each record the prefix shared with the one before, and the rest."""
    shared, last = [], b""
    for r in records:
        shared.append(common(last, r.key, 0))
        last = r.key
    numbers = np.array([shared, [len(r.key) - s for r, s in zip(records, shared)], [r.right for r in records], [r.many for r in records]], np.uint32)
    rest = b"".join(r.key[s:] for r, s in zip(records, shared))
    return zstandard.compress(len(records).to_bytes(4, "big") + numbers.tobytes() + rest, 1)


def decoded(blob: bytes) -> Iterator[tuple[int, Record]]:
    """Records and the prefix that each shares with the one before it."""
    raw = zstandard.decompress(blob)
    n = int.from_bytes(raw[:4], "big")
    shared, rest, right, many = np.frombuffer(raw, np.uint32, 4 * n, 4).reshape(4, n).tolist()
    at, last = 4 + 16 * n, b""
    for s, r, w, m in zip(shared, rest, right, many):
        last = last[:s] + raw[at : at + r]
        at += r
        yield s, Record(last, w, bool(m))


_RUN_SCHEMA = "doc_id {id}, text_hash bigint, low bigint, cls binary, run string, at int, key binary, size int, blob binary"


def runs(docs: DataFrame, length: int, bitmap) -> DataFrame:
    """Two kinds of rows: blocks (doc_id, text_hash, low, cls), and rows of sorted runs
    (run, at, key, size, blob), ``key`` being the first of the row's records."""
    names = ["doc_id", "text_hash", "low", "cls", "run", "at", "key", "size", "blob"]
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def flush(held: dict[int, list]) -> Iterator[pa.RecordBatch]:
        run = uuid.uuid4().hex
        records = sorted(Record(key, right, many) for key, right, many, _ in held.values())
        held.clear()
        for low in range(0, len(records), ROW_RECORDS):
            part = records[low : low + ROW_RECORDS]
            size = sum(len(r.key) for r in part)
            values = {"run": [run], "at": pa.array([low // ROW_RECORDS], pa.int32()), "key": [part[0].key], "size": pa.array([size], pa.int32()), "blob": [coded(part)]}
            yield filled(values, 1)

    def filled(values: dict, n: int) -> pa.RecordBatch:
        kinds = {"doc_id": id_arrow[0], "text_hash": pa.int64(), "low": pa.int64(), "cls": pa.binary(), "run": pa.string(), "at": pa.int32(), "key": pa.binary(), "size": pa.int32(), "blob": pa.binary()}
        arrays = [values[c] if isinstance(values.get(c), pa.Array) else pa.array(values[c], kinds[c]) if c in values else pa.nulls(n, kinds[c]) for c in names]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    id_arrow: list = [pa.int64()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = bitmap.value
        held: dict[int, list] = {}  # key, right, many, digest by hash of the record
        size = 0
        for batch in batches:
            id_arrow[0] = batch.schema.field(0).type
            for part, data, bounds in slices(batch):
                rolling = Rolling(data)
                found = blocks_of(data, bounds, length, rolling)
                chosen = np.flatnonzero(is_marked(marks, found.gram))
                if not len(chosen):
                    continue
                low, high, anchor = found.low[chosen], found.high[chosen], found.anchor[chosen]
                # by halves, which are short enough for sums to tell them apart
                middle, end = (low + high + length) // 2, high + length
                hashes = mix(rolling(low, middle) + (anchor - low).astype(_U64) * _U64(0x9E3779B97F4A7C15))
                hashes = mix(hashes + rolling(middle, end) + (end - low).astype(_U64))
                values, first, back, n = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
                raw = data.tobytes()
                digests = []
                for value, k, times in zip(values.tolist(), first.tolist(), n.tolist()):
                    mine = held.get(value)
                    if mine is None:
                        a, b, c = int(low[k]), int(anchor[k]), int(high[k]) + length
                        key = raw[b:c] + raw[a:b][::-1]
                        mine = held[value] = [key, c - b, times > 1, Record(key, c - b, False).digest()]
                        size += len(key) + 200
                    else:
                        mine[2] = True
                    digests.append(mine[3])
                all_digests = np.frombuffer(b"".join(digests), "V16")[back]
                offsets = pa.array(np.arange(0, 16 * len(back) + 1, 16, dtype=np.int32)).buffers()[1]
                cls = pa.Array.from_buffers(pa.binary(), len(back), [None, offsets, pa.py_buffer(all_digests.tobytes())])
                row = np.searchsorted(bounds, low, side="right") - 1
                of = pa.array(row)
                yield filled({"doc_id": part.column(0).take(of), "text_hash": part.column(2).take(of), "low": pa.array(low - bounds[row]), "cls": cls}, len(row))
                if size > RUN_BYTES:
                    yield from flush(held)
                    size = 0
        yield from flush(held)

    return docs.mapInArrow(run, _RUN_SCHEMA.format(id=id_type))


# ---- 3. exchange and merge ---------------------------------------------------------------------


def cut(pieces: DataFrame, splitters) -> DataFrame:
    """Rows of runs cut where the parts begin: (part, run, at, blob)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = splitters.value
        for batch in batches:
            for name, at, blob in zip(*(batch.column(k).to_pylist() for k in range(3))):
                mine: dict[int, list[Record]] = {}
                for _, record in decoded(blob):
                    mine.setdefault(bisect_right(marks, record.key), []).append(record)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(mine), pa.int32()), pa.array([name] * len(mine)), pa.array([at] * len(mine), pa.int32()), pa.array(list(map(coded, mine.values())), pa.binary())],
                    names=["part", "run", "at", "blob"],
                )

    return pieces.select("run", "at", "blob").mapInArrow(run, "part int, run string, at int, blob binary")


def merged(streams: list[Iterator[tuple[int, Record]]]) -> Iterator[tuple[int, Record]]:
    """Records of all streams in order, each with the prefix it shares with the one before.

    A loser tree: a node holds the stream that lost there and the prefix its record shares with
    the winner that went up. On its way up, a new record meets losers whose shared prefixes refer to
    the same record, the last one out. The longer prefix is the smaller record, without a look at
    any byte; equal prefixes are compared from there on.
    """
    k = 1
    while k < len(streams):
        k *= 2
    heads: list[Record | None] = [None] * k
    prefix = [0] * k
    for s, stream in enumerate(streams):
        prefix[s], heads[s] = next(stream, (0, None))
        prefix[s] = 0
    losers = [0] * k

    def play(a: int, b: int) -> tuple[int, int]:
        """(winner, loser); the loser's prefix is then that with the winner."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if prefix[a] != prefix[b]:
            return (a, b) if prefix[a] > prefix[b] else (b, a)
        shared = common(x.key, y.key, prefix[a])
        first = x.key[shared : shared + 1], x.right
        second = y.key[shared : shared + 1], y.right
        winner, loser = (a, b) if first <= second else (b, a)
        prefix[loser] = shared
        return winner, loser

    winners = list(range(k))
    nodes = k
    while nodes > 1:  # from the leaves up
        nodes //= 2
        winners = [play(winners[2 * i], winners[2 * i + 1]) for i in range(nodes)]
        for i, (_, loser) in enumerate(winners):
            losers[nodes + i] = loser
        winners = [w for w, _ in winners]
    best = winners[0]
    while heads[best] is not None:
        yield prefix[best], heads[best]
        if best < len(streams):
            prefix[best], heads[best] = next(streams[best], (0, None))
        node = (best + k) // 2
        while node >= 1:
            best, losers[node] = play(best, losers[node])
            node //= 2


def merge_part(rows: list[tuple[str, int, bytes]]) -> Iterator[tuple[int, Record]]:
    """The records of one part: streams are the rows of a run, in their order."""
    by_run: dict[str, list[tuple[int, bytes]]] = {}
    for run, at, blob in rows:
        by_run.setdefault(run, []).append((at, blob))

    def stream(blobs: list[bytes]) -> Iterator[tuple[int, Record]]:
        last = b""
        for blob in blobs:
            for k, (shared, record) in enumerate(decoded(blob)):
                yield common(last, record.key, 0) if k == 0 else shared, record
                last = record.key

    return merged([stream([b for _, b in sorted(blobs)]) for blobs in by_run.values()])


# ---- 4. repeated strings of a group -------------------------------------------------------------


def spans_in(flags: np.ndarray) -> list[tuple[int, int]]:
    """First and last places of the runs of set flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [(int(a), int(b) - 1) for a, b in zip(edges[::2], edges[1::2])]


def compared(groups: list[list[Record]], length: int) -> Iterator[tuple[Record, list[tuple[int, int]]]]:
    """For every record of the groups, which of its strings another place in its group has."""
    flat = [r for g in groups for r in g]
    if not flat:
        return
    data = np.frombuffer(b"".join(r.context() for r in flat), np.uint8)
    sizes = np.array([len(r.key) for r in flat])
    ends = np.cumsum(sizes)
    n = sizes - length + 1
    of = np.repeat(np.arange(len(flat)), n)
    first = np.cumsum(n) - n
    start = np.arange(n.sum()) - first[of] + (ends - sizes)[of]
    group = np.repeat(np.arange(len(groups)), [len(g) for g in groups])[of]
    key = mix(Rolling(data)(start, start + length) + group.astype(_U64) * _U64(0x9E3779B97F4A7C15))
    _, back, times = np.unique(key, return_inverse=True, return_counts=True)
    again = (times > 1)[back]
    for k, record in enumerate(flat):
        if record.many:
            yield record, [(0, int(n[k]) - 1)]
        else:
            spans = spans_in(again[first[k] : first[k] + n[k]])
            if spans:
                yield record, spans


def settle(records: Iterator[tuple[int, Record]], length: int) -> Iterator[tuple[bytes, int, int, bytes | None]]:
    """(cls, first, last, None) for repeated strings of the records, and (cls, place, place, digest of
    the string) for those that records of other parts may have, too."""
    size = length // 2
    held: list[list[Record]] = []
    weight = 0

    def open_ends(group: list[Record]) -> Iterator[tuple[bytes, int, int, bytes | None]]:
        for record in group:
            cls, text = record.digest(), record.context()
            n = len(text) - length + 1
            if record.many:
                yield cls, 0, n - 1, None
            for k in range(n):
                yield cls, k, k, blake2b(text[k : k + length], digest_size=16).digest()

    def emptied() -> Iterator[tuple[bytes, int, int, bytes | None]]:
        nonlocal weight
        for record, spans in compared(held, length):
            cls = record.digest()
            for a, b in spans:
                yield cls, a, b, None
        held.clear()
        weight = 0

    group: list[Record] = []
    is_first = True
    for shared, record in records:
        if group and shared >= size:
            last = group[-1]
            if last.key == record.key and last.right == record.right:
                group[-1] = last._replace(many=True)
                continue
            if is_first and len(group) >= 1024:  # a long open end needs no memory
                yield from open_ends(group[:-1])
                group = group[-1:]
            group.append(record)
            continue
        if group:
            if is_first:
                yield from open_ends(group)
                is_first = False
            else:
                held.append(group)
                weight += len(group)
                if weight >= 4096:
                    yield from emptied()
        group = [record]
    if group:
        yield from open_ends(group)
    yield from emptied()


def repeated_strings(pieces: DataFrame, length: int) -> DataFrame:
    """(cls, first, last): places of strings in records that stand elsewhere, too."""
    spark = pieces.sparkSession
    total, rows = pieces.agg(F.sum("size"), F.count("*")).first()
    n_parts = min(MOST_PARTS, max(1, (total or 0) // PART_BYTES))
    share = min(1.0, SAMPLES * n_parts / max(rows, 1))
    marks = pieces if share == 1 else pieces.where(F.pmod(F.xxhash64("key"), F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
    # SAMPLES keys of at most 1.5 * length bytes for each part
    keys = sorted(bytes(r.key) for r in marks.select("key").collect())
    splitters = sorted({keys[len(keys) * k // n_parts] for k in range(1, n_parts)}) if keys else []
    shared = spark.sparkContext.broadcast(splitters)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        names = ["cls", "first", "last", "string"]
        rows = list(zip(*(table.column(c).to_pylist() for c in ("run", "at", "blob"))))
        columns = list(zip(*settle(merge_part(rows), length))) or [[], [], [], []]
        kinds = (pa.binary(), pa.int32(), pa.int32(), pa.binary())
        return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

    out = stored(cut(pieces, shared).groupBy("part").applyInArrow(run, "cls binary, first int, last int, string binary"), "repeats")
    settled = out.where("string is null").select("cls", "first", "last")
    open_ = out.where("string is not null")
    several = open_.groupBy("string").agg(F.count("*").alias("n")).where("n > 1").select("string")
    return settled.union(open_.join(several.hint("shuffle_hash"), "string", "left_semi").select("cls", "first", "last"))


# ---- 5. back to the documents -------------------------------------------------------------------


def kept_bytes(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, list[tuple[int, int]]]:
    """What is left of the text, and its maximal removed runs."""
    runs_: list[list[int]] = []
    for a, b in spans:
        if runs_ and a <= runs_[-1][1]:
            runs_[-1][1] = max(runs_[-1][1], b)
        else:
            runs_.append([a, b])
    left, at = [], 0
    for a, b in runs_:
        left.append(text[at:a])
        at = b
    left.append(text[at:])
    return b"".join(left), [(a, b) for a, b in runs_]


def without_repeats(df: DataFrame, length: int = LENGTH, filter_bits: int = FILTER_BITS) -> DataFrame:
    """(doc_id, n_bytes, kept, spans) for every row of (doc_id, text); spans are (start, end) in bytes."""
    spark = df.sparkSession
    docs = df.select("doc_id", "text", F.xxhash64("text").alias("text_hash"))
    bitmap = spark.sparkContext.broadcast(repeated_grams(docs, length, filter_bits))
    table = stored(runs(docs, length, bitmap), "runs")
    repeats = repeated_strings(table.where("run is not null"), length)
    blocks = table.where("cls is not null").select("doc_id", "text_hash", "low", "cls")
    span = F.struct((F.col("low") + F.col("first")).alias("start"), (F.col("low") + F.col("last") + length).alias("end"))
    found = blocks.join(repeats, "cls").groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_list(span)).alias("spans"))
    found = stored(found, "spans")
    drop_stored(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        for batch in batches:
            for part, data, bounds in slices(batch):
                raw = data.tobytes()
                made = []
                for a, b, spans in zip(bounds[:-1].tolist(), bounds[1:].tolist(), part.column(2).to_pylist()):
                    made.append(kept_bytes(raw[a:b], [(s["start"], s["end"]) for s in spans or ()]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(np.diff(bounds)), pa.array([k for k, _ in made], pa.binary()), pa.array([[{"start": a, "end": b} for a, b in s] for _, s in made], kind)],
                    names=["doc_id", "n_bytes", "kept", "spans"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    right = found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "spans").hint("shuffle_hash")
    joined = docs.join(right, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("text_hash") == F.col("_hash")), "left")
    return joined.select("doc_id", "text", "spans").mapInArrow(
        run, f"doc_id {id_type}, n_bytes bigint, kept binary, spans array<struct<start:bigint,end:bigint>>"
    )
