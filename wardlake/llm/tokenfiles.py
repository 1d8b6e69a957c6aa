"""Token ids as ORC files in the order of the documents, and reading them back.

Documents are sorted by id, encoded where they are sorted, and written in that order. A row holds
up to ``PIECE`` ids of one document, with the document's id, its place and its number of ids, so
a row has a bounded size however long the text is. ORC writes the integers by run length, in stripes that
tasks read independently of each other; the row index and a Bloom filter on the document id let a reader that
asks for some documents skip stripes and row groups. Beside the ids lies a table of parts, a row for each
written partition, with its first and last document and the ids before it.

A text is cut where a byte-level tokenizer with the usual pattern always begins a new pre-token: before white
space behind other characters, around a single line break, between a letter or digit and a mark of ASCII. So the ids of a
text are those of its pieces, and a piece is encoded by the tokenizers library once and then remembered. Pieces are
found, counted as one and given their ids by arrays; only distinct pieces of some megabytes of text become strings.

Defined results: a null or empty text has the end id only. Null ids come first, rows of equal id in the order of their texts'
hashes; equal rows stand there as often as in the table. Markup of special tokens within a text is ordinary text. An empty
table gives files without rows. Other columns are dropped, whatever their names.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Ids of a row.
PIECE = 2048
#: Pieces of texts remembered in a worker; when they are more, those met once only are forgotten.
MEMORY = 600_000
#: Longer pieces are not remembered.
MEMORY_LETTERS = 64
#: Bytes of text that are encoded together, and rows of an output batch.
CHUNK = 4 << 20
ROWS = 1024

#: Pieces that are encoded as one text.
LINES = 200

# Kinds of bytes. No text is cut beside characters of the kind UNSURE, which some count as white space.
OTHER, WORD, MARK, SPACE, BREAK, UNSURE, LOOK = range(7)
_KINDS = np.zeros(256, np.uint8)
_KINDS[[*b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]] = MARK
_KINDS[[*b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"]] = WORD
_KINDS[[*b"\t\n\v\f\r"]] = BREAK
_KINDS[[*b" "]] = SPACE
_KINDS[[*b"\x1c\x1d\x1e\x1f"]] = UNSURE
_KINDS[[0xC2, 0xC3, 0xE1, 0xE2, 0xE3, 0xEF]] = LOOK
_UNSURE = [0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x2010), *range(0x2028, 0x2030), *range(0x205F, 0x2065), 0x3000, 0xFEFF]


def _kinds(data: np.ndarray) -> np.ndarray:
    """The kind of the character that each byte of UTF-8 is part of; letters beyond U+00FF are OTHER."""
    behind = np.concatenate([data, np.zeros(2, np.uint8)])
    kinds = _KINDS[behind]
    at = np.flatnonzero(kinds == LOOK)
    if len(at):
        first, second, third = (behind[at + k].astype(np.int32) for k in range(3))
        wide = first >= 0xE0
        codes = np.where(wide, (first & 15) << 12 | (second & 63) << 6 | third & 63, (first & 31) << 6 | second & 63)
        unsure = np.isin(codes, _UNSURE)
        letter = (first == 0xC3) & (codes != 0xD7) & (codes != 0xF7)
        kinds[at] = np.where(unsure, UNSURE, np.where(letter, WORD, OTHER))
        kinds[at[letter] + 1] = WORD
        kinds[at[unsure] + 1] = UNSURE
        kinds[at[unsure & wide] + 2] = UNSURE
    return kinds[: len(data)]


def cuts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where pieces begin in the bytes of texts that stand behind each other, with the end of the bytes.

    Between characters that are none, white space is a pre-token except its last character, which is one
    of its own or, if a space, begins the next.
    """
    kinds = np.append(_kinds(data), np.uint8(UNSURE))
    begins = np.zeros(len(data) + 1, bool)
    begins[bounds] = True
    out = begins.copy()

    white = (kinds == SPACE) | (kinds == BREAK)
    at = np.flatnonzero(white)
    before, inner = kinds[at - 1], ~begins[at]
    last = (kinds[at + 1] <= MARK) & ~begins[at + 1]
    behind_white, behind_other = inner & ((before == SPACE) | (before == BREAK)), inner & (before <= MARK)
    out[at[behind_other | behind_white & last]] = True
    out[at[(kinds[at] == BREAK) & last & (behind_other | behind_white | ~inner)] + 1] = True

    at = np.flatnonzero(kinds == MARK)
    out[at[(kinds[at - 1] == WORD) & ~begins[at]]] = True
    return np.flatnonzero(out)


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places from each start on, as many as its size."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(sizes.sum())


class Encoder:
    """The library's ids of whole texts."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on every core already
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        (self.line_break,) = self.tokenizer.encode("\n", add_special_tokens=False).ids
        #: Pieces by number; the ids of piece k stand from ``low[k]`` to ``low[k + 1]``; ``met`` if met again since forgetting.
        self.known: dict[str, int] = {}
        self.ids, self.low, self.met = np.empty(0, np.int32), np.zeros(1, np.int64), np.zeros(0, bool)

    def forget(self) -> None:
        """Keep the pieces met again, or none if that is more than half of the memory."""
        kept = np.flatnonzero(self.met)
        if len(kept) > MEMORY // 2:
            kept = kept[:0]
        words = list(self.known)  # in the order of their numbers
        self.known = {words[k]: n for n, k in enumerate(kept.tolist())}
        sizes = np.diff(self.low)[kept]
        self.ids = self.ids[_ranges(self.low[kept], sizes)]
        self.low, self.met = np.concatenate([[0], np.cumsum(sizes)]), np.zeros(len(kept), bool)

    def encode(self, pieces: list[str]) -> list[list[int]]:
        return [m.ids for m in self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)]

    def texts(self, texts: list[str]) -> list[bytes]:
        """Ids of every text, as bytes of little-endian 32-bit integers."""
        counts, ids = self.arrays(pa.array(texts, pa.string()))
        return [part.astype("<u4").tobytes() for part in np.split(ids, np.cumsum(counts)[:-1])]

    def arrays(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of every text, and all ids; new pieces of all texts are encoded in one call."""
        texts = texts.cast(pa.large_string()).fill_null("")
        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        begins = cuts(data, bounds)
        pieces = pa.LargeStringArray.from_buffers(len(begins) - 1, pa.py_buffer(begins.astype(np.int64)), pa.py_buffer(data))
        coded = pieces.dictionary_encode()
        words = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) > MEMORY:
            self.forget()
        numbers = np.fromiter(map(self.known.get, words, repeat(-1)), np.int64, len(words))
        plain, odd, long = [], [], []
        for k in np.flatnonzero(numbers < 0).tolist():
            word = words[k]
            if len(word) > MEMORY_LETTERS:
                long.append(k)
            elif word.isprintable() and " " not in word[1:] and word != " ":
                plain.append(k)
            else:
                odd.append(k)
        new = [*plain, *odd, *long]
        count = len(self.known)
        numbers[new] = np.arange(count, count + len(new))
        sizes, made = self.learn([words[k] for k in plain], [words[k] for k in [*odd, *long]])
        low = np.concatenate([self.low, self.low[-1] + np.cumsum(sizes)])
        ids = np.concatenate([self.ids, made])

        number = numbers[coded.indices.to_numpy()]
        sizes = np.diff(low)[number]
        out = ids[_ranges(low[number], sizes)]
        ends = np.concatenate([[0], np.cumsum(sizes)])

        self.met[numbers[numbers < count]] = True
        self.known.update(zip([words[k] for k in [*plain, *odd]], range(count, count + len(new))))
        self.met = np.concatenate([self.met, np.zeros(len(self.known) - count, bool)])
        self.low = low[: len(self.known) + 1]
        self.ids = ids[: self.low[-1]].copy() if long else ids
        return np.diff(ends[np.searchsorted(begins, bounds)]), out

    def learn(self, plain: list[str], others: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The number of ids of every piece, and all ids. Plain ones have no white space but a space before them,
        so a line break between two of them is a pre-token, and an id, of its own."""
        lines = ["\n".join(plain[k : k + LINES]) for k in range(0, len(plain), LINES)]
        ids = np.array(list(chain.from_iterable((*m, self.line_break) for m in self.encode(lines))), np.int32)
        breaks = np.flatnonzero(ids == self.line_break)
        if len(breaks) != len(plain):
            others, ids, breaks = [*plain, *others], ids[:0], breaks[:0]
        own = self.encode(others)
        sizes = np.concatenate([np.diff(breaks, prepend=-1) - 1, [len(x) for x in own]]).astype(np.int64)
        return sizes, np.concatenate([ids[ids != self.line_break], *(np.array(x, np.int32) for x in own)])


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _schema(kind: str) -> str:
    return f"doc_id {kind}, part int, start bigint, at bigint, n_tokens bigint, ids array<int>"


def _encoded(docs: DataFrame, tokenizer: str, id_column: str, text: str, end: int) -> DataFrame:
    """Rows of the files, from documents in order; ``start`` counts the ids of the partition before the document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, part, start = encoder(tokenizer), TaskContext.get().partitionId(), 0
        for batch in batches:
            low = 0
            keys, texts = batch.column(0), batch.column(1)
            ends = np.cumsum(pc.binary_length(texts).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
            while low < len(texts):
                size = CHUNK + (ends[low - 1] if low else 0)
                high = min(low + ROWS, len(texts), max(low, int(np.searchsorted(ends, size))) + 1)
                counts, values = code.arrays(texts.slice(low, high - low))
                values = np.insert(values, np.cumsum(counts), end)
                counts += 1
                starts = start + np.concatenate([[0], np.cumsum(counts)])
                start = int(starts[-1])
                rows = -(-counts // PIECE)
                doc = np.repeat(np.arange(len(counts)), rows)
                at = (np.arange(len(doc)) - np.repeat(np.cumsum(rows) - rows, rows)) * PIECE
                sizes = np.minimum(counts[doc] - at, PIECE)
                bounds = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(bounds), pa.array(values, pa.int32()))
                made = pa.RecordBatch.from_arrays(
                    [
                        keys.slice(low, high - low).take(pa.array(doc)),
                        pa.array(np.full(len(doc), part, np.int32)),
                        pa.array(starts[doc]),
                        pa.array(at),
                        pa.array(counts[doc]),
                        ids,
                    ],
                    names=["doc_id", "part", "start", "at", "n_tokens", "ids"],
                )
                for k in range(0, len(made), ROWS):
                    yield made.slice(k, ROWS)
                low = high

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text).mapInArrow(run, _schema(kind))


def write_ids(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    id_column: str = "doc_id",
    text: str = "text",
    end: int = 0,
    stripe_bytes: int = 64 << 20,
    index_rows: int = 1000,
) -> None:
    """Write the ids of all texts below ``path`` in ascending order of the document ids.

    Rows of one id spread over several partitions where they have to, for their hash and place
    take part in the sort.
    """
    spark = docs.sparkSession
    named = docs.select(F.col(id_column).alias("doc_id"), F.col(text).cast("string").alias("text"))
    placed = named.select("*", F.xxhash64("text").alias("_hash"), F.monotonically_increasing_id().alias("_place"))
    rows = _encoded(placed.orderBy("doc_id", "_hash", "_place"), tokenizer, "doc_id", "text", end)
    (
        rows.write.option("orc.bloom.filter.columns", "doc_id")
        .option("orc.bloom.filter.fpp", "0.01")
        .option("orc.create.index", "true")
        .option("orc.row.index.stride", str(index_rows))
        .option("orc.stripe.size", str(stripe_bytes))
        .orc(f"{path}/ids")
    )
    # One row for each written partition: the index of the files.
    written = spark.read.schema(rows.schema).orc(f"{path}/ids").where("at = 0")
    parts = written.groupBy("part").agg(
        F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"), F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens")
    )
    listed = sorted(parts.collect())
    before = accumulate((r.n_tokens for r in listed), initial=0)
    index = spark.createDataFrame(
        [(*r, n) for r, n in zip(listed, before)], ", ".join([*(f"{f.name} {f.dataType.simpleString()}" for f in parts.schema), "before bigint"])
    )
    index.coalesce(1).write.orc(f"{path}/parts")


def read_ids(spark: SparkSession, path: str, where: Column | None = None) -> DataFrame:
    """Rows of the files: (doc_id, start, at, n_tokens, ids), ``start`` counted over all files.

    A condition on ``doc_id`` reaches the files' statistics, row indexes and Bloom filters.
    """
    rows = spark.read.orc(f"{path}/ids")
    if where is not None:
        rows = rows.where(where)
    parts = spark.read.orc(f"{path}/parts").select("part", "before")
    return rows.join(F.broadcast(parts), "part").select("doc_id", (F.col("start") + F.col("before")).alias("start"), "at", "n_tokens", "ids")


def _times(a: int, b: int) -> int:
    """Product of two polynomials over bits modulo that of CRC-32, lowest power in the highest bit."""
    out = 0
    for k in range(31, -1, -1):
        if a >> k & 1:
            out ^= b
        b = b >> 1 ^ (0xEDB88320 if b & 1 else 0)
    return out


@lru_cache(maxsize=4096)
def _behind(n: int) -> int:
    """x to the power 8 n: what a CRC is multiplied by when n bytes follow."""
    out, power, bits = 1 << 31, 1 << 30, 8 * n
    while bits:
        if bits & 1:
            out = _times(out, power)
        power = _times(power, power)
        bits >>= 1
    return out


def documents_of(rows: DataFrame) -> DataFrame:
    """One row per document of ``read_ids``: (doc_id, start, n_tokens, ids_crc32).

    The CRC of a document is the exclusive or of its rows' own, each moved by the bytes that
    follow it, so rows may be read by different tasks and meet as an aggregate.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(4)
            bounds = ids.offsets.to_numpy()
            values = ids.values.to_numpy().astype("<i4")
            sizes = np.diff(bounds)
            crcs = []
            for low, high, at, n in zip(bounds[:-1].tolist(), bounds[1:].tolist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()):
                crc = zlib.crc32(values[low:high].tobytes())
                follow = 4 * (n - at - (high - low))
                crcs.append(_times(crc, _behind(follow)) if follow else crc)
            columns = [batch.column(0), batch.column(1), pa.array(sizes.astype(np.int64)), pa.array(crcs, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n", "crc"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    pieces = rows.mapInArrow(run, f"doc_id {kind}, start bigint, n bigint, crc bigint")
    return pieces.groupBy("doc_id", "start").agg(F.sum("n").alias("n_tokens"), F.bit_xor("crc").alias("ids_crc32"))
