"""Byte-level BPE: encoding by a queue of merge ranks, and decoding.

Pre-tokens that are no vocabulary entry are merged over a linked list of parts. A queue has a
bucket for each merge rank with the list positions whose pair has that rank, and a bitmap of two
levels over the buckets in use: find-first-set on each level gives the next rank, whatever the
length of the pre-token. Entries go stale when a neighbour is merged; they are skipped when they
come up. Very long pre-tokens cost O(n log n), not O(n^2).

Defined results: a null or empty text has no ids; a repeated row gives a repeated result; extra
columns are dropped unless named in ``keep``; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Pre-tokens remembered in a worker; the memory is emptied when it is full.
MEMORY = 600_000
#: Longer pre-tokens are not remembered.
MEMORY_LETTERS = 64


class Memory(dict):
    """Ids of the pre-tokens met so far, in a worker."""

    def __init__(self, codec: Codec) -> None:
        self.merge = codec.merge

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = tuple(self.merge(piece.encode()))
        if len(piece) <= MEMORY_LETTERS:
            if len(self) >= MEMORY:
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    """Ranks of a vocabulary file, one base64 entry and its rank on each line."""

    def __init__(self, path: str, pattern: str) -> None:
        with open(path, "rb") as file:
            pairs = (line.split() for line in file if line.strip())
            self.ranks = {base64.b64decode(entry): int(rank) for entry, rank in pairs}
        size = max(self.ranks.values()) + 1
        self.entries = [b""] * size
        for entry, rank in self.ranks.items():
            self.entries[rank] = entry
        self.decimal = [str(k) for k in range(size)]
        self.split = regex.compile(pattern).findall
        self.bits = ((size - 1).bit_length() + 1) // 2
        self.words = [0] * (1 << self.bits)
        self.memory = Memory(self)

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a pre-token.

        ``top`` has a bit for each word of ``words`` in use, a word has a bit for each rank in
        use, and ``buckets`` has a heap of positions for each of these ranks.
        """
        get = self.ranks.get
        whole = get(piece)
        if whole is not None:
            return [whole]
        bits, words, top, buckets = self.bits, self.words, 0, {}
        low = (1 << bits) - 1
        n = len(piece)
        after = list(range(1, n + 1))  # start of the next part
        before = list(range(-1, n - 1))
        pair = [-1] * n  # rank of the part and its next one
        for k in range(n - 1):
            rank = get(piece[k : k + 2])
            if rank is not None:
                pair[k] = rank
                if rank in buckets:
                    buckets[rank].append(k)  # ascending, so it stays a heap
                else:
                    buckets[rank] = [k]
                    words[rank >> bits] |= 1 << (rank & low)
                    top |= 1 << (rank >> bits)
        while top:
            at = (top & -top).bit_length() - 1
            word = words[at]
            first = word & -word
            rank = (at << bits) + first.bit_length() - 1
            bucket = buckets[rank]
            if len(bucket) > 1:
                k = heappop(bucket)
            else:
                k = bucket[0]
                del buckets[rank]
                words[at] = word = word ^ first
                if not word:
                    top ^= 1 << at
            if pair[k] != rank:
                continue  # stale
            gone = after[k]
            end = after[k] = after[gone]
            pair[gone] = pair[k] = -1
            if end < n:
                before[end] = k
                rank = get(piece[k : after[end]])
                if rank is not None:
                    pair[k] = rank
                    if rank in buckets:
                        heappush(buckets[rank], k)
                    else:
                        buckets[rank] = [k]
                        words[rank >> bits] |= 1 << (rank & low)
                        top |= 1 << (rank >> bits)
            if k:
                left = before[k]
                rank = get(piece[left:end])
                if rank is None:
                    pair[left] = -1
                elif rank != pair[left]:
                    pair[left] = rank
                    if rank in buckets:
                        heappush(buckets[rank], left)
                    else:
                        buckets[rank] = [left]
                        words[rank >> bits] |= 1 << (rank & low)
                        top |= 1 << (rank >> bits)
        out, k = [], 0
        while k < n:
            end = after[k]
            out.append(get(piece[k:end]))
            k = end
        return out

    def encode(self, text: str) -> list[int]:
        return list(chain.from_iterable(map(self.memory.__getitem__, self.split(text))))

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.entries.__getitem__, ids))


@lru_cache(maxsize=4)
def codec(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


#: What `tokenize` can return, and its Spark type.
OUTPUTS = {
    "n_tokens": "bigint",
    "ids": "array<int>",
    "ids_sha256": "string",
    "decoded": "binary",
    "decoded_sha256": "string",
}
_BUILD = {"bigint": pa.int64(), "array<int>": pa.list_(pa.int32()), "string": pa.string(), "binary": pa.binary()}


def tokenize(
    df: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",), outputs: tuple[str, ...] = ("ids",)
) -> DataFrame:
    """Encode every text by the ranks in the file at ``path``, and decode the ids again.

    ``outputs`` names the columns wanted; digests are taken of the ids joined by commas and of
    the decoded bytes. The file is read once in each worker and has to exist on every machine.
    """
    schema = ", ".join([*(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep), *(f"{o} {OUTPUTS[o]}" for o in outputs)])
    wanted = set(outputs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = codec(path, pattern)
        for batch in batches:
            for low in range(0, len(batch), 256):
                part = batch.slice(low, 256)
                made: dict[str, list] = {o: [] for o in outputs}
                for value in part.column(len(keep)):
                    ids = code.encode(value.as_py() or "")
                    decoded = code.decode(ids) if wanted & {"decoded", "decoded_sha256"} else b""
                    row = {"n_tokens": len(ids), "ids": ids, "decoded": decoded}
                    if "ids_sha256" in wanted:
                        row["ids_sha256"] = hashlib.sha256(",".join(map(code.decimal.__getitem__, ids)).encode()).hexdigest()
                    if "decoded_sha256" in wanted:
                        row["decoded_sha256"] = hashlib.sha256(decoded).hexdigest()
                    for o in outputs:
                        made[o].append(row[o])
                arrays = [*part.columns[: len(keep)], *(pa.array(made[o], _BUILD[OUTPUTS[o]]) for o in outputs)]
                yield pa.RecordBatch.from_arrays(arrays, names=[*keep, *outputs])

    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(run, schema)
