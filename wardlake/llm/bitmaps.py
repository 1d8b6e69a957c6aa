"""Bitmaps of a fixed size over 64-bit hashes, built by Spark and broadcast as filters.

A hash is marked by its leading bits. A mark may be false, a missing mark never is: a bitmap that
fills up lets more rows through, and they are told apart later.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SEGMENT_BITS = 20


def marked_bits(hashes: DataFrame, bits: int) -> np.ndarray:
    """The bitmap of ``2**bits`` bits of a frame with one column of hashes."""
    (name,) = hashes.columns
    segment_bits = min(SEGMENT_BITS, bits - 2)
    bit = F.shiftrightunsigned(name, 64 - bits)
    place = bit.bitwiseAND(F.lit((1 << segment_bits) - 1)).cast("int")
    marks = hashes.select(F.shiftright(bit, segment_bits).cast("int").alias("segment"), place.alias("bit")).distinct()

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        flags = np.zeros(1 << segment_bits, bool)
        flags[table.column("bit").to_numpy()] = True
        return pa.table({"segment": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([np.packbits(flags).tobytes()], pa.binary())})

    out = np.zeros(1 << (bits - 3), np.uint8)
    size = 1 << (segment_bits - 3)
    # at most 2**(bits - segment_bits) rows of a fixed size
    for row in marks.groupBy("segment").applyInArrow(pack, "segment int, bits binary").collect():
        out[row.segment * size : (row.segment + 1) * size] = np.frombuffer(bytes(row.bits), np.uint8)
    return out


def is_marked(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    bit = (hashes >> np.uint64(61 - (len(bitmap).bit_length() - 1))).astype(np.int64)
    return (bitmap[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 == 1
