"""Benchmark decontamination: benchmark items that stand in documents, up to a budget of edits.

Texts are compared by code point, with A-Z lower-cased and any white space as a blank. By the q-gram
lemma, a part of a text within e edits of an item of m characters shares at least
m + 1 - Q - Q * e of its q-grams, and the places of these differ from their places in the item by
amounts (diagonals) within a band of e + 1. So shared q-grams are counted in bands of 2 * (e + 1)
diagonals that overlap by half, and bands that reach the bound are verified by an alignment that
stays within the band (and e more on either side). Before the counting, hits are dropped where too few hits of any item stand
within the length of an item.

Items are dealt into blocks of about ``BLOCK_CHARACTERS`` by hash, and every block is broadcast and
sought in all documents on its own, so that a benchmark of any size is searched in bounded memory.

Items shorter than ``SHORTEST`` characters allow no edits. They are sought exactly, as whole words, by an
automaton of all of them.

Defined results: null and empty texts hold nothing; items without a character that is not blank identify
nothing and are left out, null items too; equal items are separate items; a document row
is reported once for each item in it, with its best place (fewest edits, then first); repeated rows
are reported each; empty tables give empty results.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardlake.llm.arrays import mix, slices

Q = 8
EDIT_PERCENT = 8
SHORTEST = 24
BLOCK_CHARACTERS = 1 << 20
FILTER_BITS = 24

_U64 = np.uint64
_BASE = 0xD6E8FEB86659FD93


class Items(NamedTuple):
    """One block of items with an index of their q-grams."""

    ids: list  # of the items with points, then of the short ones
    points: list[np.ndarray]
    length: np.ndarray
    edits: np.ndarray
    least: np.ndarray  # shared q-grams that a place needs
    filter: np.ndarray  # which leading bits of a hash occur
    grams: np.ndarray  # sorted hashes
    first: np.ndarray  # of each gram's uses
    item: np.ndarray
    place: np.ndarray
    short: list[str]


def normal(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of a slice, normalized, and the bounds of its rows in them."""
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32).copy()
    starts = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[bounds]
    points[(points >= 9) & (points <= 13)] = 32
    points[(points >= 65) & (points <= 90)] += 32
    return points, starts


def letters(points: np.ndarray) -> str:
    """The code points as a string."""
    return points.astype("<u4").tobytes().decode("utf-32-le", "replace")


def gram_hashes(points: np.ndarray) -> np.ndarray:
    """The hash of the ``Q`` code points from each place on (across rows, too)."""
    n = len(points) - Q + 1
    if n <= 0:
        return np.zeros(0, _U64)
    x = points.astype(_U64) + _U64(1)
    out = x[:n].copy()
    for k in range(1, Q):
        out *= _U64(_BASE)
        out += x[k : k + n]
    return mix(out)


def index(ids: list, texts: list[str]) -> Items:
    kept, short = [], []
    for id_, text in zip(ids, texts):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        points, _ = normal(raw, np.array([0, len(raw)]))
        if len(points) >= SHORTEST:
            kept.append((id_, points))
        elif string := letters(points).strip(" "):
            short.append((id_, string))
    points = [p for _, p in kept]
    length = np.array([len(p) for p in points], np.int64)
    edits = np.minimum(length * EDIT_PERCENT // 100, (length - Q) // Q)
    hashes = np.concatenate([gram_hashes(p) for p in points] or [np.zeros(0, _U64)])
    item = np.repeat(np.arange(len(points)), np.maximum(length - Q + 1, 0))
    place = np.concatenate([np.arange(len(p) - Q + 1) for p in points] or [np.zeros(0, np.int64)])
    order = np.argsort(hashes, kind="stable")
    grams, first = np.unique(hashes[order], return_index=True)
    mask = np.zeros(1 << FILTER_BITS, bool)
    mask[(grams >> _U64(64 - FILTER_BITS)).astype(np.int64)] = True
    return Items(
        [i for i, _ in kept + short], points, length, edits, length + 1 - Q - Q * edits, mask,
        grams, np.concatenate([first, [len(hashes)]]), item[order], place[order],
        [string for _, string in short],
    )


def align(item: np.ndarray, text: np.ndarray, low: int, high: int, edits: int) -> tuple[int, int, int] | None:
    """(edits, start, end) of the best place of the item in the text on diagonals low .. high, if
    within the budget; the alignment may leave the band by as many diagonals as it has edits."""
    low, high = low - edits, high + edits
    width = high - low + 1
    unit = 1 << 32  # cost in the high part, first diagonal in the low one
    m = len(item)
    # text padded so that every place of the band exists; the padding equals nothing
    pad_left = max(0, -low)
    pad_right = max(0, m + high - len(text))
    inside = np.concatenate([np.full(pad_left, 0xFFFFFFFF, np.uint32), text, np.full(pad_right, 0xFFFFFFFF, np.uint32)])
    base = low + pad_left
    steps = np.arange(width, dtype=np.int64) * unit
    never = unit << 20
    at = low + np.arange(width)
    row = np.where((at >= 0) & (at <= len(text)), np.arange(width, dtype=np.int64), never)
    for i in range(m):
        across = inside[base + i : base + i + width]
        new = row + np.where(across == item[i], 0, unit)
        new[across == 0xFFFFFFFF] = never
        new[:-1] = np.minimum(new[:-1], row[1:] + unit)
        # a text character more: one diagonal to the right
        row = np.minimum.accumulate(new - steps) + steps
        if (row.min() >> 32) > edits:
            return None
    row[low + np.arange(width) + m > len(text)] = never
    best = int(np.argmin(row >> 32))
    cost = int(row[best] >> 32)
    if cost > edits:
        return None
    return cost, low + int(row[best] & (unit - 1)), low + best + m


def search(items: Items, data: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """(row, item, start, end, edits) of all items in the rows of a slice."""
    points, starts = normal(data, bounds)
    return sorted(search_long(items, points, starts) + search_short(items, points, starts))


def search_short(items: Items, points: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """The first place of each short item in each row, where it stands between letters and digits of no word."""
    if not items.short:
        return []
    text, bounds = letters(points), starts.tolist()
    found = {}
    for last, members in automaton(tuple(items.short)).iter(text):
        for one in members:
            end, low = last + 1, last + 1 - len(items.short[one])
            row = bisect_right(bounds, low) - 1
            if end > bounds[row + 1] or (row, one) in found:
                continue
            opens = low == bounds[row] or not (text[low - 1].isalnum() and text[low].isalnum())
            closes = end == bounds[row + 1] or not (text[end].isalnum() and text[last].isalnum())
            if opens and closes:
                found[row, one] = (row, len(items.points) + one, low - bounds[row], end - bounds[row], 0)
    return list(found.values())


@lru_cache(maxsize=4)
def automaton(short: tuple[str, ...]) -> ahocorasick.Automaton:
    """All short items; each place gives the numbers of the items that equal it."""
    made = ahocorasick.Automaton()
    members: dict[str, list[int]] = {}
    for k, string in enumerate(short):
        members.setdefault(string, []).append(k)
    for string, numbers in members.items():
        made.add_word(string, numbers)
    made.make_automaton()
    return made


def search_long(items: Items, points: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """The best place of each item within its budget of edits."""
    hashes = gram_hashes(points)
    if not len(items.grams) or not len(hashes):
        return []
    at = np.flatnonzero(items.filter[(hashes >> _U64(64 - FILTER_BITS)).astype(np.int64)])
    gram = np.minimum(np.searchsorted(items.grams, hashes[at]), len(items.grams) - 1)
    same = items.grams[gram] == hashes[at]
    at, gram = at[same], gram[same]
    row = np.searchsorted(starts, at, side="right") - 1
    whole = at + Q <= starts[row + 1]
    at, gram, row = at[whole], gram[whole], row[whole]
    reach = int((items.length + items.edits).max())
    near = np.searchsorted(at, at + reach, side="right") - np.searchsorted(at, at - reach)
    dense = near >= int(items.least.min())
    at, gram, row = at[dense], gram[dense], row[dense]
    if not len(at):
        return []
    times = items.first[gram + 1] - items.first[gram]
    ends = np.cumsum(times)
    use = np.arange(ends[-1]) + np.repeat(items.first[gram] - (ends - times), times)
    of = np.repeat(np.arange(len(at)), times)
    item = items.item[use]
    diagonal = at[of] - starts[row[of]] - items.place[use]
    band = np.floor_divide(diagonal, items.edits[item] + 1)
    n_items = len(items.points)
    lines = (row[of] * n_items + item).astype(np.int64)
    offset = int(items.length.max()) + 2  # bands may lie before the text
    span = int(np.max(starts[1:] - starts[:-1])) + 2 * offset
    key = lines * span + band + offset
    keys, counts = np.unique(np.concatenate([key, key - 1]), return_counts=True)
    item = keys // span % n_items
    full = counts >= items.least[item]
    found: dict[tuple[int, int], tuple[int, int, int]] = {}
    for k, one in zip(keys[full], item[full]):
        r, low_band = int(k // span // n_items), int(k % span) - offset
        width = int(items.edits[one]) + 1
        got = align(items.points[one], points[starts[r] : starts[r + 1]], low_band * width, (low_band + 2) * width - 1, int(items.edits[one]))
        if got and ((r, int(one)) not in found or got < found[r, int(one)]):
            found[r, int(one)] = got
    return [(r, one, start, end, edits) for (r, one), (edits, start, end) in sorted(found.items())]


def blocks(benchmark: DataFrame) -> Iterator[Broadcast]:
    """Indexes of the benchmark's items, about ``BLOCK_CHARACTERS`` at a time."""
    items = benchmark.select("item_id", "text").where("text is not null")
    total = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // BLOCK_CHARACTERS)
    for k in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == k).collect()
        yield items.sparkSession.sparkContext.broadcast(index([r.item_id for r in rows], [r.text for r in rows]))


def leaks(df: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text") -> DataFrame:
    """(keep, item_id, start, end, edits): items found in the texts, places in code points."""
    kinds = [f"`{c}` {df.schema[c].dataType.simpleString()}" for c in keep]
    schema = ", ".join([*kinds, f"item_id {benchmark.schema['item_id'].dataType.simpleString()}", "start bigint, end bigint, edits int"])
    texts = df.select(*keep, F.col(text).alias("_text"))

    def search_with(items: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, data, bounds in slices(batch, "_text"):
                    got = search(items.value, data, bounds)
                    if got:
                        rows, which, *rest = zip(*got)
                        ids = pa.array([items.value.ids[k] for k in which])
                        yield pa.RecordBatch.from_arrays(
                            [*(c.take(pa.array(rows)) for c in part.columns[:-1]), ids, *(pa.array(v, t) for v, t in zip(rest, (pa.int64(), pa.int64(), pa.int32())))],
                            names=[*keep, "item_id", "start", "end", "edits"],
                        )

        return texts.mapInArrow(run, schema)

    out = None
    for items in blocks(benchmark):
        found = search_with(items)
        out = found if out is None else out.union(found)
    return df.sparkSession.createDataFrame([], schema) if out is None else out


def without_leaks(df: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows whose text holds no item; all columns stay, and nothing is shuffled."""

    def clean_of(df: DataFrame, items: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, data, bounds in slices(batch, text):
                    bad = {r for r, *_ in search(items.value, data, bounds)}
                    yield part.filter(pa.array([k not in bad for k in range(len(part))])) if bad else part

        return df.mapInArrow(run, df.schema)

    for items in blocks(benchmark):
        df = clean_of(df, items)
    return df
