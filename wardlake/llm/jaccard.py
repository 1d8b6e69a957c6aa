"""N-gram Jaccard join with adaptive multi-match prefixes.

A text is the set of its distinct word shingles. Texts with equal sets form a class; the rest works
on classes. Shingles have a global order, rare ones first: their counts over the corpus are summed
in ``2**ORDER_BITS`` buckets (a table of fixed size, broadcast), ties go by hash. If two sets of
sizes n and m are as similar as asked, then for any k their first n - need(n) + k and m - need(m) + k
shingles have k in common, where need(n) is the least intersection a set of n can link with. A class
publishes its prefix for k = 1 .. ``MOST_MATCHES``; from the number of classes at each shingle the
cost of candidates is estimated, and the class picks the k of the least cost: a longer prefix with
more required matches where partners are many. Classes with fewer than k published shingles that
others also have need no comparison at all.

Pairs first meet a parity sketch: a bit for each of ``SKETCH_BITS`` buckets says whether an odd
number of shingles fell there. Every shingle that only one of two sets has changes one bit at most,
so sketches that differ in more bits than the sets may differ in shingles rule the pair out, and
no linked pair is ever ruled out. What is left is verified on whole sets.

Large groups of near copies are not expanded: every class is compared with a few leaders of its
shingles, in rounds, and pairs that pass the sketch stand as links for the choice of the next
leaders. All of them are verified, and true components are formed. Then only classes of different
components are compared, for each shingle those outside its largest component with the others. So
all pairs that could join two components are tried, which makes the components exact, and the work
at a shingle that one large component fills stays linear.

Shingles are compared by 64-bit hashes and sets by 128-bit digests.

Defined results: a null or empty text, or one without words, has an empty set, size 0, and its own
id as component; a null id never is the smallest unless all are null; rows repeated with one id
form one class; other columns are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardlake.llm.arrays import LOWER, NOT_SPACE, Rolling, Words, mix, slices, windows
from wardlake.llm.bitmaps import is_marked, marked_bits
from wardlake.llm.graph import components
from wardlake.llm.stored import drop_stored, stored
from wardlake.operators.quality import unused_name

ORDER_BITS = 18
MOST_MATCHES = 8
MATCHES = (1, 2, 4, 8)
#: Cost of a verification in units of the cost of one shared shingle.
VERIFY_COST = 8
#: Bits of the sketch of a set, and of the filters for shared shingles and chosen documents.
SKETCH_BITS = 1024
TOKEN_BITS = 27
CHOICE_BITS = 24
#: Leaders tried by a class in each round; more rounds follow while they still find links.
LEADERS = (2, 8, 8, 8)


class Join(NamedTuple):
    """Sets of ``size`` words, linked from a similarity of ``percent`` hundredths on."""

    size: int
    percent: int


class Sets(NamedTuple):
    """Distinct shingles of the rows of a slice, row by row."""

    hashes: np.ndarray
    row: np.ndarray
    counts: np.ndarray


def shingles(data: np.ndarray, bounds: np.ndarray, size: int) -> Sets:
    """Hashes of runs of ``size`` words; a row with fewer has its whole sequence as one."""
    low = LOWER[data]
    words = Words(low, bounds, NOT_SPACE)
    n_rows = len(bounds) - 1
    if not len(words):
        return Sets(np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(n_rows, np.int64))
    each = Rolling(low)(words.start, words.end)
    hashes, at = windows(words, each, size)
    rows = words.row[at]
    for n in range(1, size):
        few = np.flatnonzero(words.counts == n)
        whole = np.full(len(few), n, np.uint64)
        for k in range(n):
            whole = mix(whole + each[words.first[few] + k])
        hashes, rows = np.concatenate([hashes, whole]), np.concatenate([rows, few])
    order = np.lexsort((hashes, rows))
    hashes, rows = hashes[order], rows[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (rows[1:] != rows[:-1])
    hashes, rows = hashes[new], rows[new]
    return Sets(hashes, rows, np.bincount(rows, minlength=n_rows).astype(np.int64))


def _digests(sets: Sets) -> list[bytes]:
    """128 bits for each set, whatever the order of its members."""
    ends = np.concatenate([[0], np.cumsum(sets.counts)])
    parts = []
    for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F):
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(sets.hashes ^ np.uint64(salt)), dtype=np.uint64)])
        parts.append(mix((sums[ends[1:]] - sums[ends[:-1]]) + sets.counts.astype(np.uint64)))
    raw = np.ascontiguousarray(np.stack(parts, axis=1)).tobytes()
    return [raw[k : k + 16] for k in range(0, len(raw), 16)]


def _bucket(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - ORDER_BITS)).astype(np.int64)


def frequencies(texts: DataFrame, size: int) -> np.ndarray:
    """How many shingles of the corpus fall into each bucket of hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << ORDER_BITS, np.int64)
        for batch in batches:
            for _, data, bounds in slices(batch):
                total += np.bincount(_bucket(shingles(data, bounds, size).hashes), minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(total[used])], names=["bucket", "n"])

    sums = texts.select("text").mapInArrow(run, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(1 << ORDER_BITS, np.int64)
    out[sums.column("bucket").to_numpy()] = sums.column("n").to_numpy()
    return out


def need(n: np.ndarray, percent: int) -> np.ndarray:
    """The least intersection that a set of n can have with one it links with."""
    return (percent * n + 99) // 100


def _sketches(sets: Sets) -> pa.Array:
    """Parities of the buckets of each set, as ``SKETCH_BITS // 64`` numbers."""
    bits = np.bincount(sets.row * SKETCH_BITS + (sets.hashes >> np.uint64(7)).astype(np.int64) % SKETCH_BITS, minlength=len(sets.counts) * SKETCH_BITS)
    words = np.packbits((bits & 1).astype(np.uint8)).view(np.int64)
    ends = np.arange(0, len(words) + 1, SKETCH_BITS // 64, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(words))


def published(docs: DataFrame, join: Join, order: np.ndarray) -> DataFrame:
    """(doc_id, n, cls, sketch, prefix): size, digest and sketch of the set of each text (doc_id, text),
    and its first shingles in the global order, as many as ``MOST_MATCHES`` matches ask for.

    Sets so small that no other set can link with them publish nothing.
    """
    shared = docs.sparkSession.sparkContext.broadcast(order)
    size, percent = join

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, data, bounds in slices(batch):
                sets = shingles(data, bounds, size)
                n = sets.counts
                rank = np.lexsort((sets.hashes, shared.value[_bucket(sets.hashes)], sets.row))
                first = np.cumsum(n) - n
                take = np.minimum(n, n - need(n, percent) + MOST_MATCHES)
                take[100 * n < percent * (n + 1)] = 0
                ends = np.concatenate([[0], np.cumsum(take)])
                at = np.repeat(first - ends[:-1], take) + np.arange(ends[-1])
                tokens = sets.hashes[rank[at]].view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(n),
                        pa.array(_digests(sets), pa.binary()),
                        _sketches(sets),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(tokens)),
                    ],
                    names=["doc_id", "n", "cls", "sketch", "prefix"],
                )

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {id_type}, n bigint, cls binary, sketch array<bigint>, prefix array<bigint>")


def sets_of(docs: DataFrame, chosen: DataFrame, join: Join) -> DataFrame:
    """(cls, members) of the chosen classes (cls, doc_id) at least, from the texts (doc_id, text).

    Rows are dealt by class once; joins on ``cls`` need no other shuffle of them.
    """
    size = join.size
    wanted = docs.sparkSession.sparkContext.broadcast(marked_bits(chosen.select(F.xxhash64("doc_id").alias("hash")), CHOICE_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = batch.column(2).to_numpy().view(np.uint64)
            for _, data, bounds in slices(batch.filter(pa.array(is_marked(wanted.value, hashes)))):
                sets = shingles(data, bounds, size)
                ends = np.concatenate([[0], np.cumsum(sets.counts)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(_digests(sets), pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(sets.hashes.view(np.int64)))],
                    names=["cls", "members"],
                )

    texts = docs.select("doc_id", "text", F.xxhash64("doc_id").alias("hash"))
    return texts.mapInArrow(run, "cls binary, members array<bigint>").dropDuplicates(["cls"])


def postings(classes: DataFrame, join: Join) -> DataFrame:
    """(token, k, n, at, level, matches, root), stored: published shingles that several classes have.

    ``at`` is the place in the order of the class, ``level`` the number of required matches from
    which on the shingle belongs to the prefix, ``matches`` what the class asks for; shingles
    beyond its prefix are left out, and so are classes that cannot reach their matches. ``root`` is
    the class itself.
    """
    percent = join.percent
    several = classes.select(F.explode("prefix").alias("token")).groupBy("token").agg(F.count("*").alias("n")).where("n > 1")
    marks = classes.sparkSession.sparkContext.broadcast(marked_bits(several.select("token"), TOKEN_BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, len(batch), 2_000):
                part = batch.slice(low, 2_000)
                tokens = part.column(2).flatten().to_numpy()
                sizes = part.column(2).value_lengths().to_numpy()
                row = np.repeat(np.arange(len(part)), sizes)
                n = part.column(1).to_numpy()[row]
                place = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
                level = np.maximum(1, place + 1 - (n - need(n, percent)))
                kept = np.flatnonzero(is_marked(marks.value, tokens.view(np.uint64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(tokens[kept]), part.column(0).take(pa.array(row[kept])), pa.array(n[kept].astype(np.int32)), pa.array(place[kept].astype(np.int32)), pa.array(level[kept].astype(np.int8))],
                    names=["token", "k", "n", "at", "level"],
                )

    rows = classes.select("k", "n", "prefix").mapInArrow(run, "token bigint, k bigint, n int, at int, level tinyint")
    times = rows.groupBy("token").agg(F.count("*").alias("times")).where("times > 1")
    rows = stored(rows.join(times.hint("shuffle_hash"), "token"), "shared")
    # estimated cost for each number of matches, and the cheapest
    costs, counts = [], []
    for m in MATCHES:
        inside = F.col("level") <= m
        scanned = F.sum(F.when(inside, F.col("times") - 1).otherwise(0))
        possible = F.max(F.floor((percent * F.col("n") + 99) / 100) >= m)
        costs.append(F.when(possible, scanned + scanned * VERIFY_COST / (m * m)).otherwise(float("inf")))
        counts.append(F.sum(inside.cast("int")))
    options = F.array_sort(F.array(*(F.struct(c.alias("cost"), F.lit(m).alias("m"), k.alias("held")) for c, m, k in zip(costs, MATCHES, counts))))
    chosen = rows.groupBy("k").agg(options[0].alias("best")).select("k", F.col("best.m").alias("matches"), F.col("best.held").alias("held"))
    chosen = chosen.where("held >= matches").drop("held")
    kept = rows.drop("times").join(chosen, "k").where("level <= matches").withColumn("root", F.col("k"))
    kept = stored(kept, "postings")
    drop_stored(rows)
    return kept


def sketched(pairs: DataFrame, classes: DataFrame, join: Join) -> DataFrame:
    """The pairs (a, b) that their sketches do not rule out.

    A link asks for a symmetric difference of (100 - percent) / (100 + percent) of both sizes at most.
    """
    own = classes.select("k", "n", "sketch")
    a = own.select(F.col("k").alias("a"), F.col("n").alias("_na"), F.col("sketch").alias("_sa"))
    b = own.select(F.col("k").alias("b"), F.col("n").alias("_nb"), F.col("sketch").alias("_sb"))
    differing = F.aggregate(F.zip_with("_sa", "_sb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)
    allowed = (100 - join.percent) * (F.col("_na") + F.col("_nb"))
    return pairs.join(a, "a").join(b, "b").where((100 + join.percent) * differing <= allowed).select("a", "b")


def verified(pairs: DataFrame, sets: DataFrame, names: DataFrame, join: Join) -> DataFrame:
    """The pairs (a, b) whose sets are as similar as asked; names (k, cls) tell their digests."""
    a = names.select(F.col("k").alias("a"), F.col("cls").alias("_ca"))
    b = names.select(F.col("k").alias("b"), F.col("cls").alias("_cb"))
    own = sets.select(F.col("cls").alias("_ca"), F.col("members").alias("_a"))
    other = sets.select(F.col("cls").alias("_cb"), F.col("members").alias("_b"))
    both = F.size(F.array_intersect("_a", "_b"))
    union = F.size("_a") + F.size("_b") - both
    met = pairs.select("a", "b").join(a, "a").join(b, "b").join(own, "_ca").join(other, "_cb")
    return met.where(100 * both >= join.percent * union).select("a", "b")


def _sizes_fit(join: Join) -> Column:
    return 100 * F.least("n", "n_other") >= join.percent * F.greatest("n", "n_other")


def leader_pairs(rows: DataFrame, join: Join, seed: int, tries: int) -> DataFrame:
    """Pairs of a class and a leader of one of its shingles in another component; each class tries
    the leaders with the most shingles in common."""
    rank = F.xxhash64("k", F.lit(seed))
    leader = F.min(F.struct(rank.alias("r"), "k", "root", "n")).alias("leader")
    leaders = rows.groupBy("token").agg(leader).select(
        "token", F.col("leader.k").alias("other"), F.col("leader.root").alias("other_root"), F.col("leader.n").alias("n_other")
    )
    met = rows.join(leaders, "token").where((F.col("root") != F.col("other_root")) & _sizes_fit(join))
    met = met.groupBy("k", "other").agg(F.count("*").alias("common"))
    # as many leaders as the class has shingles at most
    places = F.slice(F.reverse(F.array_sort(F.collect_list(F.struct("common", "other")))), 1, tries)
    tried = met.groupBy("k").agg(places.alias("best")).select("k", F.explode("best").alias("best")).select("k", "best.other")
    return tried.select(F.least("k", "other").alias("a"), F.greatest("k", "other").alias("b")).distinct()


def crossing_pairs(rows: DataFrame, classes: DataFrame, join: Join) -> DataFrame:
    """All pairs of different components with as many common prefix shingles as the less demanding
    of the two asks for.

    The sizes of a pair tell the intersection it needs, which is more than either class needs in
    general, so only the shorter prefixes for that intersection count. Sketches drop pairs where
    they meet, however many shingles they meet at.
    """
    parts = range(SKETCH_BITS // 64)
    own = classes.select("k", *(F.col("sketch")[i].alias(f"f{i}") for i in parts))
    sizes = rows.groupBy("token", "root").agg(F.count("*").alias("held"))
    largest = sizes.groupBy("token").agg(F.max(F.struct("held", "root"))["root"].alias("main"))
    marked = rows.join(own, "k").join(largest, "token")
    few = marked.where("root <> main")
    others = marked.select("token", (F.col("root") == F.col("main")).alias("is_main"), *(F.col(c).alias(f"{c}_other") for c in ("k", "root", "n", "at", "matches")), *(F.col(f"f{i}").alias(f"g{i}") for i in parts))
    both = F.col("n") + F.col("n_other")
    shared = F.floor((join.percent * both + 99 + join.percent) / (100 + join.percent))
    reach = F.least("matches", "matches_other") - shared
    differing = sum((F.bit_count(F.col(f"f{i}").bitwiseXOR(F.col(f"g{i}"))) for i in parts), F.lit(0))
    met = few.join(others, "token").where(
        (F.col("root") != F.col("root_other"))
        & (F.col("is_main") | (F.col("k") < F.col("k_other")))
        & (F.col("at") < F.col("n") + reach)
        & (F.col("at_other") < F.col("n_other") + reach)
        & _sizes_fit(join)
        & ((100 + join.percent) * differing <= (100 - join.percent) * both)
    )
    pair = (F.least("k", "k_other").alias("a"), F.greatest("k", "k_other").alias("b"))
    return met.groupBy(*pair).agg(F.count("*").alias("common"), F.min(F.least("matches", "matches_other")).alias("asked")).where("common >= asked").select("a", "b")


def _crossing(rows: DataFrame) -> DataFrame:
    """The rows of shingles that still hold several components."""
    open_ = rows.groupBy("token").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("token")
    return rows.join(open_.hint("shuffle_hash"), "token", "left_semi")


def _rerooted(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
    if roots is None:
        return rows
    new = roots.select(F.col("node").alias("root"), F.col("root").alias("_root"))
    return rows.join(new, "root", "left").withColumn("root", F.coalesce("_root", "root")).drop("_root")


def _between_roots(links: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The links between the components that their classes belong to so far."""
    if roots is None:
        return links
    a = roots.select(F.col("node").alias("a"), F.col("root").alias("_a"))
    b = roots.select(F.col("node").alias("b"), F.col("root").alias("_b"))
    joined = links.join(a, "a", "left").join(b, "b", "left")
    return joined.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))


def linked_classes(docs: DataFrame, every: DataFrame, sketches: DataFrame, join: Join) -> DataFrame | None:
    """(node, root): components of the classes (k, cls, n, sketch, doc_id) with a link, by their
    postings; None without links."""

    def links_of(pairs: DataFrame) -> DataFrame:
        """The pairs that whole sets confirm."""
        ends = pairs.select(F.explode(F.array("a", "b")).alias("k")).distinct()
        sets = sets_of(docs, sketches.join(ends, "k", "left_semi").select("cls", "doc_id"), join)
        return stored(verified(pairs, sets, sketches.select("k", "cls"), join), "linked")

    # pairs with leaders, in rounds, by their sketches
    rows, tried = every, None
    for seed, tries in enumerate(LEADERS):
        found = stored(sketched(leader_pairs(rows, join, seed, tries), sketches, join), "tried")
        roots = components(_between_roots(found, rows.select(F.col("k").alias("node"), "root").distinct()))
        if roots is None:
            break
        tried = found if tried is None else tried.union(found)
        before, rows = rows, stored(_crossing(_rerooted(rows, roots)), "open")
        if before is not every:
            drop_stored(before)
    links = None if tried is None else links_of(tried.distinct())
    # what could still join two true components
    roots = None if links is None else components(links)
    rows = _crossing(_rerooted(every, roots))
    left = crossing_pairs(rows, sketches, join)
    if tried is not None:
        left = left.join(tried.distinct(), ["a", "b"], "left_anti")
    left = stored(left, "crossing")
    if not left.isEmpty():
        more = links_of(left)
        links = more if links is None else links.union(more)
        roots = components(links)
    return roots


def near_duplicates(df: DataFrame, join: Join) -> DataFrame:
    """(doc_id, n_shingles, component_id, cls) for every row of (doc_id, text)."""
    docs = df.select("doc_id", "text")
    order = frequencies(docs, join.size)
    full = stored(published(docs, join, order), "published")
    texts = stored(full.select("doc_id", "n", "cls"), "texts")
    firsts = texts.where("n > 0").groupBy("cls").agg(F.min("doc_id").alias("first"))
    classes = full.where("n > 0").where(F.size("prefix") > 0).dropDuplicates(["cls"])
    classes = stored(classes.withColumn("k", F.monotonically_increasing_id()), "classes")
    drop_stored(full)
    every = postings(classes, join)
    sketches = stored(classes.select("k", "cls", "n", "sketch", "doc_id").join(every.select("k").distinct(), "k", "left_semi"), "sketches")
    drop_stored(classes)
    roots = linked_classes(docs, every, sketches, join)
    if roots is not None:
        own = roots.join(sketches.select(F.col("k").alias("node"), "cls"), "node").select("cls", "root")
        least = own.join(firsts, "cls").groupBy("root").agg(F.min("first").alias("least"))
        firsts = firsts.join(own.join(least, "root"), "cls", "left").select("cls", F.least("first", "least").alias("first"))
    firsts = firsts.select(F.col("cls").alias("_cls"), "first")
    return texts.join(firsts, (F.col("cls") == F.col("_cls")) & (F.col("n") > 0), "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("first")).otherwise(F.col("doc_id")).alias("component_id"), "cls"
    )


def one_of_each(df: DataFrame, join: Join) -> DataFrame:
    """The rows of one document, that of the smallest id, of each component; all columns stay.

    Rows without an id stay; rows that repeat id and text stay once.
    """
    own = unused_name("_id", df.columns)
    kept = near_duplicates(df, join).where("doc_id = component_id").select(F.col("doc_id").alias(own)).distinct()
    named = df.join(kept.hint("shuffle_hash"), F.col("doc_id") == F.col(own), "left_semi").dropDuplicates(["doc_id", "text"])
    return named.unionByName(df.where("doc_id is null"))
