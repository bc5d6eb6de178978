"""Near-duplicates by the share of common word shingles: every pair at the threshold is found.

Two texts are near-duplicates if their sets of distinct five-word shingles have a Jaccard
similarity of 0.8 or more. Candidates come in two rounds; each is held against the sets
themselves, and nothing joins two texts but that.

The first round is quick and finds most: fingerprints that `simhash.links` joins by its
anchors, and texts that agree in one of `BANDS` bands of `ROWS` minimum hashes, each with the
least text at its point only (over `SHARES` shares if a share holds several), so the work is
linear in the members, however many copies there are.

The second round is exact, by `points`: texts at the threshold agree in a point for certain, so
all pairs at a point that the first round left in different groups are compared, those of
very many texts tile by tile. Sizes and the parities of 512 bins of the shingles tell most of
them apart before the sets are read; both are bounds that no pair at the threshold exceeds.

Texts of one set are one node, named by 64 bits of its content.

Letters A-Z are lower-cased; words stand between ASCII white space; a text of fewer than five
words is one shingle; null and texts without words are alike. Repeated rows are one group, an
empty table has none, other columns do not matter.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablecrate.llm import simhash
from tablecrate.llm.arrow import with_computed
from tablecrate.llm.common import stored
from tablecrate.llm.components import components

SHINGLE = 5
SEED = 42
BANDS = 20
ROWS = 5
SHARES = 64
# Sizes of sets from a power of this to the next share their parts.
SCALE = 4
FEWEST_PARTS = 32
WORDS = 8  # of 64 parity bits
# Texts of one point that a task holds at once against the others.
TILE = 1024
# Shingles mixed for all lanes at once: what a processor's cache holds.
BLOCK = 256

# The hashes are random already; an odd factor puts them in an order of its own for each lane.
_FACTORS = np.random.default_rng(11).integers(0, 1 << 64, BANDS * ROWS, np.uint64) | np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """XXH64 of each shingle in order, repeats included."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()  # A-Z, ASCII white space
    if not found:
        return np.zeros(0, "<u8")
    joined = b" ".join(found)
    ends = [end - 1 for end in accumulate(len(w) + 1 for w in found)]
    starts = [0, *(end + 1 for end in ends[:-1])]
    spans = zip(starts, ends[SHINGLE - 1 :]) if len(found) >= SHINGLE else [(0, len(joined))]
    return np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans), "<u8")


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half the hashes, signed."""
    over = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BLOCK):
        bits = np.unpackbits(hashes[at : at + BLOCK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        over += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * over > len(hashes), bitorder="little").view("<i8")[0])


def bands(distinct: np.ndarray) -> list[int]:
    """The value of each band of minimum hashes, signed."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(distinct), BLOCK):
        mixed = distinct[None, at : at + BLOCK] * _FACTORS[:, None]
        np.minimum(least, mixed.min(axis=1), out=least)
    return [_signed(xxhash.xxh3_64_intdigest(band.tobytes())) for band in least.reshape(BANDS, ROWS)]


def points(distinct: np.ndarray) -> np.ndarray:
    """Values of which two sets (sorted) at the similarity share one at least, signed.

    Sets of a and b shingles at 0.8 differ in (a + b) / 9 shingles at most. Ranges of the hash cut
    both into the same parts, of which then all but (a + b) / 9 are equal. Parts are in one
    order for all sets (those of more shingles first, as they are the least common). The first
    part that both have alike is among the first (a + b) / 9 + 1 of either, for each part that
    goes before it in one of them is unlike in the other. As b is at most 5 a / 4, so many are
    a / 4 + 1 of the smaller set. The number of parts goes with a range of sizes; a set just
    above its lower end goes with the range below as well.
    """
    size = len(distinct)
    if size < SCALE:  # similar only to itself
        return np.zeros(0, np.int64)
    low = SCALE
    while low * SCALE <= size:
        low *= SCALE
    found = [_strongest(distinct, low, size // 4)]
    if low > SCALE and 4 * size <= 5 * (low - 1):
        found.append(_strongest(distinct, low // SCALE, (size + low - 1) // 9))
    return np.concatenate(found).view(np.int64)


def _strongest(distinct: np.ndarray, low: int, unlike: int) -> np.ndarray:
    """The first `unlike` + 1 parts of a set, empty ones last, among sets of `low` shingles on."""
    parts = max(FEWEST_PARTS, 5 * low // 4)
    part = (distinct >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
    starts = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
    counts = np.diff(starts, append=len(distinct))
    salt = np.uint64(low * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
    values = np.add.reduceat(distinct, starts) * _FACTORS[0] ^ salt
    values = values[np.lexsort((values, -counts))[: unlike + 1]]
    if len(values) <= unlike:
        empty = np.setdiff1d(np.arange(parts, dtype=np.uint64), part)[: unlike + 1 - len(values)]
        values = np.concatenate((values, (empty + np.uint64(1)) * _FACTORS[1] ^ salt))
    return values


def parities(distinct: np.ndarray) -> np.ndarray:
    """Whether each of 64 * `WORDS` bins holds an odd number of the shingles: sets differ in at
    least as many shingles as bins."""
    bins = (distinct * _FACTORS[2] >> np.uint64(32)) * np.uint64(64 * WORDS) >> np.uint64(32)
    odd = np.bincount(bins.astype(np.int64), minlength=64 * WORDS).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view("<i8")


def _signed(digest: int) -> int:
    return digest - (1 << 64) if digest >> 63 else digest


def _named(distinct: np.ndarray) -> int:
    return _signed(xxhash.xxh3_64_intdigest(distinct.tobytes()))


def _described(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    names, counts, prints, lanes, odd = [], [], [], [], []
    for text in batch.column("__text").to_pylist():
        hashes = shingles(text)
        distinct = np.unique(hashes)
        names.append(_named(distinct))
        counts.append(len(distinct))
        prints.append(majority(hashes))
        lanes.append(bands(distinct))
        odd.append(parities(distinct))
    return {
        "node": pa.array(names, pa.int64()), "shingles": pa.array(counts, pa.int64()),
        "simhash": pa.array(prints, pa.int64()), "bands": pa.array(lanes, pa.list_(pa.int64())),
        "odd": pa.array(odd, pa.list_(pa.int64())),
    }


def _pointed(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    sets = [np.unique(shingles(text)) for text in batch.column("__text").to_pylist()]
    return {
        "node": pa.array([_named(distinct) for distinct in sets], pa.int64()),
        "points": pa.array([points(distinct) for distinct in sets], pa.list_(pa.int64())),
    }


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by point and node, each node once, those of points with several nodes."""
    last = np.zeros(0, np.int64), np.zeros(0, np.int64)
    before = False  # the last row's point has an earlier node

    def out(point: np.ndarray, node: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(point), pa.array(node)], ["point", "node"])

    for batch in batches:
        point, node = (np.concatenate((x, batch.column(i).to_numpy())) for i, x in enumerate(last))
        if not len(point):
            continue
        new = np.concatenate(([True], (point[1:] != point[:-1]) | (node[1:] != node[:-1])))
        point, node = point[new], node[new]
        shared = np.concatenate(([False], point[1:] == point[:-1]))
        shared[0] = before
        before = bool(shared[-1])
        shared[:-1] |= point[1:] == point[:-1]
        last = point[-1:], node[-1:]
        yield out(point[:-1][shared[:-1]], node[:-1][shared[:-1]])
    if before:
        yield out(*last)


def _sets(batch: pa.RecordBatch) -> dict[str, pa.Array]:
    return {
        "held": pa.array(
            [np.unique(shingles(text)).view(np.int64) for text in batch.column("__text").to_pylist()], pa.list_(pa.int64())
        )
    }


def _stars(nodes: DataFrame) -> DataFrame:
    """a, b: candidates of nodes that share a point, least first."""
    at = F.transform("bands", lambda value, lane: F.struct(lane.alias("lane"), value.alias("value")))
    prints = F.array(F.struct(F.lit(-1).alias("lane"), F.col("simhash").alias("value")))
    points = nodes.select("node", F.explode(F.concat(at, prints)).alias("point")).select("node", "point.*")
    share = F.pmod(F.xxhash64("node"), F.lit(SHARES)).alias("share")
    shared = Window.partitionBy("lane", "value", "share")
    first = stored(points.select("*", share).withColumn("least", F.min("node").over(shared)).drop("share"), "points")
    within = first.where("node <> least").select(F.col("least").alias("a"), F.col("node").alias("b"))
    # At most one node a share is left.
    whole = Window.partitionBy("lane", "value")
    across = first.where("node = least").withColumn("least", F.min("node").over(whole)).where("node <> least")
    return within.unionAll(across.select(F.col("least").alias("a"), F.col("node").alias("b")))


def _by_anchors(nodes: DataFrame) -> DataFrame:
    """a, b: the least nodes of fingerprints that SimHash's anchors join."""
    least = stored(nodes.groupBy("simhash").agg(F.min("node").alias("least")), "similar_prints")
    blocks = simhash.BLOCKS[:2] if least.count() <= simhash.MANY else simhash.BLOCKS
    left = least.select(F.col("simhash").alias("a"), F.col("least").alias("x"))
    right = least.select(F.col("simhash").alias("b"), F.col("least").alias("y"))
    met = simhash.links(least, blocks).join(left, "a").join(right, "b")
    return met.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))


def _quick(nodes: DataFrame) -> DataFrame:
    """a, b: the candidates of the first round."""
    return _stars(nodes).unionAll(_by_anchors(nodes)).distinct()


def _apart(nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b: nodes of different `root` that share one of their `points` and that neither sizes
    nor parities tell apart. Of points with the same nodes one is read."""
    emitted = with_computed(texts, _pointed, "node bigint, points array<bigint>", [])
    dealt = emitted.select(F.explode("points").alias("point"), "node").repartition("point").sortWithinPartitions("point", "node")
    shared = stored(dealt.mapInArrow(_met, "point long, node long"), "shared_points")
    rooted = shared.join(nodes.select("node", "root"), "node")
    named = F.sum(F.xxhash64("node").cast("decimal(20,0)")).alias("named")
    groups = rooted.groupBy("point", "root").agg(F.count(F.lit(1)).alias("nodes"), named)
    # Members of the largest group at a point are held only against the others.
    at_point = groups.groupBy("point").agg(
        F.sum("nodes").alias("nodes"), F.sum("named").alias("named"),
        F.max(F.struct("nodes", "root"))["root"].alias("main"), F.count(F.lit(1)).alias("groups"),
    )
    single = at_point.where("groups > 1").groupBy("nodes", "named").agg(F.min(F.struct("point", "main")).alias("held"))
    tiles = F.ceil(F.col("nodes") / TILE).cast("int").alias("tiles")
    kept = stored(single.select("held.*", tiles), "points_apart")
    bins = [f"odd_{i}" for i in range(WORDS)]
    facts = nodes.select("node", "root", "shingles", *(F.col("odd")[i].alias(name) for i, name in enumerate(bins)))
    members = stored(shared.join(kept, "point").join(facts, "node"), "members")
    tile = F.pmod(F.xxhash64("node"), F.col("tiles")).cast("int").alias("tile")
    every = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)).alias("tile")
    columns = ["node", "root", "shingles", *bins]
    a, b = (
        rows.select("point", at, "main", *(F.col(c).alias(f"{side}_{c}") for c in columns))
        for side, rows, at in (("a", members.where("root <> main"), every), ("b", members, tile))
    )
    unlike = sum((F.bit_count(F.col(f"a_{name}").bitwiseXOR(F.col(f"b_{name}"))) for name in bins), F.lit(0))
    once = (F.col("b_root") == F.col("main")) | (F.col("a_node") < F.col("b_node"))
    sizes = F.col("a_shingles") + F.col("b_shingles")
    low, high = F.least("a_shingles", "b_shingles"), F.greatest("a_shingles", "b_shingles")
    near = once & (F.col("a_root") != F.col("b_root")) & (5 * low >= 4 * high) & (9 * unlike <= sizes)
    pairs = a.join(b.drop("main"), ["point", "tile"]).where(near)
    return pairs.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct()


def links(candidates: DataFrame, nodes: DataFrame, texts: DataFrame) -> DataFrame:
    """a, b: the candidates whose sets reach the similarity. `nodes` has node, shingles and `at`,
    the row of `texts` (`at`, `__text`) with its text."""
    met = stored(candidates, "candidates")
    known = nodes.select("node", "shingles", "at")
    a, b = (known.select(*(F.col(c).alias(f"{side}_{c}") for c in known.columns)) for side in "ab")
    sized = met.join(a, F.col("a") == F.col("a_node")).join(b, F.col("b") == F.col("b_node"))
    # Sets whose sizes are too far apart cannot be similar.
    low, high = F.least("a_shingles", "b_shingles"), F.greatest("a_shingles", "b_shingles")
    close = stored(sized.where(5 * low >= 4 * high).select("a", "b", "a_at", "b_at", "a_shingles", "b_shingles"), "close")
    wanted = close.select(F.col("a_at").alias("at")).unionAll(close.select(F.col("b_at").alias("at"))).distinct()
    held = stored(with_computed(texts.join(wanted, "at", "left_semi"), _sets, "held array<bigint>", ["at"]), "sets")
    a, b = (held.select(F.col("at").alias(f"{side}_at"), F.col("held").alias(f"{side}_held")) for side in "ab")
    both = close.join(a, "a_at").join(b, "b_at")
    common = F.size(F.array_intersect("a_held", "b_held"))
    # common / (a + b - common) >= 4 / 5
    return both.where(9 * common >= 4 * (F.col("a_shingles") + F.col("b_shingles"))).select("a", "b")


def first_of_each(df: DataFrame, order: Column, at: str, text: str = "text") -> DataFrame:
    """`first`: of each group of near-duplicates the least value of `order`. `at` is a column
    with a number of its own for each row."""
    texts = df.select(F.col(at).alias("at"), F.col(text).alias("__text"), order.alias("first"))
    added = "node bigint, shingles bigint, simhash bigint, bands array<bigint>, odd array<bigint>"
    described = stored(with_computed(texts, _described, added, ["at", "first"]), "described")
    # Rows of one node have the same of everything else; many of them are one already here.
    same = [F.first(c).alias(c) for c in ("shingles", "simhash", "bands", "odd")]
    nodes = stored(described.groupBy("node").agg(F.min("first").alias("first"), F.min("at").alias("at"), *same), "nodes")
    texts = texts.select("at", "__text")
    quick = _rooted(nodes, components(links(_quick(nodes), nodes, texts)), "node")
    grouped = stored(quick.select("node", "root", "first", "shingles", "at", "odd"), "grouped")
    known = grouped.select("node", "root")
    more = links(_apart(grouped, texts), grouped, texts)
    for side in "ab":
        more = more.join(known, F.col(side) == F.col("node")).drop(side, "node").withColumnRenamed("root", side)
    whole = _rooted(grouped, components(more), "root")
    return whole.groupBy("root").agg(F.min("first").alias("first")).select("first")


def _rooted(nodes: DataFrame, roots: DataFrame, of: str) -> DataFrame:
    """`nodes` with `root`, the root of column `of` or itself."""
    found = roots.select(F.col("node").alias("__member"), F.col("root").alias("__root"))
    joined = nodes.join(found, F.col(of) == F.col("__member"), "left")
    return joined.withColumn("root", F.coalesce("__root", of)).drop("__member", "__root")
