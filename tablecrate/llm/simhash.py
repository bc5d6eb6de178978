"""SimHash near-duplicates by anchor-point covering.

The anchors are the codewords of a product of perfect codes (the Golay code of length 23,
twice; for very many fingerprints a Hamming code of length 15 besides) over the first bits of
a fingerprint. In a block of length 23 every word has exactly one codeword within the covering
radius 3: its home. A fingerprint is replicated to every anchor within covering radius plus
threshold, that is to the homes of all words within the threshold, the distance being shared
by the blocks. Of two fingerprints within the threshold, each therefore meets the other at
the other's home, and only fingerprints that meet, one of them at home, are compared.

An anchor with more than `CROWD` fingerprints is not compared pair by pair. Its members go
to the points between: for a threshold of 2, two fingerprints are linked exactly if one bit
changed in each, or in one, or none, makes them the same word, so all that share such a word
are linked, and at most 65 can. That is exact and linear in the members.

Equal fingerprints are one node. A text without words (or null) has fingerprint 0, linked like
any other; a shorter text than a shingle is one shingle. A null key is never a component's
name unless all its keys are null. Repeated rows stay repeated; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate, combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecrate.llm.arrow import with_computed
from tablecrate.llm.common import stored
from tablecrate.llm.components import components

SHINGLE = 3
SEED = 42
THRESHOLD = 2
BITS = 64
CROWD = 64
# Blocks of a fingerprint: first bit, length. The third for over this many fingerprints.
BLOCKS = ((0, 23), (23, 23), (46, 15))
MANY = 1 << 22


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The bits set in over half the shingles' XXH64; unsigned."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # A-Z, ASCII white space
    if not words:
        return 0
    joined = b" ".join(words)
    ends = [end - 1 for end in accumulate(len(w) + 1 for w in words)]
    starts = [0, *(end + 1 for end in ends[:-1])]
    digest = xxhash.xxh64_intdigest
    spans = zip(starts, ends[shingle - 1 :]) if len(words) >= shingle else [(0, len(joined))]
    hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], "<u8")
    set_in = np.zeros(BITS, np.int64)
    for part in range(0, len(hashes), 1 << 14):
        block = hashes[part : part + (1 << 14)].view(np.uint8).reshape(-1, 8)
        set_in += np.unpackbits(block, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    over = 2 * set_in > len(hashes)
    return int(np.packbits(over, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`df` with `simhash`, the fingerprint's bits as a (signed) long."""

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        found = np.array([fingerprint(t) for t in batch.column(text).to_pylist()], np.uint64)
        return {"simhash": pa.array(found.view(np.int64))}

    return with_computed(df, compute, "simhash long", keep)


class PerfectCode:
    """Words of one length, each with its only codeword within the covering radius."""

    def __init__(self, length: int):
        # The generator polynomials of the two cyclic codes.
        generator, self.radius = {23: (0xC75, 3), 15: (0b10011, 1)}[length]
        self.length, self.checks = length, generator.bit_length() - 1
        each = np.zeros(length, np.uint32)
        for bit in range(length):
            rest = 1 << bit
            for high in range(bit, self.checks - 1, -1):
                if rest >> high & 1:
                    rest ^= generator << (high - self.checks)
            each[bit] = rest
        # Syndromes of the lower and the upper half of a word.
        self.half = length // 2 + 1
        self.low, self.high = self._sums(each[: self.half]), self._sums(each[self.half :])
        self.leader = np.zeros(1 << self.checks, np.uint32)
        for weight in range(1, self.radius + 1):
            for bits in combinations(range(length), weight):
                self.leader[np.bitwise_xor.reduce(each[list(bits)])] = sum(1 << b for b in bits)
        near = [c for w in range(THRESHOLD + 1) for c in combinations(range(length), w)]
        self.errors = np.array([sum(1 << b for b in bits) for bits in near], np.uint32)
        self.excess = np.array([len(bits) for bits in near], np.uint16)

    @staticmethod
    def _sums(each: np.ndarray) -> np.ndarray:
        sums = np.zeros(1, np.uint32)
        for one in each:
            sums = np.concatenate((sums, sums ^ one))
        return sums

    def home(self, words: np.ndarray) -> np.ndarray:
        """The codeword of each word, by its information bits."""
        syndrome = self.low[words & np.uint32((1 << self.half) - 1)] ^ self.high[words >> np.uint32(self.half)]
        return (words ^ self.leader[syndrome]) >> np.uint32(self.checks)

    def reach(self, words: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each excess 0, 1, 2: (word number, anchor) of the anchors that are that much
        farther than the covering radius allows, and no less."""
        homes = self.home(words[:, None] ^ self.errors).astype(np.uint16)
        ranked = np.sort(homes << np.uint16(2) | self.excess, axis=1)
        first = np.ones(ranked.shape, bool)
        first[:, 1:] = ranked[:, 1:] >> 2 != ranked[:, :-1] >> 2
        owner, at = np.nonzero(first)
        found = ranked[owner, at]
        return [(owner[found & 3 == e], (found[found & 3 == e] >> 2).astype(np.int64)) for e in range(THRESHOLD + 1)]


@lru_cache(maxsize=2)
def codes(blocks: tuple[tuple[int, int], ...]) -> list[PerfectCode]:
    return [PerfectCode(length) for _, length in blocks]


def _paired(a: tuple, b: tuple, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All pairs of a's and b's anchors with the same owner: owner, a's, b's."""
    count = np.bincount(b[0], minlength=n)
    start = np.concatenate(([0], np.cumsum(count)))[:-1]
    times = count[a[0]]
    owner = np.repeat(a[0], times)
    turn = np.arange(len(owner)) - np.repeat(np.cumsum(times) - times, times)
    return owner, np.repeat(a[1], times), b[1][start[owner] + turn]


def anchors(prints: np.ndarray, blocks: tuple[tuple[int, int], ...]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each fingerprint every anchor within reach: number, anchor, whether it is home."""
    made = codes(blocks)
    n = len(prints)
    reach = [
        code.reach((prints >> np.uint64(shift) & np.uint64((1 << length) - 1)).astype(np.uint32))
        for code, (shift, length) in zip(made, blocks)
    ]
    owners, points, homes = [], [], []
    for excess in product(range(THRESHOLD + 1), repeat=len(blocks)):
        if sum(excess) > THRESHOLD:
            continue
        held = reach[0][excess[0]]
        for code, e, each in zip(made[1:], excess[1:], reach[1:]):
            owner, a, b = _paired(held, each[e], n)
            held = owner, a << np.int64(code.length - code.checks) | b
        owners.append(held[0])
        points.append(held[1])
        homes.append(np.full(len(held[0]), not any(excess)))
    return np.concatenate(owners), np.concatenate(points), np.concatenate(homes)


def _replicated(blocks: tuple[tuple[int, int], ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = batch.column(0).to_numpy()
            for part in range(0, len(prints), 2048):
                some = prints[part : part + 2048]
                owner, point, home = anchors(some.view(np.uint64), blocks)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(point), pa.array(some[owner]), pa.array(home)], ["anchor", "simhash", "home"]
                )

    return run


def _compared(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by anchor in, links out; (x, x) for each member x of a crowded anchor."""
    none = np.zeros(0, np.int64)
    anchor, prints, home = none, none, np.zeros(0, bool)
    crowded: int | None = None

    def out(a: list[np.ndarray], b: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x or [none])) for x in (a, b)], ["a", "b"])

    def links(anchor: np.ndarray, prints: np.ndarray, home: np.ndarray) -> pa.RecordBatch:
        starts = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1]))) if len(anchor) else none
        size = np.diff(np.concatenate((starts, [len(anchor)])))
        big = np.repeat(size > most, size)
        left, right = [prints[big]], [prints[big]]
        anchor, prints, home = anchor[~big], prints[~big], home[~big]
        bits = prints.view(np.uint64)
        at = np.arange(len(anchor))
        for step in range(1, most):
            at = at[at + step < len(anchor)]
            at = at[anchor[at] == anchor[at + step]]
            if not len(at):
                break
            near = np.bitwise_count(bits[at] ^ bits[at + step]) <= THRESHOLD
            near &= home[at] | home[at + step]
            left.append(prints[at[near]])
            right.append(prints[at[near] + step])
        return out(left, right)

    for batch in batches:
        more = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        if crowded is not None:  # the rest of an anchor that was crowded already
            same = more[0] == crowded
            yield out([more[1][same]], [more[1][same]])
            more = [x[~same] for x in more]
            if len(more[0]):
                crowded = None
        anchor, prints, home = (np.concatenate(x) for x in zip((anchor, prints, home), more))
        if not len(anchor):
            continue
        # The last anchor may go on in the next batch.
        done = int(np.searchsorted(anchor, anchor[-1]))
        if len(anchor) - done > most:
            crowded, done = int(anchor[-1]), len(anchor)
        yield links(anchor[:done], prints[:done], home[:done])
        anchor, prints, home = anchor[done:], prints[done:], home[done:]
    yield links(anchor, prints, home)


def links(nodes: DataFrame, blocks: tuple[tuple[int, int], ...], most: int = CROWD) -> DataFrame:
    """a, b: pairs of the distinct fingerprints `simhash` of `nodes` that link, so many that
    linked fingerprints are connected."""
    met = nodes.select("simhash").mapInArrow(_replicated(blocks), "anchor long, simhash long, home boolean")
    dealt = met.repartition("anchor").sortWithinPartitions("anchor")
    found = stored(dealt.mapInArrow(lambda batches: _compared(batches, most), "a long, b long"), "simhash_links")
    # Points between the members of crowded anchors: themselves and one bit changed.
    crowd = found.where("a = b").select(F.col("a").alias("x")).distinct()
    changed = F.array(F.col("x"), *(F.col("x").bitwiseXOR(F.lit((1 << b) - (1 << BITS if b == 63 else 0))) for b in range(BITS)))
    at_point = crowd.select("x", F.explode(changed).alias("point")).groupBy("point")
    # At most 65 fingerprints share a point.
    stars = at_point.agg(F.collect_set("x").alias("xs")).where(F.size("xs") > 1)
    between = stars.select(F.array_min("xs").alias("a"), F.explode("xs").alias("b"))
    return found.where("a <> b").unionAll(between.where("a <> b"))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, simhash, component: the least key that links of at most `THRESHOLD` bits reach."""
    prints = stored(fingerprints(df, text, [key]), "simhashes")
    nodes = stored(prints.groupBy("simhash").agg(F.min(key).alias("least")), "simhash_nodes")
    blocks = BLOCKS[:2] if nodes.count() <= MANY else BLOCKS
    roots = components(links(nodes, blocks))
    rooted = nodes.join(roots, nodes["simhash"] == roots["node"], "left").select(
        "simhash", "least", F.coalesce("root", "simhash").alias("root")
    )
    names = rooted.groupBy("root").agg(F.min("least").alias("component"))
    named = rooted.join(names, "root").select(F.col("simhash").alias("held"), "component")
    return prints.join(named, F.col("simhash") == F.col("held")).select(key, "simhash", "component")
