"""Lempel-Ziv phrase fingerprints.

A text is parsed into dictionary phrases: each new phrase is the shortest prefix of what is
left that is no phrase yet (a last, unfinished one counts too). The set of phrases is hashed,
and its minimum under each of `LANES` hash functions is the signature; two signatures agree
in about the share of phrases that their texts have in common, as texts do that compress
each other well. Phrases depend on code points only, so equal texts have equal fingerprints.

Null text counts as empty; it has no phrase, and its fingerprint is all `f`. Two empty texts
are alike (1.0). A text is parsed whole; the dictionary of one text at a time is in memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablecrate.llm.arrow import slices, with_computed

LANES = 128
HEX = 4  # hex digits of a lane

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers in which every bit hangs on every other."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# The hash functions of the lanes: 32-bit multiply and add.
_ODD = (_mixed(np.arange(1, LANES + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)
_PLUS = (_mixed(np.arange(LANES + 1, 2 * LANES + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)
EMPTY = np.full(LANES, 0xFFFFFFFF, np.uint32)


class Powers:
    """Powers of the hash base and of its inverse, as far as the longest text needs."""

    def __init__(self) -> None:
        self.up, self.down = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def reach(self, n: int) -> None:
        while len(self.up) <= n:
            size = len(self.up)
            self.up = np.concatenate((self.up, self.up * np.uint64(pow(_BASE, size, 1 << 64))))
            self.down = np.concatenate((self.down, self.down * np.uint64(pow(_BACK, size, 1 << 64))))


_POWERS = Powers()


def phrases(text: str, known: set[str], start: int = 0) -> tuple[list[int], bool]:
    """Where the phrases of text[start:] end, and whether the last one is finished. `known`
    holds the earlier phrases and gains the new ones.

    Every prefix of a phrase is a phrase, so the search for the longest known one may start
    at any length; it starts at that of the phrase before.
    """
    ends: list[int] = []
    size, at, add = len(text), start, known.add
    length = 3
    while at < size:
        end = at + length
        if text[at:end] in known:
            end += 1
            while text[at:end] in known:
                if end > size:
                    ends.append(size)
                    return ends, False
                end += 1
        else:
            end = min(end, size)
            while end - 1 > at and text[at : end - 1] not in known:
                end -= 1
        add(text[at:end])
        ends.append(end)
        length = end - at
        at = end
    return ends, True


def with_variant(text: str, kept: int, tail: str) -> tuple[np.ndarray, np.ndarray]:
    """The signatures of `text` and of text[:kept] + tail. The phrases that end within the
    kept part are the same in both, so only the rest is parsed twice."""
    known: set[str] = set()
    shared, finished = phrases(text[:kept], known)
    if not finished:
        shared.pop()
    start = shared[-1] if shared else 0
    whole, finished = phrases(text, known, start)
    for a, b in zip([start, *whole], whole if finished else whole[:-1]):
        known.discard(text[a:b])
    edited = text[:kept] + tail
    changed, _ = phrases(edited, known, start)
    hashes = phrase_hashes(text, shared + whole, 0)
    common, own = signature(hashes[: len(shared)]), signature(hashes[len(shared) :])
    other = signature(phrase_hashes(edited, changed, start))
    return np.minimum(common, own), np.minimum(common, other)


def phrase_hashes(text: str, ends: list[int], start: int) -> np.ndarray:
    """A 32-bit hash of each phrase of text[start:]: sums of mixed code points times powers,
    of which a phrase is a difference, moved to place 0."""
    if not ends:
        return np.zeros(0, np.uint32)
    codes = np.frombuffer(text[start : ends[-1]].encode("utf-32-le", "surrogatepass"), np.uint32)
    _POWERS.reach(len(codes) + 1)
    sums = np.zeros(len(codes) + 1, np.uint64)
    np.cumsum((codes + np.uint64(1)) * np.uint64(_BACK) * _POWERS.up[: len(codes)], out=sums[1:])
    stop = np.array(ends, np.int64) - start
    begin = np.zeros_like(stop)
    begin[1:] = stop[:-1]
    moved = (sums[stop] - sums[begin]) * _POWERS.down[begin] + stop.astype(np.uint64) - begin.astype(np.uint64)
    return (_mixed(moved) >> np.uint64(32)).astype(np.uint32)


def signature(hashes: np.ndarray) -> np.ndarray:
    """The minimum of each lane's function over the hashes."""
    found = EMPTY
    for part in range(0, len(hashes), 4096):
        block = hashes[part : part + 4096, None] * _ODD
        block += _PLUS
        found = np.minimum(found, block.min(axis=0))
    return found


def packed(found: np.ndarray) -> bytes:
    """The high bits of each lane, two bytes a lane."""
    lanes = (found * np.uint32(0x9E3779B1)) >> np.uint32(16)
    lanes[found == EMPTY] = 0xFFFF
    return lanes.astype(">u2").tobytes()


def fingerprint(text: str | None) -> str:
    text = text or ""
    return packed(signature(phrase_hashes(text, phrases(text, set())[0], 0))).hex()


def likeness(a: Column, b: Column) -> Column:
    """The share of equal lanes of two fingerprints; null without a second one."""
    lanes = F.sequence(F.lit(0), F.lit(LANES - 1))
    part = lambda c, i: F.substring(c, i * HEX + 1, F.lit(HEX))
    same = F.size(F.filter(lanes, lambda i: part(a, i) == part(b, i)))
    return F.when(a.isNotNull() & b.isNotNull(), same / F.lit(float(LANES)))


def fingerprints(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`df` with `fingerprint`."""

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        return {"fingerprint": pa.array(map(fingerprint, batch.column(text).to_pylist()), pa.string())}

    return with_computed(df, compute, "fingerprint string", keep)


def in_ranges(df: DataFrame, key: str, ranges: int) -> DataFrame:
    """`df` dealt into `range`s of a whole-number key, each with the first rows of the next
    one (`ghost` is true for them), the last with those of the first: so every row meets its
    successor, and no task sees the whole order. A null key comes first.

    Range bounds are approximate quantiles; one number a range reaches the driver.
    """
    least = -(1 << 63)
    keys = df.select(F.coalesce(F.col(key), F.lit(least)).alias("k"))
    shares = [i / ranges for i in range(1, ranges)]
    bounds = keys.agg(F.percentile_approx("k", shares, 20 * ranges)).first()[0] or []
    bounds = np.unique(np.array(bounds, np.int64))

    @F.arrow_udf("int")
    def range_of(k: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(bounds, k.to_numpy(), "right").astype(np.int32))

    firsts = sorted(keys.groupBy(range_of("k").alias("r")).agg(F.min("k")).collect())
    starts = np.array([r[1] for r in firsts] or [0], np.int64)

    @F.arrow_udf("array<struct<range:int,ghost:boolean>>")
    def places(k: pa.Array) -> pa.Array:
        values = k.to_numpy()
        own = np.searchsorted(starts, values, "right") - 1
        opens = starts[own] == values
        owner = np.repeat(np.arange(len(values)), 1 + opens)
        ghost = np.concatenate(([False], owner[1:] == owner[:-1])) if len(owner) else np.zeros(0, bool)
        dealt = np.where(ghost, (own[owner] - 1) % len(starts), own[owner])
        parts = [pa.array(dealt.astype(np.int32)), pa.array(ghost)]
        offsets = np.concatenate(([0], np.cumsum(1 + opens))).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.StructArray.from_arrays(parts, ["range", "ghost"]))

    placed = F.explode(places(F.coalesce(F.col(key), F.lit(least))))
    return df.withColumn("place", placed).select(*df.columns, "place.range", "place.ghost")


def with_edited(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last quarter of its code points replaced by the beginning of the
    next document's text, in ascending order of the whole-number key; rows of equal key are
    ordered by text. After the last comes the first; a lone row is its own successor.
    """
    docs = df.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    ranges = 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = Window.partitionBy("range").orderBy("ghost", "key", "text")
    n = F.length("text")
    quarter = F.floor(n / 4).cast("int")

    rows = in_ranges(docs, "key", ranges).withColumn(
        "tail", F.substring(F.coalesce(F.lead("text").over(order), F.lit("")), F.lit(1), quarter)
    )
    kind = docs.schema["key"].dataType
    rows = rows.select(
        F.col("key").cast(kind).alias("key"),
        n.cast("long").alias("n_chars"),
        F.sha2(F.concat(F.substring("text", F.lit(1), n - quarter), F.col("tail")), 256).alias("edited_sha256"),
        "ghost",
        "text",
        "tail",
    )
    schema = (
        f"key {kind.simpleString()}, n_chars long, edited_sha256 string, fingerprint string,"
        " edited_fingerprint string, near_edited double, near_next double"
    )
    return rows.mapInArrow(_with_successors, schema).withColumnRenamed("key", key)


def _with_successors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in the order of the key, range by range, each range ended by ghosts: every row
    that is no ghost is held against the row after it, so fingerprints need no exchange."""
    held: tuple | None = None  # the row before, and its lanes; None after a ghost
    for batch in batches:
        for part in slices(batch):
            done: list[tuple] = []
            for at, (text, tail) in enumerate(zip(part.column("text").to_pylist(), part.column("tail").to_pylist())):
                own, edited = (
                    np.frombuffer(packed(s), np.uint16) for s in with_variant(text, len(text) - len(text) // 4, tail)
                )
                if held is not None:
                    done.append((*held[0], float((held[1] == own).mean())))
                if part.column("ghost")[at].as_py():
                    held = None
                else:
                    facts = [part.column(name)[at].as_py() for name in ("key", "n_chars", "edited_sha256")]
                    marks = (own.tobytes().hex(), edited.tobytes().hex(), float((own == edited).mean()))
                    held = (*facts, *marks), own
            columns = list(zip(*done)) if done else [()] * 7
            kinds = [part.schema.field("key").type, pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds)],
                ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
            )
