"""Near-duplicate lines by a segment-partition edit join.

Two lines are duplicates if at most `EDITS` insertions, deletions or changes of a code point
turn one into the other; lines under `SHORTEST` code points only if they are equal. A line is
split into EDITS + 1 segments, so one of them stands unchanged in any line within the
threshold. Each distinct line is indexed by its segments, and probes, for every length it
could be paired with, the substrings that can still align (the multi-match-aware window). An
index entry and a probe meet under the hash of length, segment number and content. Pairs that
meet are first held against a bound from their letter parities, then verified by banded
bit-parallel edit distance.

Segments that very many lines share are no group of their own: the members of a key with over
`CROWD` entries are joined again on more segments (one more that must agree for each level),
which is as exact and linear in the members. The last level compares its keys in blocks.

Lines are cut at line feeds. Null text has no line, empty text one empty line. Classes are
connected components; a class is named by its first line, by document key, then line number.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecrate.llm.common import stored
from tablecrate.llm.components import components

EDITS = 2
SHORTEST = 20
CROWD = 512
LEVELS = 3
# Distinct lines a task remembers, to send each of them on once.
REMEMBERED = 100_000


def line_id(line: str) -> int:
    """A 64-bit name of a line's content, signed."""
    return xxhash.xxh3_64_intdigest(line.encode("utf-8", "surrogatepass")) - (1 << 63)


def segments(size: int, parts: int) -> list[tuple[int, int]]:
    """Start and length of each segment of a line of `size`: the last ones are longer by one."""
    short, more = divmod(size, parts)
    lengths = [short + (i >= parts - more) for i in range(parts)]
    return [(sum(lengths[:i]), lengths[i]) for i in range(parts)]


def windows(size: int, other: int, parts: int, edits: int) -> list[tuple[int, int, range]]:
    """(segment number, length, starts): where a line of `size` may hold each segment of an
    indexed line of length `other` <= `size`, by the multi-match-aware bounds for exactly
    one agreeing segment, or the whole shift where more must agree."""
    delta = size - other
    found = []
    for i, (start, length) in enumerate(segments(other, parts)):
        if parts == edits + 1:
            low = max(start - i, start + delta - (edits - i))
            high = min(start + i, start + delta + (edits - i))
        else:  # any segment may be among the agreeing ones
            low, high = start - (edits - delta) // 2, start + delta + (edits - delta) // 2
        low, high = max(low, 0), min(high, size - length)
        found.append((i, length, range(low, high + 1)))
    return found


@lru_cache(maxsize=8_192)
def probes(size: int, level: int) -> tuple[list[tuple[int, int]], list[tuple[int, list[tuple]]]]:
    """For lines of `size`: the own segments, and for each length of an indexed line the
    choices of `level` places (segment number, start, length) to probe. Sizes recur."""
    parts = EDITS + level
    found = []
    for other in range(max(SHORTEST, size - EDITS), size + 1):
        held = [[(i, at, length) for at in starts] for i, length, starts in windows(size, other, parts, EDITS)]
        found.append((other, [one for chosen in combinations(held, level) for one in product(*chosen)]))
    return segments(size, parts), found


def entries(line: str, level: int) -> tuple[list[int], list[int]]:
    """The index keys of a line, and the keys it only probes. At `level` n the
    line has EDITS + n segments, of which n must agree."""
    raw = line.encode("utf-32-le", "surrogatepass")  # four bytes a code point: slices need no search
    digest, size = xxhash.xxh3_64_intdigest, len(line)
    own, choices = probes(size, level)
    if level == 1:  # the common case, without the products; hashes of numbers are the same everywhere
        indexed = {hash((size, i, digest(raw[4 * a : 4 * (a + n)]))) for i, (a, n) in enumerate(own)}
        probed = [
            hash((other, i, digest(raw[4 * a : 4 * (a + n)]))) for other, each in choices for ((i, a, n),) in each
        ]
    else:
        part = lru_cache(None)(lambda a, n: digest(raw[4 * a : 4 * (a + n)]))
        name = lambda other, chosen: hash((other, *((i, part(a, n)) for i, a, n in chosen)))
        numbered = [(i, a, n) for i, (a, n) in enumerate(own)]
        indexed = {name(size, chosen) for chosen in combinations(numbered, level)}
        probed = [name(other, chosen) for other, each in choices for chosen in each]
    # Entries of the index meet each other, too.
    return [*indexed], [key for key in probed if key not in indexed]


def parities(lines: list[str]) -> np.ndarray:
    """Of each line, for each of 63 classes of code points, whether it has an odd number of
    them. An edit changes at most two of them. The lowest bit is free."""
    raw = "".join(lines).encode("utf-32-le", "surrogatepass")
    codes = np.frombuffer(raw, np.uint32) * np.uint32(0x9E3779B1)
    kind = ((codes >> np.uint32(16)) % np.uint32(63) + np.uint32(1)).astype(np.int64)
    owner = np.repeat(np.arange(len(lines)), [len(line) for line in lines])
    odd = (np.bincount(owner * 64 + kind, minlength=64 * len(lines)) & 1).astype(np.uint8)
    return np.packbits(odd.reshape(-1, 64), axis=1, bitorder="little").view(np.int64)[:, 0]


def edit_distance(a: str, b: str, most: int) -> int:
    """The edit distance of two strings, or most + 1 if it is larger.

    Bit-parallel over the 2 * most + 1 diagonals around the main one: a column of the band is
    one small integer, so the time does not grow with the square of the length.
    """
    if abs(len(a) - len(b)) > most:
        return most + 1
    start, limit = 0, min(len(a), len(b))
    while start < limit and a[start] == b[start]:
        start += 1
    a, b = a[start:], b[start:]
    end, limit = 0, min(len(a), len(b))
    while end < limit and a[-1 - end] == b[-1 - end]:
        end += 1
    a, b = a[: len(a) - end], b[: len(b) - end]
    if not a or not b:
        return len(a) + len(b)
    if len(a) > len(b):
        a, b = b, a
    width = 2 * most + 1
    # reached[e]: bit d is set if, after the current letters of b, diagonal d (place in a
    # minus place in b, plus most) can be reached with e edits.
    full = (1 << width) - 1
    reached = [0] * (most + 1)
    reached[0] = 1 << most
    for e in range(1, most + 1):
        reached[e] = reached[e - 1] | (reached[e - 1] << 1) & full
    inside = _inside(0, len(a), most, width)
    reached = [r & inside for r in reached]
    for j, letter in enumerate(b, 1):
        same = 0
        for d in range(width):
            i = j - 1 + d - most
            if 0 <= i < len(a) and a[i] == letter:
                same |= 1 << d
        inside = _inside(j, len(a), most, width)
        new = [reached[0] & same & inside]
        for e in range(1, most + 1):
            before = reached[e - 1]
            # Equal letters or a change keep the diagonal, a letter of b alone lowers it, one
            # of a alone raises it.
            step = (reached[e] & same) | before | before >> 1 | new[e - 1] << 1
            new.append(step & full & inside)
        reached = new
        if not any(reached):
            return most + 1
    last = 1 << (len(a) - len(b) + most)
    return next((e for e in range(most + 1) if reached[e] & last), most + 1)


def _inside(j: int, size: int, most: int, width: int) -> int:
    """The diagonals on which, beside place j of b, a has a place."""
    low, high = max(0, most - j), min(width - 1, size - j + most)
    return ((1 << (high + 1)) - 1) & ~((1 << low) - 1) if high >= low else 0


def _slices(batch: pa.RecordBatch) -> Iterator[list[str]]:
    for start in range(0, batch.num_rows, 500):
        yield [t for t in batch.column(0).slice(start, 500).to_pylist() if t is not None]


class Seen:
    """Which lines came lately: most repeated ones are then sent on once a task."""

    def __init__(self) -> None:
        self.new, self.old = set(), set()

    def first(self, key: int) -> bool:
        if key in self.new:
            return False
        known = key in self.old
        if len(self.new) >= REMEMBERED:
            self.old, self.new = self.new, set()
        self.new.add(key)
        return not known


def _fresh_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[int, str]]:
    """Portions of the lines of texts, by name, without those the task met lately."""
    seen, portion = Seen(), {}
    for batch in batches:
        for texts in _slices(batch):
            for text in texts:
                for line in text.split("\n"):
                    if len(line) >= SHORTEST and seen.first(key := line_id(line)):
                        portion[key] = line
                        if len(portion) >= 2_000:
                            yield portion
                            portion = {}
    yield portion


def _entries_of_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lines in _fresh_lines(batches):
        yield _entry_batch(lines, 1)


def _entries_of_lines(level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                yield _entry_batch(dict(zip(part.column(0).to_pylist(), part.column(1).to_pylist())), level)

    return run


def _entry_batch(lines: dict[int, str], level: int) -> pa.RecordBatch:
    keys: list[int] = []
    counts: list[int] = []  # of index keys, of probes, in turn
    for line in lines.values():
        for found in entries(line, level):
            keys += found
            counts.append(len(found))
    flags = np.repeat(np.arange(len(counts)) % 2 == 0, counts)
    counts = np.add.reduceat(counts, np.arange(0, len(counts), 2)) if counts else np.zeros(0, np.int64)
    ids = np.repeat(np.array(list(lines), np.int64), counts)
    marks = np.repeat(parities(list(lines.values())), counts) | flags
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (keys, ids, marks)], ["key", "line", "mark"])


def _met(last: bool, crowd: int):
    """Rows sorted by key in; pairs of an index entry and a probe out, (x, x) for each member
    of a crowded key. `last`: crowded keys are compared, too, in blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.int64)
        held = [none, none, none]
        crowded: int | None = None

        def out(left: list[np.ndarray], right: list[np.ndarray]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(x or [none])) for x in (left, right)], ["a", "b"]
            )

        def near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            changed = (x ^ y).view(np.uint64) >> np.uint64(1)
            return (np.bitwise_count(changed) <= 2 * EDITS) & ((x | y) & 1 == 1)

        def pairs(key: np.ndarray, line: np.ndarray, mark: np.ndarray) -> pa.RecordBatch:
            starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else none
            size = np.diff(np.concatenate((starts, [len(key)])))
            big = np.repeat(size > crowd, size)
            members = np.unique(line[big])
            left, right = [members], [members]
            key, line, mark = key[~big], line[~big], mark[~big]
            at = np.arange(len(key))
            for step in range(1, crowd):
                at = at[at + step < len(key)]
                at = at[key[at] == key[at + step]]
                if not len(at):
                    break
                good = at[near(mark[at], mark[at + step])]
                left.append(line[good])
                right.append(line[good + step])
            return out(left, right)

        def in_blocks(line: np.ndarray, mark: np.ndarray) -> Iterator[pa.RecordBatch]:
            for a in range(0, len(line), 512):
                for b in range(a, len(line), 4096):
                    i, j = np.nonzero(near(mark[a : a + 512, None], mark[None, b : b + 4096]))
                    yield out([line[a + i]], [line[b + j]])

        for batch in batches:
            more = [batch.column(i).to_numpy() for i in range(3)]
            if crowded is not None:
                same = more[0] == crowded
                yield out([more[1][same]], [more[1][same]])
                more = [x[~same] for x in more]
                if len(more[0]):
                    crowded = None
            held = [np.concatenate(x) for x in zip(held, more)]
            if not len(held[0]):
                continue
            # A line sent on by several tasks, or meeting a key twice; index entries come first.
            new = np.ones(len(held[0]), bool)
            new[1:] = (held[0][1:] != held[0][:-1]) | (held[1][1:] != held[1][:-1])
            held = [x[new] for x in held]
            done = int(np.searchsorted(held[0], held[0][-1]))
            if len(held[0]) - done > crowd and not last:
                crowded, done = int(held[0][-1]), len(held[0])
            ready, held = [x[:done] for x in held], [x[done:] for x in held]
            if last:
                yield from _blocks(ready, pairs, in_blocks, crowd)
            else:
                yield pairs(*ready)
        if last:
            yield from _blocks(held, pairs, in_blocks, crowd)
        else:
            yield pairs(*held)

    return run


def _blocks(ready: list[np.ndarray], pairs, in_blocks, crowd: int) -> Iterator[pa.RecordBatch]:
    key, line, mark = ready
    if not len(key):
        return
    starts = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    size = np.diff(np.concatenate((starts, [len(key)])))
    big = np.repeat(size > crowd, size)
    yield pairs(key[~big], line[~big], mark[~big])
    for start, n in zip(starts[size > crowd], size[size > crowd]):
        yield from in_blocks(line[start : start + n], mark[start : start + n])


def lines_of(df: DataFrame, text: str) -> DataFrame:
    """line, content: the lines of all texts, most repeated ones once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lines in _fresh_lines(batches):
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(lines), pa.int64()), pa.array(list(lines.values()), pa.string())],
                ["line", "content"],
            )

    return df.select(text).mapInArrow(run, "line long, content string")


def wanted(df: DataFrame, text: str, ids: DataFrame) -> DataFrame:
    """The contents of the lines `ids` (a column line, distinct), stored."""
    # Never a broadcast: the ids grow with the lines.
    found = lines_of(df, text).join(ids.hint("merge"), "line", "left_semi")
    return stored(found.groupBy("line").agg(F.first("content").alias("content")), "line_contents")


def _distance(most: int):
    @F.arrow_udf("int")
    def distance(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([edit_distance(x, y, most) for x, y in zip(a.to_pylist(), b.to_pylist())], pa.int32())

    return distance


def links(df: DataFrame, text: str = "text", crowd: int = CROWD) -> DataFrame:
    """a, b: the pairs of distinct lines within the threshold, stored, each once."""
    made = df.select(text).mapInArrow(_entries_of_texts, "key long, line long, mark long")
    pairs = None
    for level in range(1, LEVELS + 1):
        dealt = made.repartition("key").sortWithinPartitions("key", "line", F.col("mark").desc())
        met = stored(dealt.mapInArrow(_met(level == LEVELS, crowd), "a long, b long"), "line_pairs")
        named = met.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        pairs = named if pairs is None else pairs.unionAll(named)
        members = met.where("a = b").select(F.col("a").alias("line")).distinct()
        if level == LEVELS or members.isEmpty():
            break
        made = wanted(df, text, members).mapInArrow(_entries_of_lines(level + 1), "key long, line long, mark long")
    pairs = stored(pairs.distinct(), "line_candidates")
    ids = pairs.select(F.col("a").alias("line")).unionAll(pairs.select(F.col("b").alias("line"))).distinct()
    contents = wanted(df, text, ids)
    both = (
        pairs.join(contents.select(F.col("line").alias("a"), F.col("content").alias("x")), "a")
        .join(contents.select(F.col("line").alias("b"), F.col("content").alias("y")), "b")
        .where(_distance(EDITS)("x", "y") <= EDITS)
    )
    return stored(both.select("a", "b"), "line_links")


def _line_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 500):
            part = batch.slice(start, 500)
            texts = [t.split("\n") if t is not None else [] for t in part.column(2).to_pylist()]
            owner = np.repeat(np.arange(len(texts)), [len(t) for t in texts])
            lines = [line for t in texts for line in t]
            ids = [line_id(line) if line.strip() else None for line in lines]
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(0).take(pa.array(owner)),
                    part.column(1).take(pa.array(owner)),
                    pa.array([i for t in texts for i in range(len(t))], pa.int64()),
                    pa.array(ids, pa.int64()),
                    pa.array([len(line) for line in lines], pa.int64()),
                ],
                ["key", "body", "line_no", "line", "n_chars"],
            )


def line_classes(df: DataFrame, key: str = "doc_id", text: str = "text", crowd: int = CROWD) -> DataFrame:
    """One row a line of every text: key, body (a hash of the whole text), line_no (from 0),
    n_chars, class_key and class_line (the first line of its class), n_links (other distinct
    lines within the threshold), kept (it is that first line).

    A line of white space only is a class of its own and kept. Rows of equal key and text
    are kept or not together.
    """
    docs = df.select(F.col(key).alias("key"), F.xxhash64(text).alias("body"), F.col(text).alias("text"))
    kind = df.schema[key].dataType.simpleString()
    schema = f"key {kind}, body long, line_no long, line long, n_chars long"
    places = stored(docs.mapInArrow(_line_ids, schema), "line_places")
    near = links(df, text, crowd)
    roots = components(near)
    ends = near.select(F.col("a").alias("line")).unionAll(near.select(F.col("b").alias("line")))
    degree = ends.groupBy("line").agg(F.count(F.lit(1)).alias("n_links"))
    first = F.min(F.struct("key", "line_no", "body"))
    distinct = places.where("line is not null").groupBy("line").agg(first.alias("first"))
    rooted = (
        distinct.join(roots.withColumnRenamed("node", "line"), "line", "left")
        .join(degree, "line", "left")
        .withColumn("root", F.coalesce("root", "line"))
    )
    rooted = stored(rooted, "line_roots")
    named = rooted.groupBy("root").agg(F.min("first").alias("class"))
    classes = rooted.join(named, "root").select(F.col("line").alias("known"), "class", "n_links")
    found = places.join(classes, F.col("line") == F.col("known"), "left")
    own = F.struct("key", "line_no", "body")
    found = found.withColumn("class", F.when(F.col("line").isNull(), own).otherwise(F.col("class")))
    return found.select(
        F.col("key").alias(key),
        "body",
        "line_no",
        "n_chars",
        F.col("class.key").alias("class_key"),
        F.col("class.line_no").alias("class_line"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.col("class").eqNullSafe(own).alias("kept"),
    )


def without_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`df` with each line that is not kept, of any length, taken out of its text.
    Rows all of whose lines are taken out are dropped; null texts stay."""
    classes = line_classes(df, key, text)
    goes = ~F.col("kept")
    numbered = F.sort_array(F.collect_set(F.struct("line_no", goes.alias("gone"))))
    flagged = (
        classes.groupBy(F.col(key).alias("in_key"), F.col("body").alias("in_body"))
        .agg(numbered.alias("numbered"), F.count_if(goes).alias("n_gone"))
        .where("n_gone > 0")
        .select("in_key", "in_body", F.col("numbered.gone").alias("flags"))
    )
    lines = F.split(F.col(text), "\n")
    kept = F.filter(lines, lambda _, i: ~F.get(F.col("flags"), i))
    whole = F.col("flags").isNull()
    joined = df.withColumn("own_body", F.xxhash64(text)).join(
        flagged, F.col(key).eqNullSafe(F.col("in_key")) & (F.col("own_body") == F.col("in_body")), "left"
    )
    some = F.exists("flags", lambda gone: ~gone)
    new = F.when(whole, F.col(text)).otherwise(F.array_join(kept, "\n"))
    return joined.where(whole | some).withColumn(text, new).select(*df.columns)
