"""Substring dedup by super-k-mer partitioning.

A window is `WINDOW` consecutive words of a document. It is a repeat if the same words also
stand, as a window, in a document of a smaller key; every word that a repeat covers goes.

Windows are not sent one by one. Of each window the least hash of `SEED` consecutive words is
its minimiser; neighbouring windows mostly share it, and such a run, a super-k-mer, travels as
one packed string of its words to the bucket of the minimiser. Equal windows have equal
minimisers, so they meet there. In a bucket, equal strings become one with the least of their
keys; then the windows of the strings that are left are sorted by their words, and a run of
equal windows tells the least key exactly.

First only the minimisers are counted, without words. A minimiser that one key alone has needs
no string, as none of its windows can be a repeat; in most text that is nearly all of them.

Hot buckets. A minimiser of over `PIECE` strings is dealt into as many pieces by document as
its count asks for, and a piece that arrives larger is cut again, so a task never holds over
`PIECE` strings. A piece settles what it can alone (a key above the least in the piece). Of
each different window it hands on one row, the 128-bit digest of its words with the least
key, and these few rows are brought together by digest.

Words are runs of anything but ASCII white space, unchanged. Null and empty texts have no
words. Texts are never cut; a text under `WINDOW` words has no window. A null key is neither
smaller nor larger than others: nothing of such a row goes, and it takes nothing out. Rows of
equal key leave each other alone; rows equal in key and text are treated alike (those of equal
key are told apart by a 64-bit hash of the text). An empty table gives an empty one. Columns
named like a result are replaced, others stay whatever their names.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tablecrate.llm.arrow import slices, with_computed
from tablecrate.llm.common import stored, unused

WINDOW = 50
SEED = 6
PIECE = 4_096
# Windows of one packed string at most: a text of one repeated word is one run.
LONGEST = 64
# The white space between words.
IS_SPACE = np.isin(np.arange(256), (9, 10, 11, 12, 13, 32))
# Strings in one batch that leaves a task.
BATCH = 16_384


class Words:
    """The words of several texts: where each stands in `joined`, one blank apart, and the
    number of its text."""

    def __init__(self, texts: list[bytes]):
        offsets = np.cumsum([0, *(len(t) + 1 for t in texts)])
        data = np.frombuffer(b" ".join((*texts, b"")), np.uint8)
        space = IS_SPACE[data]
        before = np.concatenate(([True], space[:-1]))
        starts = np.flatnonzero(before & ~space)
        sizes = np.flatnonzero(space & ~before) - starts
        self.text = np.searchsorted(offsets, starts, "right") - 1
        data = np.where(space, np.uint8(32), data)[~(space & before)]
        self.ends = np.cumsum(sizes + 1) - 1
        self.starts = self.ends - sizes
        self.sizes, self.joined = sizes, data.tobytes()
        self.firsts = np.searchsorted(self.text, np.arange(len(texts)))  # first word of each text

    def hashes(self) -> np.ndarray:
        """64 bits of each word's length, first and last eight bytes."""
        padded = np.frombuffer(bytes(8) + self.joined + bytes(8), np.uint8)
        eight = np.lib.stride_tricks.sliding_window_view(padded, 8)
        blank = np.uint64(8) * (np.uint64(8) - np.minimum(self.sizes, 8).astype(np.uint64))
        ones = np.uint64(0xFFFFFFFFFFFFFFFF)
        first = eight[self.starts + 8].view("<u8").ravel() & ones >> blank
        last = eight[self.ends].view("<u8").ravel() & ones << blank
        each = first * np.uint64(0x9FB21C651E98DF25) + self.sizes.astype(np.uint64)
        each ^= each >> np.uint64(29)
        return (each + last) * np.uint64(0xA24BAED4963EE407)


def seeds(each: np.ndarray, size: int = SEED) -> np.ndarray:
    """A 64-bit hash of every `size` consecutive words, from the words' hashes."""
    many = len(each) - size + 1
    total = np.zeros(max(many, 0), np.uint64)
    for turn in range(size if many > 0 else 0):
        total = total * np.uint64(0x9E3779B97F4A7C15) + each[turn : turn + many]
    total ^= total >> np.uint64(31)
    total *= np.uint64(0xD6E8FEB86659FD93)
    return total ^ total >> np.uint64(32)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every `width` neighbours, by doubling spans."""
    span = 1
    while span * 2 <= width:
        values = np.minimum(values[:-span], values[span:])
        span *= 2
    return np.minimum(values[: len(values) - width + span], values[width - span :]) if span < width else values


def runs(words: Words, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The super-k-mers of texts: first word, number of windows, minimiser (signed)."""
    many = len(words.text) - window + 1
    if many <= 0:
        return (np.zeros(0, np.int64),) * 3
    size = min(SEED, window)
    least = sliding_min(seeds(words.hashes(), size), window - size + 1)
    at = np.flatnonzero(words.text[:many] == words.text[window - 1 :])  # windows within one text
    least, text = least[at], words.text[at]
    cuts = np.flatnonzero((least[1:] != least[:-1]) | (text[1:] != text[:-1])) + 1
    begin = np.concatenate(([0], cuts)) if len(at) else np.zeros(0, np.int64)
    count = np.diff(np.concatenate((begin, [len(at)]))) if len(at) else begin
    parts = -(-count // LONGEST)
    within = (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)) * LONGEST
    begin, count = np.repeat(begin, parts) + within, np.minimum(np.repeat(count, parts) - within, LONGEST)
    return at[begin], count, least[begin].view(np.int64)


def _runs(window: int):
    """The super-k-mers of each text, without their words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = Words(part.column(2).to_pylist())
                start, count, minimiser = runs(words, window)
                text = words.text[start]
                key, mark = (part.column(i).take(pa.array(text)) for i in (0, 1))
                inside = (start - words.firsts[text]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [key, mark, pa.array(minimiser), pa.array(inside), pa.array(count.astype(np.int32))],
                    ["key", "mark", "minimiser", "start", "count"],
                )
        pa.default_memory_pool().release_unused()

    return run


def _packed(window: int):
    """The asked super-k-mers of each text as packed strings with their bucket and piece."""
    names = ["minimiser", "piece", "split", "key", "mark", "start", "string"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch):
                words = Words(part.column(3).to_pylist())
                asked = part.column(4)
                sizes = pc.list_value_length(asked).to_numpy()
                minimiser, pieces, start, count = (x.to_numpy() for x in asked.flatten().flatten())
                text = np.repeat(np.arange(part.num_rows), sizes)
                piece = (part.column(2).to_numpy()[text] % pieces).astype(np.int32)
                first = words.firsts[text] + start
                begin, end = words.starts[first], words.ends[first + count + window - 2]
                key, mark = (part.column(i).take(pa.array(text)) for i in (0, 1))
                for at in range(0, len(text), BATCH):
                    some = slice(at, at + BATCH)
                    strings = [words.joined[a:b] for a, b in zip(begin[some].tolist(), end[some].tolist())]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(minimiser[some]), pa.array(piece[some]), pa.array(pieces[some] > 1), key[some],
                         mark[some], pa.array(start[some].astype(np.int64)), pa.array(strings, pa.binary())],
                        names,
                    )
        pa.default_memory_pool().release_unused()

    return run


def settle(rows: list[tuple], split: bool, window: int = WINDOW) -> tuple[list[tuple], list[tuple]]:
    """What one piece of a bucket tells. `rows` are (key, mark, first word, packed string).

    Returns ranges of repeated words (key, mark, from, to), and, if the bucket was `split`,
    one or more rows a different window (key, mark, from, to, digest, digest) whose key is the
    least of this piece.
    """
    found, left = [], []
    members = defaultdict(list)
    for key, mark, start, string in rows:
        members[string].append((key, mark, start))
    if not split and (len(rows) == 1 or len({row[0] for row in rows}) == 1):
        return found, left
    windows = []
    opened = []  # strings in their least document: first key, places, words
    for string, places in members.items():
        least = min(place[0] for place in places)
        size = string.count(b" ") + 1
        found.extend((key, mark, start, start + size) for key, mark, start in places if key > least)
        if not split and len(members) == 1:
            continue
        own = [(mark, start) for key, mark, start in places if key == least]
        ends = [i for i, byte in enumerate(string) if byte == 32] + [len(string)]
        begins = [0, *(end + 1 for end in ends[:-1])]
        number = len(opened)
        opened.append((least, own, []))
        windows.extend(
            (string[a:b], least, number, i) for i, (a, b) in enumerate(zip(begins, ends[window - 1 :]))
        )
    windows.sort()
    same, first = None, None
    for content, key, number, i in windows:
        if content != same:
            same, first = content, key
            digest = xxhash.xxh3_128_intdigest(content) if split else 0
        if key > first:
            opened[number][2].append(i)
        elif split:
            halves = (digest >> 64) - (1 << 63), (digest & (1 << 64) - 1) - (1 << 63)
            left.extend((key, mark, start + i, start + i + window, *halves) for mark, start in opened[number][1])
    for key, own, repeated in opened:
        if repeated:
            at = np.sort(np.array(repeated))
            cuts = np.flatnonzero(np.diff(at) > 1)
            firsts, lasts = at[np.concatenate(([0], cuts + 1))], at[np.concatenate((cuts, [len(at) - 1]))]
            for a, b in zip(firsts.tolist(), lasts.tolist()):
                found.extend((key, mark, start + a, start + b + window) for mark, start in own)
    return found, left


def _settled(window: int, piece: int, names: list[str], key_type: pa.DataType):
    """Rows sorted by bucket and piece in; ranges and open windows out."""

    def out(found: list[tuple], left: list[tuple]) -> pa.RecordBatch:
        rows = [(*row, None, None) for row in found] + left
        kinds = (key_type, *[pa.int64()] * 5)
        columns = zip(*rows) if rows else [[]] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.RecordBatch | None = None
        cut: tuple | None = None  # the bucket of which a piece was settled before
        found: list[tuple] = []
        left: list[tuple] = []

        def settle_rows(rows: pa.RecordBatch, begin: int, end: int, split: bool) -> None:
            part = rows.slice(begin, end - begin)
            split = split or part.column(2)[0].as_py()
            told = settle(list(zip(*(part.column(i).to_pylist() for i in (3, 4, 5, 6)))), split, window)
            found.extend(told[0])
            left.extend(told[1])

        for batch in batches:
            rows = pa.concat_batches([held, batch]) if held is not None else batch
            if not rows.num_rows:
                continue
            bucket = list(zip(*(rows.column(i).to_pylist() for i in (0, 1)))).__getitem__
            name, number = (rows.column(i).to_numpy() for i in (0, 1))
            starts = np.flatnonzero((name[1:] != name[:-1]) | (number[1:] != number[:-1])) + 1
            starts = np.concatenate(([0], starts))
            sizes = np.diff(np.concatenate((starts, [rows.num_rows])))
            # Lone strings need no look, unless they are of a split bucket. The last bucket may
            # go on in the next batch.
            told = (sizes > 1) | rows.column(2).to_numpy(zero_copy_only=False)[starts]
            told[0] |= cut is not None
            for begin, size in zip(starts[:-1][told[:-1]].tolist(), sizes[:-1][told[:-1]].tolist()):
                split = size > piece or cut == bucket(begin)
                for at in range(begin, begin + size, piece):
                    settle_rows(rows, at, min(at + piece, begin + size), split)
            begin = int(starts[-1])
            while rows.num_rows - begin > piece:
                cut = bucket(begin)
                settle_rows(rows, begin, begin + piece, True)
                begin += piece
            if cut is not None and cut != bucket(begin):
                cut = None
            held = rows.slice(begin)
            if found or left:
                yield out(found, left)
                found.clear()
                left.clear()
        if held is not None and held.num_rows:
            settle_rows(held, 0, held.num_rows, cut is not None)
            yield out(found, left)

    return run


def shared_runs(texts: DataFrame, window: int, piece: int) -> DataFrame:
    """key, mark, asked: of each text the super-k-mers whose minimiser another key has, too,
    with the number of pieces of the bucket."""
    schema = T.StructType.fromDDL("key int, mark long, minimiser long, start int, count int")
    schema["key"].dataType = texts.schema["key"].dataType
    found = stored(texts.select("key", "mark", "text").mapInArrow(_runs(window), schema), "super_kmers")
    buckets = (
        found.groupBy("minimiser")
        .agg(F.min("key").alias("least"), F.max("key").alias("most"), F.count(F.lit(1)).alias("strings"))
        .where(F.col("least") < F.col("most"))
        .select(F.col("minimiser").alias("name"), F.ceil(F.col("strings") / piece).alias("pieces"))
    )
    # Written first: a join whose sides are both shuffled as they are can be split where a key is hot.
    buckets = stored(buckets, "buckets")
    asked = F.collect_set(F.struct("minimiser", "pieces", "start", "count")).alias("asked")
    return found.join(buckets, F.col("minimiser") == F.col("name")).groupBy("key", "mark").agg(asked)


def repeats(df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, piece: int = PIECE) -> DataFrame:
    """key, mark (xxhash64 of the text), ranges: the [from, to) of words that windows of smaller
    keys repeat, one row a document that has any."""
    texts = df.where(F.col(key).isNotNull() & F.col(text).isNotNull()).select(
        F.col(key).alias("key"), F.xxhash64(text).alias("mark"), F.xxhash64(key).alias("salt"),
        F.col(text).cast("binary").alias("text"),
    )
    kind = texts.schema["key"].dataType
    strings = T.StructType.fromDDL("minimiser long, piece int, split boolean, key int, mark long, start long, string binary")
    ranges = T.StructType.fromDDL("key int, mark long, start long, end long, high long, low long")
    strings["key"].dataType = ranges["key"].dataType = kind
    joined = texts.join(shared_runs(texts, window, piece), ["key", "mark"])
    sent = joined.select("key", "mark", "salt", "text", "asked").mapInArrow(_packed(window), strings)
    dealt = sent.repartition("minimiser", "piece").sortWithinPartitions("minimiser", "piece")
    found = stored(dealt.mapInArrow(_settled(window, piece, ranges.names, to_arrow_type(kind)), ranges), "repeats")
    # Windows of split buckets: a row for each piece, brought together by digest.
    left = found.where(F.col("high").isNotNull())
    least = left.groupBy("high", "low").agg(F.min("key").alias("least"))
    late = left.join(least, ["high", "low"]).where(F.col("key") > F.col("least"))
    every = found.where(F.col("high").isNull()).select("key", "mark", "start", "end")
    every = every.unionAll(late.select("key", "mark", "start", "end"))
    return every.groupBy("key", "mark").agg(F.collect_set(F.struct("start", "end")).alias("ranges"))


def keep_words(words: list[bytes], ranges: list[dict] | None) -> list[bytes]:
    """The words outside all ranges."""
    if not ranges:
        return words
    edge = np.zeros(len(words) + 1, np.int64)
    np.add.at(edge, [r["start"] for r in ranges], 1)
    np.add.at(edge, [r["end"] for r in ranges], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]


def without_repeats(
    df: DataFrame, key: str = "doc_id", text: str = "text", window: int = WINDOW, piece: int = PIECE
) -> DataFrame:
    """`df` with n_words, n_removed and kept, the words that stay joined by one blank."""
    own, mark, spans, data = unused(df, "__key", "__mark", "__ranges", "__data")
    found = repeats(df, key, text, window, piece).select(
        F.col("key").alias(own), F.col("mark").alias(mark), F.col("ranges").alias(spans)
    )
    same = (F.col(key) == F.col(own)) & (F.xxhash64(text) == F.col(mark))
    joined = df.join(found, same, "left").withColumn(data, F.coalesce(F.col(text), F.lit("")).cast("binary"))
    keep = [c for c in df.columns if c not in ("n_words", "n_removed", "kept")]

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        total, gone, kept = [], [], []
        for content, ranges in zip(batch.column(data).to_pylist(), batch.column(spans).to_pylist()):
            words = content.split()
            stay = keep_words(words, ranges)
            total.append(len(words))
            gone.append(len(words) - len(stay))
            kept.append(b" ".join(stay))
        texts = pa.array(kept, pa.binary()).cast(pa.string())
        return {"n_words": pa.array(total, pa.int64()), "n_removed": pa.array(gone, pa.int64()), "kept": texts}

    return with_computed(joined, compute, "n_words long, n_removed long, kept string", keep)
