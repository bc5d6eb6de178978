"""Vector code compression with anchors-hierarchy metric trees over the parts of vectors.

A vector is cut into equal parts, each part becomes the number of the nearest entry of its
position's codebook (product quantization), and codebooks are fitted by k-means on all rows:
each round gives every part to its nearest entry and moves the entries to the means, rounded
down. Distances are squared Euclidean on whole numbers; ties go to the lower entry.

Rows are held in blocks of a bounded number of parts' components. Over each block and part
position a metric tree is built once, middle-out: about sqrt(n) anchors take the points nearest
to them (a point moves to a new anchor only if the triangle inequality does not rule that
out), anchors are merged upwards into the smallest balls around them, and each anchor is split
further in the same way. A ball caches the number and the sum of its points. In a round the
list of candidate entries goes down the tree: a ball drops every entry that is farther from
all its points than another one is, children inherit what is left, and a ball with one entry
left is owned wholly: its cached sum and number go to that entry without a look at its
points. Only leaves with several candidates left compare points.

A task returns one sum and number for each entry, so a round shuffles parts times entries rows
a task; the codebooks are all that is sent to tasks. Blocks are written to the shared scratch
folder once and read in every round.

Rows whose vector is null, or has a null or not finite component, are dropped. Shorter vectors
end in zeros, and so do vectors whose length the number of parts does not divide. The first
codebook comes from the smallest keys (null last, rows of equal key by vector); with fewer
rows it has fewer entries. Entries without parts stay as they are; of equal entries the first
gets all. Repeated rows count as often as they stand there. An empty table gives an empty
one. Scaled components beyond 2^31 count as 2^31; distances are exact while components are
under 2^22. Columns of the input that have the name of a result are replaced.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecrate.llm.common import stored, unused
from tablecrate.llm.vectors import floored, is_whole, matrix, to_long, width

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
BLOCK_CELLS = 1 << 18
LEAF = 64
# Radii are raised by this share, over the rounding of their roots.
SLACK = 1e-9


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distances; exact, since all terms are whole numbers in range."""
    return (points * points).sum(axis=1)[:, None] - 2 * (points @ entries.T) + (entries * entries).sum(axis=1)


def anchors(points: np.ndarray, most: int) -> np.ndarray:
    """The number of the anchor that owns each point: `most` anchors, or fewer if all points
    stand on one."""
    owner = np.zeros(len(points), np.int64)
    pivots = points[:1]
    far = np.sqrt(((points - pivots[0]) ** 2).sum(axis=1))
    while len(pivots) < most:
        new = int(far.argmax())  # the farthest point of the widest anchor
        if far[new] == 0:
            break
        pivot = points[new]
        apart = np.sqrt(((pivots - pivot) ** 2).sum(axis=1))
        # A point nearer to its pivot than half the way to the new one cannot move.
        maybe = np.flatnonzero(far > apart[owner] / 2 * (1 - SLACK))
        away = np.sqrt(((points[maybe] - pivot) ** 2).sum(axis=1))
        nearer = away < far[maybe]
        owner[maybe[nearer]], far[maybe[nearer]] = len(pivots), away[nearer]
        pivots = np.concatenate((pivots, pivot[None]))
    return owner


class Tree:
    """Balls as arrays, root first: centre, radius, sum and number of the points, the span of
    points in `order`, and two children (0: a leaf)."""

    FIELDS = ("points", "order", "centre", "radius", "sums", "span", "children")

    def __init__(self, **arrays: np.ndarray):
        for name in self.FIELDS:
            setattr(self, name, arrays[name])

    def arrays(self) -> dict[str, np.ndarray]:
        return {name: getattr(self, name) for name in self.FIELDS}

    @classmethod
    def build(cls, points: np.ndarray) -> Tree:
        nested = grow(points, np.arange(len(points)))
        order, spans, children = [], [], []
        done = 0
        stack = [(nested, None)]
        while stack:  # left before right, so that every ball is one span
            (rows, below), parent = stack.pop()
            number = len(spans)
            if parent is not None:
                children[parent[0]][parent[1]] = number
            spans.append([done, done + len(rows)])
            children.append([0, 0])
            if below:
                stack.extend(((below[1], (number, 1)), (below[0], (number, 0))))
            else:
                order.append(rows)
                done += len(rows)
        order = np.concatenate(order)
        placed = points[order]
        # Sums of spans from running sums; centres and radii from the points themselves.
        span = np.array(spans, np.int64)
        running = np.concatenate((np.zeros((1, points.shape[1]), np.int64), np.cumsum(placed.astype(np.int64), axis=0)))
        sums = running[span[:, 1]] - running[span[:, 0]]
        centre = sums / (span[:, 1] - span[:, 0])[:, None]
        radius = np.array([np.sqrt(((placed[a:b] - c) ** 2).sum(axis=1).max()) for (a, b), c in zip(spans, centre)])
        return cls(
            points=placed, order=order, centre=centre, radius=radius * (1 + SLACK), sums=sums, span=span,
            children=np.array(children, np.int64),
        )

    def owned(self, entries: np.ndarray, rivals: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray | None]]:
        """(ball, entry, ...) for balls owned wholly, (ball, -1, entries, distances) for leaves
        that several of `rivals` (entry numbers, rising) are left for, from the root down."""
        level, lists = np.zeros(1, np.int64), np.zeros((1, len(entries)), bool)
        lists[:, rivals] = True
        while len(level):
            away = np.sqrt(np.maximum(squared(self.centre[level], entries), 0))
            away = np.where(lists, away, np.inf)
            reach = self.radius[level]
            worst = (away.min(axis=1) + reach) * (1 + SLACK) + SLACK
            lists = lists & (away - reach[:, None] <= worst[:, None])
            alone = lists.sum(axis=1) == 1
            for at in np.flatnonzero(alone):
                yield int(level[at]), int(lists[at].argmax()), None, None
            leaf = self.children[level, 0] == 0
            for at in np.flatnonzero(leaf & ~alone):
                left = np.flatnonzero(lists[at])
                begin, end = self.span[level[at]]
                yield int(level[at]), -1, left, squared(self.points[begin:end], entries[left])
            deeper = ~leaf & ~alone
            level = self.children[level[deeper]].ravel()
            lists = np.repeat(lists[deeper], 2, axis=0)


def grow(points: np.ndarray, rows: np.ndarray) -> tuple:
    """(rows, None) for a leaf, (rows, (left, right)) else; middle-out."""
    if len(rows) <= LEAF:
        return rows, None
    owner = anchors(points[rows], max(2, int(np.sqrt(len(rows)))))
    if not owner.any():
        return rows, None
    balls = [grow(points, rows[owner == number]) for number in range(owner.max() + 1) if (owner == number).any()]
    if len(balls) == 1:
        return rows, None
    centre = np.array([points[r].mean(axis=0) for r, _ in balls])
    radius = np.array([np.sqrt(((points[r] - c) ** 2).sum(axis=1).max()) for (r, _), c in zip(balls, centre)])
    # The two balls whose common ball is smallest become one, until one is left.
    together = np.sqrt(np.maximum(squared(centre, centre), 0)) + radius[:, None] + radius
    np.fill_diagonal(together, np.inf)
    for _ in range(len(balls) - 1):
        a, b = divmod(int(together.argmin()), len(balls))
        joined = np.concatenate((balls[a][0], balls[b][0]))
        balls[a], balls[b] = (joined, (balls[a], balls[b])), None
        centre[a] = points[joined].mean(axis=0)
        radius[a] = np.sqrt(((points[joined] - centre[a]) ** 2).sum(axis=1).max())
        together[b] = together[:, b] = np.inf
        open_ = np.isfinite(together[a])
        open_[b] = False
        apart = np.sqrt(((centre - centre[a]) ** 2).sum(axis=1)) + radius + radius[a]
        together[a] = together[:, a] = np.where(open_, apart, np.inf)
        last = a
    return balls[last]


def distinct(entries: np.ndarray) -> np.ndarray:
    """The numbers of the entries that equal no earlier one, rising."""
    return np.sort(np.unique(entries, axis=0, return_index=True)[1]) if len(entries) else np.zeros(0, np.int64)


def dump(trees: list[Tree]) -> bytes:
    """The trees of one block."""
    target = io.BytesIO()
    np.savez(target, **{f"{name}{i}": a for i, tree in enumerate(trees) for name, a in tree.arrays().items()})
    return target.getvalue()


def load(data: bytes) -> list[Tree]:
    held = np.load(io.BytesIO(data))
    count = len(held.files) // len(Tree.FIELDS)
    return [Tree(**{name: held[f"{name}{i}"] for name in Tree.FIELDS}) for i in range(count)]


def _blocks(columns: int, kept: list[str]):
    """Rows (vector first) in; a row a block out: its trees, and each kept column as a list."""
    rows = max(LEAF, BLOCK_CELLS // max(columns, 1))

    def made(waiting: list[pa.RecordBatch]) -> pa.RecordBatch:
        whole = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
        points = matrix(whole.column(0), columns)
        trees = [Tree.build(part) for part in np.split(points, PARTS, axis=1)]
        lists = [pa.ListArray.from_arrays(pa.array([0, whole.num_rows], pa.int32()), whole.column(c)) for c in kept]
        return pa.RecordBatch.from_arrays([pa.array([dump(trees)], pa.binary()), *lists], ["trees", *kept])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, count = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                waiting.append(batch.slice(at, rows - count))
                at += waiting[-1].num_rows
                count += waiting[-1].num_rows
                if count == rows:
                    yield made(waiting)
                    waiting, count = [], 0
        if count:
            yield made(waiting)

    return run


def _sums(books: list[np.ndarray]):
    """Trees in; for each part and entry the number and the sum of what it owns out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(book.shape, np.int64) for book in books]
        counts = [np.zeros(len(book), np.int64) for book in books]
        rivals = [distinct(book) for book in books]
        for batch in batches:
            for data in batch.column(0):
                for tree, book, left, total, count in zip(load(data.as_py()), books, rivals, sums, counts):
                    for ball, entry, among, away in tree.owned(book, left):
                        begin, end = tree.span[ball]
                        if entry >= 0:
                            total[entry] += tree.sums[ball]
                            count[entry] += end - begin
                        else:
                            owner = among[away.argmin(axis=1)]
                            np.add.at(total, owner, tree.points[begin:end].astype(np.int64))
                            np.add.at(count, owner, 1)
        part = np.repeat(np.arange(len(books)), [len(c) for c in counts])
        entry = np.concatenate([np.arange(len(c)) for c in counts])
        count, flat = np.concatenate(counts), np.concatenate(sums)
        used = count > 0
        offsets = np.arange(used.sum() + 1, dtype=np.int32) * flat.shape[1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part[used]), pa.array(entry[used]), pa.array(count[used]),
             pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat[used].ravel()))],
            ["part", "entry", "count", "sums"],
        )

    return run


def _assigned(books: list[np.ndarray], kept: list[str], code: str, error: str):
    """Trees in; for each row its kept columns, code and error out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rivals = [distinct(book) for book in books]
        for batch in batches:
            for at in range(batch.num_rows):
                trees = load(batch.column(0)[at].as_py())
                rows = len(trees[0].order)
                codes, errors = np.zeros((rows, len(books)), np.uint8), np.zeros(rows)
                for turn, (tree, book, left) in enumerate(zip(trees, books, rivals)):
                    for ball, entry, among, away in tree.owned(book, left):
                        begin, end = tree.span[ball]
                        of = tree.order[begin:end]
                        if entry >= 0:
                            codes[of, turn] = entry
                            errors[of] += squared(tree.points[begin:end], book[entry : entry + 1])[:, 0]
                        else:
                            best = away.argmin(axis=1)
                            codes[of, turn] = among[best]
                            errors[of] += away[np.arange(len(best)), best]
                text = codes.tobytes().hex()
                step = 2 * len(books)
                hexed = [text[i : i + step] for i in range(0, len(text), step)]
                lists = [batch.column(1 + i)[at].values for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays(
                    [*lists, pa.array(hexed, pa.string()), pa.array(to_long(errors))], [*kept, code, error]
                )

    return run


def first_codebooks(rows: DataFrame, key: str, vector: str, columns: int) -> list[np.ndarray]:
    """The parts of the first `ENTRIES` rows by key."""
    first = rows.orderBy(F.col(key).asc_nulls_last(), vector).limit(ENTRIES).select(vector).toArrow()
    values = first.column(0).combine_chunks()
    points = matrix(values, columns) if len(values) else np.zeros((0, columns))
    return np.split(points, PARTS, axis=1)


def fit(blocks: DataFrame, books: list[np.ndarray], rounds: int = ROUNDS) -> list[np.ndarray]:
    """The codebooks after so many rounds over the trees of `blocks`."""
    for _ in range(rounds):
        found = blocks.select("trees").mapInArrow(_sums(books), "part long, entry long, count long, sums array<long>")
        wide = books[0].shape[1]
        totals = found.groupBy("part", "entry").agg(
            F.sum("count").alias("count"), F.array(*(F.sum(F.get("sums", F.lit(i))) for i in range(wide))).alias("sums")
        )
        books = [book.copy() for book in books]
        for row in totals.collect():  # a row an entry
            books[row["part"]][row["entry"]] = [total // row["count"] for total in row["sums"]]
    return books


def compressed(
    df: DataFrame, key: str = "vec_id", vector: str = "embedding", keep: Iterable[str] | None = None,
    scale: int = SCALE, rounds: int = ROUNDS, names: tuple[str, str] = ("code", "error"),
) -> tuple[DataFrame, list[np.ndarray]]:
    """The columns `keep` (default: all) of the rows that take part, with `code` (two hex
    digits a part) and `error` (squared distance to the coded vector); and the codebooks."""
    kept = [c for c in (df.columns if keep is None else keep) if c not in names]
    held, name = unused(df, "__vector", "__key")
    rows = df.where(is_whole(F.col(vector))).select(
        floored(F.col(vector), scale).alias(held), *kept, F.col(key).alias(name)
    )
    rows = stored(rows, "scaled")
    columns = -(-max(width(rows, held), 1) // PARTS) * PARTS
    fields = {f.name: f.dataType for f in rows.schema.fields}
    # Columns by number inside, so that no name clashes.
    inside = [f"c{i}" for i in range(len(kept))]
    numbered = rows.select(held, *kept).toDF("vector", *inside)
    lists = T.StructType([T.StructField("trees", T.BinaryType())] + [T.StructField(i, T.ArrayType(fields[c])) for i, c in zip(inside, kept)])
    blocks = stored(numbered.mapInArrow(_blocks(columns, inside), lists), "trees")
    books = fit(blocks, first_codebooks(rows, name, held, columns), rounds)
    coded = T.StructType(
        [T.StructField(i, fields[c]) for i, c in zip(inside, kept)]
        + [T.StructField("code", T.StringType()), T.StructField("error", T.LongType())]
    )
    found = blocks.mapInArrow(_assigned(books, inside, "code", "error"), coded)
    return found.toDF(*kept, *names), books


def codebooks_sha256(books: list[np.ndarray]) -> str:
    """Over all components in decimal, by part, entry and position, comma-joined."""
    return hashlib.sha256(",".join(str(int(x)) for book in books for x in book.ravel()).encode()).hexdigest()
