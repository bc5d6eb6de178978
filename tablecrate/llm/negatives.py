"""Hard-negative mining with lists shared by clusters of anchors.

A score is the inner product of an anchor's and a candidate's components, each scaled and
rounded down to whole numbers. An anchor's positives are the best candidates of its label; a
positive's hard negatives are the best candidates of other labels whose score lies between
`low` and `high` hundredths of the positive's.

Anchors are clustered by direction and cut into groups of similar ones, each with the largest
angle `spread` between its centre and a member. With t the angle between the centre and a
candidate, no member is nearer to that candidate than t - spread, so its score is at most
|member| |candidate| cos(max(0, t - spread)). Candidates are sorted by that bound once a
group, and all members walk the same list. A member is done as soon as the bound lies under
the last score it holds, which certifies that nothing further down counts.

Anchors are taken in panels of `PANEL_CELLS` components (16,384 anchors of width 64), the only
thing that is sent to every task. For a panel each task reads its part of the candidates in
blocks, carries what the members hold from block to block and returns at the end, at most, as
many rows as a member may hold. Work is anchors times candidates at worst, as for random
directions, and shrinks with how well directions cluster. No rows are joined or shuffled but
those returned.

Rows without label or vector, or with a component that is null or not finite, take no part.
Shorter vectors end in zeros. Ties go to the smaller key, a null key is the last and never an
anchor. Rows of an anchor's own key are not its positives. Repeated rows count as often as
they stand there, repeated anchors give their rows again. Scores are exact below 2^53;
scaled components beyond 2^31 count as 2^31. An empty table, or one without anchors, gives an
empty one. Keys and labels are integers; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablecrate.llm.common import stored
from tablecrate.llm.vectors import floored, is_whole, matrix, to_long, width
from tablecrate.operators.numbering import with_positions
from tablecrate.session import scratch_dir

PANEL_CELLS = 1 << 20
GROUP = 128
# Candidates of one sorted list, and those of it scored at a time.
LIST_CELLS = 1 << 19
STEP = 512
# Directions of anchors from which the centres of clusters are fitted, at most.
SAMPLE = 4_096
MOST_CLUSTERS = 128
ROUNDS = 4
LAST = np.iinfo(np.int64).max  # stands for a null key
# Bounds are raised by this share, well over the rounding of their cosines.
SLACK = 1e-9


def directions(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors (zero for zero) and lengths."""
    length = np.sqrt((vectors * vectors).sum(axis=1))
    return vectors / np.where(length > 0, length, 1)[:, None], length


def fit_centres(vectors: np.ndarray, clusters: int) -> np.ndarray:
    """Directions of clusters by spherical k-means, started at evenly spaced rows."""
    unit, _ = directions(vectors)
    centres = unit[np.linspace(0, len(unit) - 1, clusters).astype(int)]
    for _ in range(ROUNDS):
        owner = (unit @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, owner, unit)
        moved, length = directions(sums)
        centres = np.where(length[:, None] > 0, moved, centres)
    return centres


@dataclass
class Group:
    """Similar anchors: their places in the panel, vectors, lengths and labels."""

    places: np.ndarray
    vectors: np.ndarray
    lengths: np.ndarray
    labels: np.ndarray
    keys: np.ndarray
    centre: np.ndarray
    spread: float


def grouped(vectors: np.ndarray, labels: np.ndarray, keys: np.ndarray, clusters: np.ndarray) -> list[Group]:
    """The groups of a panel, whose anchors come cluster by cluster."""
    unit, length = directions(vectors)
    cuts = np.flatnonzero(np.diff(clusters)) + 1
    found = []
    for cluster in np.split(np.arange(len(keys)), cuts):
        for at in range(0, len(cluster), GROUP):
            some = cluster[at : at + GROUP]
            centre, _ = directions(unit[some].sum(axis=0, keepdims=True))
            held = length[some] > 0
            cosines = np.clip(unit[some][held] @ centre[0], -1, 1)
            spread = float(np.arccos(cosines.min(initial=1.0)))
            found.append(Group(some, vectors[some], length[some], labels[some], keys[some], centre[0], spread))
    return found


def shared_list(group: Group, unit: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Candidates by falling bound, and the bounds for a member of length 1."""
    angle = np.arccos(np.clip(unit @ group.centre, -1, 1))
    bound = length * np.cos(np.maximum(angle - group.spread, 0.0))
    bound += np.abs(length) * SLACK
    order = np.argsort(-bound, kind="stable")
    return order, bound[order]


class Held:
    """The best scores and keys each slot (an anchor, or an anchor's positive) holds so far."""

    def __init__(self, slots: int, most: int):
        self.scores = np.full((slots, most), -np.inf)
        self.keys = np.full((slots, most), LAST)

    def add(self, slot: np.ndarray, score: np.ndarray, key: np.ndarray) -> None:
        if not len(slot):
            return
        most = self.scores.shape[1]
        touched = np.unique(slot)
        slot = np.concatenate((slot, np.repeat(touched, most)))
        score = np.concatenate((score, self.scores[touched].ravel()))
        key = np.concatenate((key, self.keys[touched].ravel()))
        order = np.lexsort((key, -score, slot))
        slot, score, key = slot[order], score[order], key[order]
        first = np.flatnonzero(np.concatenate(([True], slot[1:] != slot[:-1])))
        rank = np.arange(len(slot)) - np.repeat(first, np.diff(np.concatenate((first, [len(slot)]))))
        best = rank < most
        self.scores[slot[best], rank[best]] = score[best]
        self.keys[slot[best], rank[best]] = key[best]

    def rows(self) -> pa.RecordBatch:
        slot, rank = np.nonzero(self.scores > -np.inf)
        key = self.keys[slot, rank]
        return pa.RecordBatch.from_arrays(
            [pa.array(slot), pa.array(to_long(self.scores[slot, rank])), pa.array(key, mask=key == LAST)],
            ["slot", "score", "key"],
        )


def walk(
    group: Group, vectors: np.ndarray, labels: np.ndarray, keys: np.ndarray, listed: tuple[np.ndarray, np.ndarray],
    bands: tuple[np.ndarray, np.ndarray] | None, held: Held,
) -> int:
    """All members of a group down their list; how many scores were taken.

    Without `bands` a member has one slot, for candidates of its label. Bands are the least
    and the largest score of each slot, a row a place of the panel, for other labels.
    """
    order, bounds = listed
    each = 1 if bands is None else bands[0].shape[1]
    slots = group.places[:, None] * each + np.arange(each)
    least = np.full(slots.shape, -np.inf) if bands is None else bands[0][group.places]
    most = None if bands is None else bands[1][group.places]
    taken = 0
    for at in range(0, len(order), STEP):
        floor = np.maximum(held.scores[slots, -1], least)  # a candidate under it counts no more
        reach = bounds[at] * group.lengths
        going = np.flatnonzero((reach[:, None] >= floor).any(axis=1))
        if not len(going):
            break
        some = order[at : at + STEP]
        scores = group.vectors[going] @ vectors[some].T
        taken += scores.size
        same = group.labels[going][:, None] == labels[some]
        if bands is None:
            other = group.keys[going][:, None] != keys[some]
            member, column = np.nonzero(same & other & (scores >= floor[going]))
            held.add(slots[going, 0][member], scores[member, column], keys[some][column])
            continue
        scores[same] = np.nan
        for turn in range(each):
            inside = (scores >= floor[going, turn][:, None]) & (scores <= most[going, turn][:, None])
            member, column = np.nonzero(inside)
            held.add(slots[going, turn][member], scores[member, column], keys[some][column])
    return taken


def _walked(groups: list[Group], columns: int, slots: int, most: int, bands: tuple[np.ndarray, np.ndarray] | None):
    """Candidates in, what each slot holds of them out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = Held(slots, most)
        rows = max(STEP, LIST_CELLS // max(columns, 1))
        waiting: list[pa.RecordBatch] = []
        count = 0

        def block() -> None:
            whole = pa.Table.from_batches(waiting).combine_chunks().to_batches()[0]
            keys = whole.column(0).fill_null(LAST).to_numpy(zero_copy_only=False)
            labels, vectors = whole.column(1).to_numpy(), matrix(whole.column(2), columns)
            unit, length = directions(vectors)
            for group in groups:
                walk(group, vectors, labels, keys, shared_list(group, unit, length), bands, held)

        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                waiting.append(batch.slice(at, rows))
                count += waiting[-1].num_rows
                if count >= rows:
                    block()
                    waiting, count = [], 0
        if count:
            block()
        yield held.rows()

    return run


def _best(walked: DataFrame, most: int) -> DataFrame:
    """The first rows of each slot over all tasks, numbered from 1."""
    place = Window.partitionBy("slot").orderBy(F.col("score").desc(), F.col("key").asc_nulls_last())
    return walked.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= most)


def hard_negatives(
    df: DataFrame, anchors: Column, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    scale: int = 256, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: the `negatives`
    best of each of the `positives` best candidates of each row where `anchors` holds."""
    spark = df.sparkSession
    rows = df.where(F.col(label).isNotNull() & is_whole(F.col(vector))).select(
        F.col(key).cast("long").alias("key"), F.col(label).cast("long").alias("label"),
        floored(F.col(vector), scale).alias("vector"),
        F.coalesce(anchors & F.col(key).isNotNull(), F.lit(False)).alias("anchor"),
    )
    rows = stored(rows, "candidates")
    columns = width(rows, "vector")
    chosen = rows.where("anchor").select("key", "label", "vector")
    count = chosen.count()
    result = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    path = scratch_dir(spark, "hard_negatives")
    spark.createDataFrame([], result).write.parquet(f"{path}/panel=-1")
    panels = _panels(chosen, count, columns) if count else None
    size = max(GROUP, PANEL_CELLS // max(columns, 1))
    candidates = rows.select("key", "label", "vector")
    for number in range(-(-count // size)):
        panel = panels.where((F.col("position") >= number * size) & (F.col("position") < (number + 1) * size))
        held = panel.orderBy("position").toArrow()
        keys, labels, clusters = (held.column(c).to_numpy() for c in ("key", "label", "cluster"))
        groups = grouped(matrix(held.column("vector").combine_chunks(), columns), labels, keys, clusters)

        schema = "slot long, score long, key long"
        first = candidates.mapInArrow(_walked(groups, columns, len(keys), positives, None), schema)
        best = _best(first, positives).orderBy("slot", "rank").toArrow()  # bounded by the panel
        slot, rank, score = (best.column(c).to_numpy() for c in ("slot", "rank", "score"))
        at = slot * positives + rank - 1
        # Whole-number bounds of low * p <= 100 n <= high * p; no positive, no band.
        least, most = np.full(len(keys) * positives, np.inf), np.full(len(keys) * positives, -np.inf)
        least[at] = [-(-low * int(p) // 100) for p in score]
        most[at] = [high * int(p) // 100 for p in score]
        least[least > most] = np.inf
        bands = least.reshape(-1, positives), most.reshape(-1, positives)
        second = candidates.mapInArrow(_walked(groups, columns, len(least), negatives, bands), schema)
        named = pa.table(
            {"of": pa.array(at), "anchor_id": pa.array(keys[slot]), "positive_id": best.column("key"), "positive_score": pa.array(score)}
        )
        found = _best(second, negatives).join(F.broadcast(spark.createDataFrame(named)), F.col("slot") == F.col("of"))
        found = found.select(
            "anchor_id", "positive_id", "rank", F.col("key").alias("negative_id"), "positive_score",
            F.col("score").alias("negative_score"),
        )
        found.write.parquet(f"{path}/panel={number}")
    return spark.read.schema(f"{result}, panel int").parquet(path).drop("panel")


def _panels(chosen: DataFrame, count: int, columns: int) -> DataFrame:
    """The anchors, numbered cluster by cluster and outwards from each centre."""
    some = chosen.orderBy(F.xxhash64("key"), "key").limit(SAMPLE).select("vector").toArrow()
    clusters = max(1, min(MOST_CLUSTERS, count // GROUP))
    centres = fit_centres(matrix(some.column(0).combine_chunks(), columns), clusters)

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            unit, _ = directions(matrix(batch.column(2), columns))
            cosines = unit @ centres.T
            cluster = cosines.argmax(axis=1) if len(unit) else np.zeros(0, np.int64)
            cosine = cosines[np.arange(len(unit)), cluster]
            made = [pa.array(cluster.astype(np.int32)), pa.array(cosine)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], ["key", "label", "vector", "cluster", "cosine"])

    made = chosen.mapInArrow(assigned, "key long, label long, vector array<double>, cluster int, cosine double")
    order = [F.col("cluster"), F.col("cosine").desc(), F.col("key")]
    return with_positions(made, "position", order)
