"""Hard negatives and vector codes against plain numpy."""

from __future__ import annotations

import numpy as np
import pytest

from tablecrate.llm import codes, negatives, vectors


def clustered(rng, rows: int, columns: int, clusters: int, noise: float) -> np.ndarray:
    centres = rng.normal(0, 200, (clusters, columns))
    return np.floor(centres[rng.integers(0, clusters, rows)] + rng.normal(0, noise, (rows, columns)))


@pytest.mark.parametrize("noise, clusters", [(5, 8), (80, 3), (400, 1)])
def test_walk_ends_with_the_right_rows(noise, clusters):
    rng = np.random.default_rng(int(noise))
    data = clustered(rng, 3000, 12, clusters, noise)
    data[::97] = 0
    keys, labels = rng.permutation(3000), rng.integers(0, 4, 3000)
    some = np.sort(rng.choice(3000, 60, replace=False))
    order = some[np.argsort(negatives.directions(data[some])[0] @ data[0])]
    groups = negatives.grouped(data[order], labels[order], keys[order], np.zeros(60, int))
    held = negatives.Held(60, 5)
    taken = 0
    unit, length = negatives.directions(data)
    for part in (slice(0, 1700), slice(1700, None)):  # members keep what they hold between blocks
        for group in groups:
            listed = negatives.shared_list(group, unit[part], length[part])
            # The bound is one: no member scores more.
            reach = listed[1] * group.lengths[:, None]
            assert (group.vectors @ data[part][listed[0]].T <= reach + 1e-6).all()
            taken += negatives.walk(group, data[part], labels[part], keys[part], listed, None, held)
    for place, row in enumerate(order):
        fits = np.flatnonzero((labels == labels[row]) & (keys != keys[row]))
        scores = data[fits] @ data[row]
        best = np.lexsort((keys[fits], -scores))[:5]
        assert held.scores[place].tolist() == scores[best].tolist()
        assert held.keys[place].tolist() == keys[fits][best].tolist()
    if noise == 5:
        assert taken < 0.6 * 60 * 3000  # certified before the end of the list


def by_hand(keys, data, labels, is_anchor, positives=5, count=3, low=50, high=95) -> list[tuple]:
    found = []
    last = lambda k: (k is None, k or 0)
    for i in np.flatnonzero(is_anchor):
        scores = [int(x) for x in data @ data[i]]
        others = [j for j in range(len(keys)) if keys[j] != keys[i]]
        ranked = sorted(others, key=lambda j: (-scores[j], last(keys[j])))
        for p in [j for j in ranked if labels[j] == labels[i]][:positives]:
            fits = [j for j in ranked if labels[j] != labels[i] and low * scores[p] <= 100 * scores[j] <= high * scores[p]]
            found += [(keys[i], keys[p], rank, keys[n], scores[p], scores[n]) for rank, n in enumerate(fits[:count], 1)]
    return found


def test_hard_negatives_over_several_panels(base_spark, monkeypatch):
    monkeypatch.setattr(negatives, "PANEL_CELLS", 8 * 40)
    monkeypatch.setattr(negatives, "GROUP", 20)
    rng = np.random.default_rng(3)
    data = clustered(rng, 600, 8, 5, 60) / 256
    rows = [(i, [float(x) for x in v], int(rng.integers(0, 5)), "x") for i, v in enumerate(data)]
    rows += [(None, rows[0][1], 1, "x"), (600, rows[0][1][:5], 2, "y"), (601, [], 3, "z"), (4, rows[4][1], 2, "repeated")]
    df = base_spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, score string").repartition(3)
    from pyspark.sql import functions as F

    found = negatives.hard_negatives(df, F.col("vec_id") % 4 == 0)
    keys = [r[0] for r in rows]
    whole = np.array([np.floor(256 * np.array(r[1] + [0.0] * (8 - len(r[1])))) for r in rows])
    expected = by_hand(keys, whole, [r[2] for r in rows], [k is not None and k % 4 == 0 for k in keys])
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)
    none = negatives.hard_negatives(df, F.col("vec_id") < 0)
    assert none.collect() == [] and none.columns == found.columns


@pytest.mark.parametrize("noise", [3, 60, 500])
def test_trees_own_the_nearest(noise):
    rng = np.random.default_rng(noise)
    points = clustered(rng, 1500, 4, 30, noise)
    points[100:600] = points[100]  # a third stands on one point
    entries = np.concatenate((points[:40], points[5:9]))  # with equal entries
    tree = codes.Tree.build(points)
    assert sorted(tree.order) == list(range(1500)) and (points[tree.order] == tree.points).all()
    for centre, radius, sums, (a, b), (left, right) in zip(tree.centre, tree.radius, tree.sums, tree.span, tree.children):
        assert (np.sqrt(((tree.points[a:b] - centre) ** 2).sum(axis=1)) <= radius + 1e-9).all()
        assert (tree.points[a:b].sum(axis=0) == sums).all()
        if left:
            assert tree.span[left][0] == a and tree.span[left][1] == tree.span[right][0] and tree.span[right][1] == b
    owner = np.full(1500, -1)
    wholly = 0
    for ball, entry, among, away in tree.owned(entries, codes.distinct(entries)):
        a, b = tree.span[ball]
        owner[a:b] = entry if entry >= 0 else among[away.argmin(axis=1)]
        wholly += (b - a) * (entry >= 0)
    nearest = ((tree.points[:, None] - entries) ** 2).sum(axis=2).argmin(axis=1)
    assert (owner == nearest).all()
    assert wholly >= (700 if noise == 3 else 500)
    again = codes.load(codes.dump([tree, tree]))
    assert len(again) == 2 and (again[1].sums == tree.sums).all()


def test_anchors_on_one_point():
    assert codes.anchors(np.ones((9, 3)), 4).tolist() == [0] * 9


def kmeans_by_hand(points: np.ndarray, first: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    book = first.copy()
    for turn in range(rounds + 1):
        away = ((points[:, None] - book) ** 2).sum(axis=2)
        owner = away.argmin(axis=1)
        if turn < rounds:
            for entry in np.unique(owner):
                mine = points[owner == entry]
                book[entry] = mine.sum(axis=0) // len(mine)
    return owner, away.min(axis=1), book


def test_codes_by_hand(base_spark, monkeypatch):
    monkeypatch.setattr(codes, "BLOCK_CELLS", 200 * 8)
    rng = np.random.default_rng(8)
    data = np.round(clustered(rng, 900, 7, 40, 30) / 1000, 3)
    keys = [int(k) for k in rng.permutation(900)]
    rows = [(k, [float(x) for x in v], f"t{k % 3}", 1) for k, v in zip(keys, data)]
    odd = [(901, None, "t", 1), (902, [None], "t", 1), (903, [float("nan")], "t", 1), (904, [-float("inf")], "t", 1)]
    df = base_spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, vector string, error int").repartition(3)
    found, books = codes.compressed(df)
    assert found.columns == ["vec_id", "embedding", "vector", "code", "error"]
    whole = np.floor(1024 * np.concatenate((data, np.zeros((900, 1))), axis=1))
    first = whole[np.argsort(keys)][: codes.ENTRIES]
    owners, errors, ends = zip(*(kmeans_by_hand(whole[:, i : i + 2], first[:, i : i + 2], codes.ROUNDS) for i in range(0, 8, 2)))
    assert all((a == b).all() for a, b in zip(books, ends))
    expected = {
        k: ("".join(f"{o[i]:02x}" for o in owners), int(sum(e[i] for e in errors)), f"t{k % 3}") for i, k in enumerate(keys)
    }
    assert {r["vec_id"]: (r["code"], r["error"], r["vector"]) for r in found.collect()} == expected


def test_few_rows_and_huge_components(base_spark):
    rows = [(1, [1e300, 0.0]), (2, [-1e300, 5.0, 2.0]), (2, [0.0])]
    df = base_spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found, books = codes.compressed(df)
    assert [len(b) for b in books] == [3] * 4 and len(codes.codebooks_sha256(books)) == 64
    assert sorted((r["vec_id"], r["error"]) for r in found.collect()) == [(1, 0), (2, 0), (2, 0)]


def test_whole_vectors_only(base_spark):
    from pyspark.sql import functions as F

    rows = [([1.0],), ([],), (None,), ([None],), ([float("nan")],), ([float("inf")],)]
    df = base_spark.createDataFrame(rows, "v array<double>")
    assert [r[0] for r in df.select(vectors.is_whole(F.col("v"))).collect()] == [True, True, False, False, False, False]
