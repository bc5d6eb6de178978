"""Near-duplicates at a Jaccard similarity of 0.8 against every pair."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tablecrate.llm import similar
from test_queries_brute import classes

ASCII = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def set_by_hand(text: str | None) -> tuple:
    words = (text or "").translate(ASCII).replace("\x0b", " ").replace("\x0c", " ")
    for space in "\t\n\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return ()
    return tuple(sorted({" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}))


def alike(a: tuple, b: tuple) -> bool:
    common = len(set(a) & set(b))
    return 5 * common >= 4 * (len(a) + len(b) - common)


def kept(spark, rows: list[tuple]) -> list[tuple]:
    df = spark.createDataFrame(rows, "id long, text string, node string, held int").repartition(3)
    numbered = df.withColumn("place", F.monotonically_increasing_id())
    path = f"{spark.conf.get('test.tmp')}/{random.random()}"
    numbered.write.parquet(path)
    numbered = spark.read.parquet(path)
    found = similar.first_of_each(numbered, F.struct("id", "place"), "place")
    return sorted(r["first"]["id"] for r in found.collect())


@pytest.fixture
def spark(base_spark, tmp_path):
    base_spark.conf.set("test.tmp", str(tmp_path))
    yield base_spark
    base_spark.conf.unset("test.tmp")


def edited(rnd: random.Random, words: list[str], times: int) -> str:
    words = list(words)
    for _ in range(times):
        words[rnd.randrange(len(words))] = f"new{rnd.randrange(10**9)}"
    return " ".join(words)


def test_every_pair(spark):
    rnd = random.Random(5)
    rows = []
    for group in range(60):
        words = [f"w{rnd.randrange(3000)}" for _ in range(rnd.choice((12, 40, 200, 900)))]
        rows.append((len(rows), " ".join(words)))
        for _ in range(rnd.randrange(4)):  # from nearly equal to well below the similarity
            rows.append((len(rows), edited(rnd, words, max(1, int(len(words) * rnd.uniform(0, 0.05))))))
    rows += [(len(rows) + i, t) for i, t in enumerate([None, "", " \t", "One", "one", "one two three four five", "İx a b c d"])]
    rows += [(len(rows) + i, rows[0][1].upper()) for i in range(30)]
    sets = {i: set_by_hand(t) for i, t in rows}
    root = classes(sorted(set(sets.values())), alike)
    firsts = {}
    for i, found in sets.items():
        firsts.setdefault(root[found], i)
    pairs = sum(alike(a, b) for a in set(sets.values()) for b in set(sets.values())) - len(set(sets.values()))
    assert pairs > 40
    assert kept(spark, [(i, t, "mine", 1) for i, t in rows]) == sorted(firsts.values())


def test_a_crowd_of_near_copies_is_one(spark):
    """Each near the original, in every band that any of them shares."""
    rnd = random.Random(6)
    words = [f"w{i}" for i in range(400)]
    rows = [(i, edited(rnd, words, 4), None, None) for i in range(400)] + [(900, "something else entirely, of its own", None, None)]
    assert kept(spark, rows) == [0, 900]


def test_no_rows(spark):
    assert kept(spark, []) == []


def test_wide_signatures_find_pairs_at_the_threshold():
    """Odds by bands at a similarity of 0.8, over 300 pairs of sets."""
    import numpy as np

    rnd = np.random.default_rng(3)
    met = 0
    for _ in range(300):
        values = rnd.integers(0, 1 << 64, 100, np.uint64)  # 80 shared of 100
        met += any(x == y for x, y in zip(similar.bands(np.sort(values[:90])), similar.bands(np.sort(values[10:]))))
    assert met >= 297


def test_links_inside_a_crowd(spark):
    """Pairs at the threshold whose every band is also one of texts that are like neither."""
    rnd = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    texts = []
    for _ in range(200):
        one = edited(rnd, words, 8)
        texts += [one, edited(rnd, one.split(), 6)]
    sets = [set_by_hand(t) for t in texts]
    root = classes(sorted(set(sets)), alike)
    firsts = {}
    for i, found in enumerate(sets):
        firsts.setdefault(root[found], i)
    assert len(firsts) == 200
    assert kept(spark, [(i, t, None, None) for i, t in enumerate(texts)]) == sorted(firsts.values())


def test_points_meet_at_the_threshold():
    """Every pair, of any sizes, as far apart as the similarity allows."""
    import numpy as np

    rnd = np.random.default_rng(4)
    for a in [*range(1, 400), 818, 819, 1023, 1024, 1279, 1280, 4096, 5119, 5120, 9000]:
        for b in {a, (a + a * 5 // 4) // 2, a * 5 // 4}:
            common = -(-4 * (a + b) // 9)
            if common > a:
                continue
            values = rnd.integers(0, 1 << 64, a + b - common, np.uint64)
            x, y = np.sort(values[:a]), np.sort(values[a - common :])
            assert (x == y).all() if a == b == common else set(similar.points(x)) & set(similar.points(y))
            unlike = np.bitwise_count((similar.parities(x) ^ similar.parities(y)).view(np.uint64)).sum()
            assert unlike <= a + b - 2 * common
