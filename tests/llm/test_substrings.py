"""Substring dedup against plain Python, also with buckets that are cut into small pieces."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tablecrate.llm import substrings

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def by_hand(rows: list[tuple], window: int) -> list[tuple]:
    """(key, n_words, n_removed, kept) of (key, text) rows, by looking at every window."""
    least: dict[tuple, int] = {}
    split = [(key, SPACE.findall(text or "")) for key, text in rows]
    for key, words in split:
        for i in range(len(words) - window + 1):
            if key is not None:
                name = tuple(words[i : i + window])
                least[name] = min(least.get(name, key), key)
    found = []
    for key, words in split:
        gone = set()
        for i in range(len(words) - window + 1):
            if key is not None and least[tuple(words[i : i + window])] < key:
                gone.update(range(i, i + window))
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        found.append((key, len(words), len(gone), kept))
    return found


def texts(seed: int) -> list[tuple]:
    rnd = random.Random(seed)
    word = lambda: rnd.choice(["a", "bb", "water", "über", "extraordinarily", "日本語の", "x" * 40]) + str(rnd.randint(0, 30))
    passage = [word() for _ in range(70)]
    rows = []
    for i in range(60):
        own = [word() for _ in range(rnd.randint(0, 60))]
        some = passage if i % 3 else passage[rnd.randint(0, 30) :]
        rows.append((i, rnd.choice([" ", "\n", " \t"]).join([*own, *some, *(word() for _ in range(rnd.randint(0, 30)))])))
    rows += [
        (100, None), (101, ""), (102, " \n\x0b\x0c "), (103, "spam " * 400), (104, "spam " * 120), (105, "a b " * 150),
        (None, " ".join(passage)), (7, rows[7][1]), (7, rows[8][1]), (106, rows[20][1]), (-3, rows[21][1] + "\xa0x"),
    ]
    return rows


@pytest.mark.parametrize("window, piece", [(50, substrings.PIECE), (50, 3), (12, 2), (4, 5)])
def test_against_every_window(base_spark, window, piece):
    rows = texts(window)
    df = base_spark.createDataFrame([(k, t, 1, "x") for k, t in rows], "doc_id long, text string, n_words int, key string")
    found = substrings.without_repeats(df, window=window, piece=piece)
    assert found.columns == ["doc_id", "text", "key", "n_words", "n_removed", "kept"]
    found = [(r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in found.collect()]
    assert sorted(found, key=str) == sorted(by_hand(rows, window), key=str)


def test_hot_minimisers_are_dealt_by_document(base_spark):
    rows = [(i, 0, (" ".join(f"own{i}x{j}" for j in range(80)) + " " + " ".join(f"p{j}" for j in range(60))).encode()) for i in range(50)]
    df = base_spark.createDataFrame(rows, "key long, mark long, text binary")
    found = substrings.shared_runs(df, 50, 10).collect()
    assert len(found) == 50 and all(run["pieces"] == 5 for r in found for run in r["asked"])
    # Runs that stand among words of the document's own alone are not asked for.
    assert all(run["start"] + run["count"] + 49 > 80 for r in found for run in r["asked"])
    assert substrings.shared_runs(df.limit(1), 50, 10).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text("ab \n\tcé", max_size=60), max_size=5), st.integers(1, 9))
def test_runs_cover_each_window_once(parts, window):
    words = substrings.Words([p.encode() for p in parts])
    expected = [SPACE.findall(p) for p in parts]
    got = [[] for _ in parts]
    for text, a, b in zip(words.text, words.starts, words.ends):
        got[text].append(words.joined[a:b].decode())
    assert got == expected
    start, count, minimiser = substrings.runs(words, window)
    seen = [int(s) + i for s, c in zip(start, count) for i in range(c)]
    assert seen == [i for i in range(len(words.text) - window + 1) if words.text[i] == words.text[i + window - 1]]
    # Equal windows have equal minimisers.
    names: dict[tuple, int] = {}
    every = [w for part in expected for w in part]
    for s, c, m in zip(start, count, minimiser):
        for i in range(s, s + c):
            assert names.setdefault(tuple(every[i : i + window]), m) == m
    assert (count <= substrings.LONGEST).all()


def test_sliding_min():
    values = np.random.default_rng(1).integers(0, 99, 40)
    for width in (1, 2, 3, 7, 8, 40):
        assert substrings.sliding_min(values, width).tolist() == [min(values[i : i + width]) for i in range(41 - width)]
