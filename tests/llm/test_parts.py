"""The parts of the operators that small cases show best."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

import corpus_pipeline
from tablecrate.llm import bpe, components, extraction, lempelziv, licenses, linededup, quality, rules, simhash
from tablecrate.llm.common import stored

PATH = corpus_pipeline.TOKENIZER


def test_fragments_join_to_the_whole_word():
    made = bpe.WordBpe(PATH)
    for word in ("thañeá", "a" * 300, "water", "日本語"):
        symbols = "".join(made.letters[b] for b in word.encode())
        whole = tuple(made.symbols(symbols + made.end))
        cut = list(made.cut(symbols))
        assert tuple(s for f in cut for s in f) == whole
        joined = [token for f in cut for token in made.merge(f)]
        assert joined == made.merge_long(whole)


def test_larger_memories_encode_alike_and_less_often(monkeypatch):
    monkeypatch.setattr(bpe, "CHUNKS", 40)
    texts = [" ".join(f"word{i % 50}" for i in range(200)), "thañeá \x1c<|x", None, ""]
    made, found = [], []
    for memory in (1, 3):
        one, times = bpe.WordBpe(PATH, memory), []
        words = one.words
        one.words = lambda chunk, words=words, times=times: times.append(chunk) or words(chunk)
        found.append(one.encode_all(texts).to_pylist())
        made.append(len(times))
    assert found[0] == found[1]
    assert made[1] < 60 < made[0]


def test_decode_leaves_out_unknown_ids():
    made = bpe.WordBpe(PATH)
    ids = pa.array([[0, 10**6, 1, -1, None], None, []], pa.list_(pa.int32()))
    assert made.decode_all(ids).to_pylist() == ["! \"", "", ""]


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=40), st.text("abc", max_size=12), st.integers(0, 40))
def test_phrases_and_variants(text, tail, kept):
    known, word = set(), ""
    for letter in text:
        word += letter
        if word not in known:
            known.add(word)
            word = ""
    ends, _ = lempelziv.phrases(text, set())
    assert {text[a:b] for a, b in zip([0, *ends], ends)} == known | ({word} if word else set())
    kept = min(kept, len(text))
    a, b = lempelziv.with_variant(text, kept, tail)
    assert lempelziv.packed(a).hex() == lempelziv.fingerprint(text)
    assert lempelziv.packed(b).hex() == lempelziv.fingerprint(text[:kept] + tail)


@settings(max_examples=300, deadline=None)
@given(st.text("ab", max_size=14), st.text("ab", max_size=14), st.integers(1, 3))
def test_banded_distance(a, b, most):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    assert linededup.edit_distance(a, b, most) == min(row[-1], most + 1)


@pytest.mark.parametrize("level", [1, 2, 3])
def test_near_lines_share_an_entry(level):
    rnd = random.Random(level)
    for _ in range(300):
        a = [rnd.choice("abcde ") for _ in range(rnd.randint(22, 60))]
        b = a.copy()
        for _ in range(2):
            at = rnd.randrange(len(b))
            rnd.choice([lambda: b.pop(at), lambda: b.insert(at, "x"), lambda: b.__setitem__(at, "y")])()
        (own, probed), (other_own, other_probed) = (linededup.entries("".join(x), level) for x in (a, b))
        met = {*own, *probed} & {*other_own, *other_probed}
        assert met & {*own, *other_own}


@pytest.mark.parametrize("blocks", [simhash.BLOCKS[:2], simhash.BLOCKS])
def test_every_near_pair_meets_at_a_home(blocks):
    rng = np.random.default_rng(4)
    x = rng.integers(0, 1 << 63, 500, dtype=np.uint64)
    y = x.copy()
    for i in range(500):
        for bit in rng.choice(64, i % 3, replace=False):
            y[i] ^= np.uint64(1) << np.uint64(bit)
    owner, point, home = simhash.anchors(x, blocks)
    homes = np.zeros(500, np.int64)
    homes[owner[home]] = point[home]
    assert home.sum() == 500
    owner, point, _ = simhash.anchors(y, blocks)
    assert set(owner[point == homes[owner]]) == set(range(500))


@pytest.mark.parametrize("crowd", [64, 1])
def test_crowded_anchors_lose_no_link(base_spark, crowd):
    rng = np.random.default_rng(9)
    center = np.uint64(0x123456789ABCDEF0)
    prints = {int(center)}
    while len(prints) < 150:
        bits = rng.choice(64, rng.integers(1, 6), replace=False)
        prints.add(int(center) ^ sum(1 << int(b) for b in bits))
    values = np.array(sorted(prints), np.uint64)
    nodes = base_spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "simhash long")
    found = components.components(simhash.links(nodes, simhash.BLOCKS[:2], crowd)).collect()
    root = {r["node"]: r["root"] for r in found}
    signed = [int(v) for v in values.view(np.int64)]
    parent = {v: v for v in signed}

    def top(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for i, a in enumerate(signed):
        for b in signed[i + 1 :]:
            if ((a ^ b) & (2**64 - 1)).bit_count() <= 2:
                x, y = top(a), top(b)
                parent[max(x, y)] = min(x, y)
    assert {v: root.get(v, v) for v in signed} == {v: top(v) for v in signed}


def test_components_of_a_long_chain(base_spark):
    links = base_spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    found = {r["node"]: r["root"] for r in components.components(links).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, 101: 100}
    assert components.components(links.limit(0)).collect() == []


def test_uncovered_intervals():
    found = [(0, 9, "long", 1, 1.0), (2, 3, "in", 1, 1.0), (2, 3, "first", 9, 1.0), (8, 12, "over", 1, 1.0), (0, 9, "again", 1, 1.0)]
    assert [d[2] for d in licenses.uncovered(found)] == ["again", "first", "over"]
    assert len(licenses.rules()) > 200


def test_keywords_hold_in_every_match():
    for text in ("released under the terms of the GNU General Public License version 3", "SPDX-License-Identifier: mit"):
        assert licenses.scan(text)["found"]


@pytest.mark.parametrize(
    "text, label",
    [
        ("Apache License v2.0", "apache-2.0"),
        ("the GPL License V3.0", "gpl-3.0"),
        ("licensed under the GNU GPL v2", "gpl-2"),
        ("the MPL license, version v1.1", "mpl-1.1"),
        ("the Apache License, v 2.0", "apache-2.0"),
        ("Apache License 2.0", "apache-2.0"),
        ("the Apache License vast 2.0", "apache"),
    ],
)
def test_versions_with_a_v(text, label):
    assert {d[2] for d in licenses.scan(text)["found"]} == {label}


def test_rule_order_changes_no_verdict(base_spark, odd_dir):
    docs = base_spark.read.parquet(f"{odd_dir}/documents.parquet").select("doc_id", "text")
    a = rules.judged(docs, rules.standard_rules()).select("doc_id", "kept").collect()
    b = rules.judged(docs, rules.standard_rules()[::-1]).select("doc_id", "kept").collect()
    assert sorted(a, key=str) == sorted(b, key=str)


def test_discriminant_without_a_class(base_spark):
    df = base_spark.createDataFrame([("a b c", 1), (None, 1)], "text string, label int")
    model = quality.fit(quality.with_statistics(df))
    assert {r["score"] for r in quality.scored(quality.with_statistics(df), model).collect()} == {1.0}


def test_blocks_of_a_page_keep_their_order():
    assert extraction.extract("<main>a<ul><li>b<li>c</ul>d &lt; e</main>") == "a\nb\nc\nd < e"


def test_wrappers_named_for_what_stands_beside():
    text = "One, two, three and a long sentence."
    for named in ("content has-sidebar", "with-sidebar", "sidebar", "content widget"):
        page = f"<body><div class='{named}'><p>{text}</div></body>"
        assert extraction.extract(page) == text
    page = f"<body><div class='with-sidebar'><p>{text}<div class='main-nav'><p>a, b, c</div></div><p>x</body>"
    assert extraction.extract(page) == f"{text}\nx"


LONG = "One, two, three and a long sentence, which goes on for a while so that it counts, number {}."


def paragraphs(*numbers: int, tag: str = "p") -> str:
    return "".join(f"<{tag}>{LONG.format(i)}</{tag}>" for i in numbers)


MENU = "<ul><li><a href=/a>first link</a><li><a href=/b>second, link</a></ul>"


@pytest.mark.parametrize(
    "page, kept",
    [
        ("<article>" + "".join(f"<section><div><p>{LONG.format(i)}</p></div></section>" for i in range(5)) + "</article>", 5),
        ("<article>" + "".join(f"<section>{paragraphs(i, i + 1, i + 2)}</section>" for i in (0, 3, 6)) + "</article>", 9),
        (f"<body>{MENU}<div>" + "".join(f"<section>{paragraphs(i, i + 1, i + 2)}</section>" for i in (0, 3, 6)) + "</div></body>", 9),
        (f"<body>{MENU}<div><div><div>{paragraphs(0, 1)}</div></div><div><div>{paragraphs(2, 3)}</div></div></div></body>", 4),
        (f"<body><form id=aspnetForm>{MENU}<article>{paragraphs(0, 1)}</article><input name=q></form></body>", 2),
        (f"<body><form><div>{paragraphs(0, 1, 2)}</div></form></body>", 3),
        (f"<body>{MENU}<div>{paragraphs(0, 1, 2, tag='div')}</div></body>", 3),
        (f"<body>{MENU}<div>{LONG.format(0)}<br>{LONG.format(1)}</div></body>", 2),
        (f"<body>{MENU}<section>{paragraphs(0, 1, 2, 3, 4, 5)}</section><section><p>{LONG.format(6)}</p></section></body>", 7),
        (f"<main>{paragraphs(0)}<div><blockquote>{paragraphs(1)}</blockquote></div><table><tr><td>{LONG.format(2)}</table></main>", 3),
        ("<article>" + "<div>" * 40 + paragraphs(0) + "</div>" * 40 + paragraphs(1) + "</article>", 2),
    ],
)
def test_the_whole_article_is_kept(page, kept):
    assert extraction.extract(page) == "\n".join(LONG.format(i) for i in range(kept))


def test_forms_that_are_forms_go():
    form = "<form><p>Subscribe, and get our letter.</p><label>Name</label><input></form>"
    assert extraction.extract(f"<body><div>{paragraphs(0, 1)}{form}</div></body>") == "\n".join(map(LONG.format, (0, 1)))


def test_stored_keeps_the_schema(base_spark):
    df = base_spark.createDataFrame([(1, None)], "a long, b array<string>")
    assert stored(df, "test").schema == df.schema
