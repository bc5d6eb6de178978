"""The pipeline on the odd tables: each stage on what its predecessor kept."""

from __future__ import annotations

from collections import Counter

import corpus_pipeline
from tablecrate.llm import bpe
from test_queries_brute import classes, lines_by_hand
from test_similar import alike, set_by_hand


def bag(rows) -> Counter:
    return Counter((r["doc_id"], r["text"]) for r in rows)


def test_stages(base_spark, odd_dir, odd_rows, tmp_path):
    stages = dict(corpus_pipeline.STAGES)
    docs = base_spark.read.parquet(f"{odd_dir}/documents.parquet")

    def after(name: str):
        nonlocal docs
        stages[name](base_spark, docs, odd_dir).write.parquet(f"{tmp_path}/{name}")
        docs = base_spark.read.parquet(f"{tmp_path}/{name}")
        return [r.asDict() for r in docs.collect()]

    named = after("language_id")
    assert docs.columns == list(corpus_pipeline.COLUMNS)
    assert bag(named) == bag(r for r in odd_rows if any(c.isalpha() for c in r["text"] or ""))
    assert all(r["lang"] for r in named)

    deduped = after("line_dedup")
    known = lines_by_hand(named)
    expected = []
    for r in named:
        lines = r["text"].split("\n")
        stay = [
            line for i, line in enumerate(lines)
            if not line.strip() or known[line][0] == (r["doc_id"], i)
        ]
        if stay:
            expected.append({"doc_id": r["doc_id"], "text": "\n".join(stay)})
    assert bag(deduped) == bag(expected)
    assert all(r["n_chars"] == len(r["text"]) for r in deduped)
    assert docs.columns == list(corpus_pipeline.COLUMNS)

    single = after("near_dedup")
    sets = [set_by_hand(r["text"]) for r in deduped]
    root = classes(sorted(set(sets)), alike)
    groups = {}
    for r, found in zip(deduped, sets):
        groups.setdefault(root[found], []).append(r)
    least = lambda r: (r["doc_id"] is None, r["doc_id"] or 0)
    assert len(single) == len(groups)  # one row each, of repeated rows, too
    assert bag({"doc_id": r["doc_id"], "text": None} for r in single) == bag(
        {"doc_id": min(rows, key=least)["doc_id"], "text": None} for rows in groups.values()
    )
    assert not bag(single) - bag(deduped)

    mixed = after("mixing")
    copies = Counter(r["doc_id"] for r in mixed)
    assert set(bag(mixed)) <= set(bag(single)) and max(copies.values()) <= 2 * 3

    encoded = after("bpe")
    library = bpe.WordBpe(corpus_pipeline.TOKENIZER)
    ids = Counter((r["doc_id"], tuple(r["ids"])) for r in encoded)
    assert ids == Counter((r["doc_id"], tuple(library.encode_all([r["text"]]).to_pylist()[0])) for r in mixed)
    assert all(r["n_tokens"] == len(r["ids"]) for r in encoded)


def test_run_on_empty_tables(base_spark, empty_dir):
    assert corpus_pipeline.run(base_spark, empty_dir).collect() == []


def test_copies_leave_by_near_dedup(base_spark):
    text = "one two three four five six seven eight nine ten"
    rows = [(5, text), (5, text), (None, text), (None, text), (3, text), (9, text + " eleven " * 60), (9, "other words here")]
    docs = base_spark.createDataFrame(
        [(i, t, "en", "s0", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long"
    )
    found = corpus_pipeline.near_dedup(base_spark, docs, "").collect()
    assert sorted((r["doc_id"], r["text"]) for r in found) == sorted([(3, text), (9, rows[5][1]), (9, "other words here")])
    same = base_spark.createDataFrame([r for r in docs.collect() if r["doc_id"] is None], docs.schema)
    assert corpus_pipeline.near_dedup(base_spark, same, "").count() == 1


def test_short_repeated_lines_go(base_spark):
    """Whatever their length; documents of nothing else go."""
    texts = [(1, "Read more\n\nA first line, long enough to count.\nRead more"), (2, "ab\nRead more\n\nRead mor"),
             (3, "Read more"), (4, "ab\nA first line, long enough to count!")]
    docs = base_spark.createDataFrame(
        [(i, t, "en", "s0", len(t)) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long"
    )
    found = corpus_pipeline.line_dedup(base_spark, docs, "")
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in found.collect()} == {
        1: ("Read more\n\nA first line, long enough to count.", 46),
        2: ("ab\n\nRead mor", 12),
    }
