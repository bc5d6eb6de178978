"""Each opN_ query on the odd tables, against plain Python, the library or DuckDB."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from conftest import PAGES
from oracle_check import differences
from tablecrate.llm import lempelziv, linededup, oracles, queries

QUERIES = queries.llm_queries()


def rows_of(spark, name: str, folder: str) -> list[dict]:
    return [r.asDict(recursive=True) for r in QUERIES[name](spark, folder).collect()]


def as_bag(rows) -> Counter:
    return Counter(tuple(sorted(r.items(), key=lambda kv: kv[0])) for r in rows)


@pytest.mark.parametrize("name", list(QUERIES))
def test_empty_tables(base_spark, empty_dir, name):
    assert rows_of(base_spark, name, empty_dir) == []


def test_op1_matches_the_library(base_spark, odd_dir, odd_rows):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = []
    for r in odd_rows:
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        expected.append(
            {
                "doc_id": r["doc_id"],
                "n_tokens": len(ids),
                "ids_sha256": hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                "decoded_sha256": hashlib.sha256(decoded.encode()).hexdigest(),
            }
        )
    assert as_bag(rows_of(base_spark, "op1_bpe", odd_dir)) == as_bag(expected)


def test_op2_edits_and_likeness(base_spark, odd_dir, odd_rows):
    order = sorted(((r["doc_id"], r["text"] or "") for r in odd_rows), key=lambda p: (p[0] is not None, p[0] or 0, p[1]))

    def like(a: str, b: str) -> float:
        step = lempelziv.HEX
        return sum(a[i : i + step] == b[i : i + step] for i in range(0, len(a), step)) / lempelziv.LANES

    expected = []
    for (key, text), (_, following) in zip(order, order[1:] + order[:1]):
        quarter = len(text) // 4
        edited = text[: len(text) - quarter] + following[:quarter]
        mark, other, third = map(lempelziv.fingerprint, (text, edited, following))
        expected.append(
            {
                "doc_id": key, "n_chars": len(text), "edited_sha256": hashlib.sha256(edited.encode()).hexdigest(),
                "fingerprint": mark, "edited_fingerprint": other, "near_edited": like(mark, other),
                "near_next": like(mark, third),
            }
        )
    found = rows_of(base_spark, "op2_lempelziv", odd_dir)
    assert as_bag(found) == as_bag(expected)
    long = [r for r in found if r["n_chars"] > 100]
    assert sum(r["near_edited"] > r["near_next"] for r in long) >= 0.95 * len(long)


def simhash_by_hand(text: str | None) -> int:
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def classes(nodes: list, linked) -> dict:
    """node -> least of its component, by trying every pair."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = root(a), root(b)
                parent[max(x, y)] = min(x, y)
    return {n: root(n) for n in nodes}


def test_op3_components(base_spark, odd_dir, odd_rows):
    prints = [(r["doc_id"], simhash_by_hand(r["text"])) for r in odd_rows]
    root = classes(sorted({p for _, p in prints}), lambda a, b: (a ^ b).bit_count() <= 2)
    least = defaultdict(list)
    for key, p in prints:
        if key is not None:
            least[root[p]].append(key)
    expected = [
        {"doc_id": k, "fingerprint": f"{p:016x}", "component_id": min(least[root[p]], default=None)} for k, p in prints
    ]
    assert as_bag(rows_of(base_spark, "op3_simhash", odd_dir)) == as_bag(expected)


def test_op4_languages(base_spark, odd_dir, odd_rows):
    found = rows_of(base_spark, "op4_language", odd_dir)
    assert len(found) == len(odd_rows)
    by_id = {r["doc_id"]: r for r in found}
    for r in odd_rows:
        got = by_id[r["doc_id"]]
        held = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2
        assert got["held_out"] == held and 0 <= got["score"] <= 1
        letterless = not any(c.isalpha() for c in r["text"] or "")
        assert (got["lang_pred"] == "und") == letterless
    held_out = [r for r in odd_rows[:120] if by_id[r["doc_id"]]["held_out"]]
    right = sum(by_id[r["doc_id"]]["lang_pred"] == r["lang"] for r in held_out)
    assert len(held_out) > 10 and right >= 0.95 * len(held_out)


def test_op5_pages(base_spark, odd_dir):
    text = {
        1: "Head\nOne, two, three & four of a long sentence, really.\nSecond, unclosed paragraph, here.",
        2: "", 3: "", 4: "plain text only", 5: "deep", 6: "cell one, with words\ncell two",
        None: "only links a b c d e f g h",
    }
    expected = [{"page_id": i, "url": u, "text": text[i], "n_chars": len(text[i])} for i, u, _ in PAGES]
    assert as_bag(rows_of(base_spark, "op5_extraction", odd_dir)) == as_bag(expected)


def lines_by_hand(odd_rows) -> dict:
    """(key, text, line number) -> (class, links, kept)."""
    first: dict[str, tuple] = {}
    order = lambda k: (k[0] is not None, k[0] or 0, k[1])
    for r in odd_rows:
        for i, line in enumerate((r["text"] or "").split("\n") if r["text"] is not None else []):
            if line.strip():
                place = (r["doc_id"], i)
                first[line] = min(first.get(line, place), place, key=order)

    def near(a: str, b: str) -> bool:
        return min(len(a), len(b)) >= 20 and abs(len(a) - len(b)) <= 2 and edits(a, b) <= 2

    lines = sorted(first)
    root = classes(lines, near)
    links = Counter(x for i, a in enumerate(lines) for b in lines[i + 1 :] if near(a, b) for x in (a, b))
    best: dict[str, tuple] = {}
    for line in lines:
        best[root[line]] = min(best.get(root[line], first[line]), first[line], key=order)
    return {line: (best[root[line]], links[line]) for line in lines}


def edits(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def odd_lines() -> list[dict]:
    base = "the quick brown fox jumps over the lazy dog again"
    texts = [
        (1, f"{base}\nshort\n\n{base}!"),
        (2, f"{base[1:]}\nshort\nanother line that is long enough"),
        (3, None),
        (4, ""),
        (5, f"{base}"),
        (5, f"{base}"),
        (6, f"{base.replace('fox', 'cat')}\n \nab"),
        (None, "another line that is long enough?"),
    ]
    return [{"doc_id": k, "text": t} for k, t in texts]


@pytest.mark.parametrize("crowd", [linededup.CROWD, 2])
def test_op6_lines(base_spark, crowd):
    """Also with keys that count as crowded at once, so that every level is used."""
    rows = odd_lines()
    df = base_spark.createDataFrame([(r["doc_id"], r["text"]) for r in rows], "doc_id long, text string")
    found = [r.asDict() for r in linededup.line_classes(df, crowd=crowd).drop("body").collect()]
    known = lines_by_hand(rows)
    expected = []
    for r in rows:
        for i, line in enumerate(r["text"].split("\n") if r["text"] is not None else []):
            own = (r["doc_id"], i)
            place, links = known.get(line, (own, 0))
            expected.append(
                {"doc_id": r["doc_id"], "line_no": i, "n_chars": len(line), "class_key": place[0],
                 "class_line": place[1], "n_links": links, "kept": place == own}
            )
    assert as_bag(found) == as_bag(expected)


def test_op6_query_covers_every_line(base_spark, odd_dir, odd_rows):
    found = rows_of(base_spark, "op6_lines", odd_dir)
    assert len(found) == sum(len(r["text"].split("\n")) for r in odd_rows if r["text"] is not None)
    copies = {r["doc_id"]: r["kept"] for r in found if r["doc_id"] in (3, 205) and r["line_no"] == 0}
    assert copies == {3: True, 205: False}


def test_op7_scores(base_spark, odd_dir, odd_rows):
    found = rows_of(base_spark, "op7_quality", odd_dir)
    assert len(found) == len(odd_rows)
    for r in found:
        assert r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    by_id = {r["doc_id"]: r["score"] for r in found}
    assert max(by_id[210], by_id[211]) < 0.3 and by_id[10] > 0.9


@pytest.mark.parametrize("name", list(queries.llm_oracles()))
def test_sql_oracles(base_spark, odd_dir, name):
    import duckdb

    connection = duckdb.connect()
    for table in ("documents", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{odd_dir}/{table}.parquet')")
    assert differences(QUERIES[name](base_spark, odd_dir), connection, queries.llm_oracles()[name]) == []


def test_op9_meets_its_targets(base_spark, odd_dir):
    found = rows_of(base_spark, "op9_mixing", odd_dir)
    assert all(r["taken"] <= 3 * r["size"] for r in found)
    by_source = defaultdict(lambda: [0, 0.0, 0])
    for r in found:
        held = by_source[r["source_size"]]
        held[0], held[1], held[2] = held[0] + r["taken"], r["target"], max(held[2], r["size"])
    for taken, target, largest in by_source.values():
        assert abs(taken - target) <= largest / 2 + 1e-6


def test_op10_base_places(base_spark, odd_dir, odd_rows):
    phrases = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}
    by_id = {(r["doc_id"], r["n_words"]): r for r in rows_of(base_spark, "op10_licenses", odd_dir)}
    for r in odd_rows:
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), r["text"] or "")
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
        places = [(i, label) for p, label in phrases.items() for i in range(len(words)) if tuple(words[i : i + len(p)]) == p]
        got = by_id[r["doc_id"], len(words)]
        starts = [i for i, _ in places]
        base = {label for _, label in places}
        assert (got["n_base"], got["first_word"], got["last_word"]) == (
            len(places), min(starts, default=None), max(starts, default=None)
        )
        assert got["base_labels"] == ",".join(sorted(base)) and base <= set(got["labels"].split(","))
        assert 0 <= got["score"] <= 1
    assert by_id[212, 11]["n_base"] == 3


def test_oracles_are_of_queries():
    assert set(queries.llm_oracles()) <= set(QUERIES) and oracles.OP8_RULES
