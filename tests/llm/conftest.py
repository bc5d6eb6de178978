"""Small tables with every odd case: nulls in any column, empty and long texts, ties,
repeated rows, extra columns whose names clash with those of results, and no rows at all."""

from __future__ import annotations

import random

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

WORDS = {
    "en": "the and of to in that with for was this house water people never through their would light",
    "de": "der die und das nicht mit ein ich werden haben auch durch über wasser häuser könnte schließlich",
    "fr": "le la les des est une dans pour que avec plus être même après château rivière peuvent très",
    "es": "el los las una por con para que más también año niños después según ciudad corazón señor",
}


def sentence(rnd: random.Random, lang: str, words: int) -> str:
    return " ".join(rnd.choice(WORDS[lang].split()) + rnd.choice("abcdefgh") * rnd.randint(0, 1) for _ in range(words))


def text(rnd: random.Random, lang: str) -> str:
    return "\n".join(sentence(rnd, lang, rnd.randint(8, 25)).capitalize() + "." for _ in range(rnd.randint(2, 6)))


def documents() -> list[dict]:
    rnd = random.Random(11)
    rows = []
    for i in range(120):
        lang = rnd.choice(list(WORDS))
        rows.append((i, text(rnd, lang), lang, f"s{rnd.randint(0, 4)}"))
    long = " ".join(text(rnd, "en").replace("\n", " \n") for _ in range(400))
    copied = rows[3][1]
    rows += [
        (200, None, "en", "s0"),
        (201, "", "de", "s1"),
        (202, " \t\n\r\x0b\x0c ", None, "s1"),
        (203, "12 345 ... !!", "en", None),
        (204, long, "en", "s0"),
        (205, copied, "en", "s2"),
        (206, copied + " x", "en", "s2"),
        (207, copied.replace(" ", "  ", 1), None, None),
        (208, "one two", "en", "s3"),
        (208, "one two", "en", "s3"),
        (209, "naïve 𝔘nicode — “quotes” 日本語\x85x\x1cy <|endoftext|>", "fr", "é"),
        (210, "spam spam spam spam spam " * 20, "en", "s0"),
        (211, "a#*$% b&|<> " * 30, "en", "s0"),
        (212, "Licensed under the MIT License. See the Apache License, mit license", "en", "s0"),
        (None, "a text without a number, but with words enough to be kept by rules", "en", "s1"),
    ]
    return [
        {"doc_id": i, "text": t, "lang": lang, "source": s, "n_chars": len(t or ""), "score": "mine",
         "fingerprint": 5, "ids": None, "key": i, "u": 0.5, "size": 7, "words": "w"}
        for i, t, lang, s in rows
    ]


SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()),
     ("n_chars", pa.int64()), ("score", pa.string()), ("fingerprint", pa.int32()), ("ids", pa.string()),
     ("key", pa.int64()), ("u", pa.float64()), ("size", pa.int64()), ("words", pa.string())]
)

PAGES = [
    (1, "http://a", "<html><head><title>no</title></head><body><nav><a href=x>menu</a></nav><div class='content'>"
     "<h1>Head</h1><p>One, two, three &amp; four\n of a long  sentence, really.<p>Second, unclosed paragraph, here."
     "</div><div id='comments'><p>I think, this is nice, very nice.</p></div><footer>&copy; us</footer></body></html>"),
    (2, None, None),
    (3, "", ""),
    (4, "x", "plain text only"),
    (5, "y", "<div>" * 3000 + "deep"),
    (6, "z", "<table><tr><td>cell one, with words<td>cell two</table><script>var a='<p>no</p>'</script>"),
    (6, "z", "<table><tr><td>cell one, with words<td>cell two</table><script>var a='<p>no</p>'</script>"),
    (None, "q", "<p>only links <a href=1>a b c d e f g h</a></p>"),
]


def embeddings() -> pa.Table:
    rnd = random.Random(5)
    centres = [[rnd.gauss(0, 0.3) for _ in range(16)] for _ in range(6)]
    rows = [(i, [x + rnd.gauss(0, 0.1) for x in centres[i % 6]], rnd.randint(0, 9)) for i in range(700)]
    whole = rows[0][1]
    rows += [
        (700, None, 1), (701, [None, *whole[1:]], 2), (702, [float("nan"), *whole[1:]], 3),
        (703, [float("inf"), *whole[1:]], 3), (704, whole, None), (705, [0.0] * 16, 4), (None, whole, 2),
        (50, rows[50][1], rows[50][2]), (51, rows[50][1], rows[50][2]),
        *((800 + i, whole, i % 3) for i in range(300)),
    ]
    key, vector, label = zip(*rows)
    return pa.table(
        {"vec_id": pa.array(key, pa.int64()), "embedding": pa.array(vector, pa.list_(pa.float32())),
         "label": pa.array(label, pa.int32()), "code": pa.array(["mine"] * len(rows)), "vector": pa.array(key, pa.int64()),
         "key": pa.array(key, pa.int64()), "error": pa.array([None] * len(rows), pa.int32())}
    )


def write(folder, name: str, table: pa.Table) -> None:
    pq.write_table(table, f"{folder}/{name}.parquet")


def labels() -> pa.Table:
    rows = [(r["doc_id"], 0 if r["doc_id"] in (210, 211) else 1, 0) for r in documents()[::2]]
    rows += [(210, 0, 0), (211, 0, None), (204, None, 0), (None, 1, 1), (5, 1, 0), (5, 1, 0)]
    return pa.table(
        {"doc_id": pa.array([r[0] for r in rows], pa.int64()), "quality": pa.array([r[1] for r in rows], pa.int32()),
         "toxic": pa.array([r[2] for r in rows], pa.int32())}
    )


def pages() -> pa.Table:
    columns = list(zip(*PAGES))
    return pa.table(
        {"page_id": pa.array(columns[0], pa.int64()), "url": pa.array(columns[1], pa.string()),
         "html": pa.array(columns[2], pa.string()), "text": pa.array(["clash"] * len(PAGES), pa.string())}
    )


@pytest.fixture(scope="session")
def odd_dir(tmp_path_factory) -> str:
    folder = tmp_path_factory.mktemp("odd")
    write(folder, "documents", pa.Table.from_pylist(documents(), SCHEMA))
    write(folder, "labels", labels())
    write(folder, "pages", pages())
    write(folder, "embeddings", embeddings())
    return str(folder)


@pytest.fixture(scope="session")
def empty_dir(tmp_path_factory) -> str:
    folder = tmp_path_factory.mktemp("empty")
    write(folder, "documents", SCHEMA.empty_table())
    write(folder, "labels", labels().slice(0, 0))
    write(folder, "pages", pages().slice(0, 0))
    write(folder, "embeddings", embeddings().slice(0, 0))
    return str(folder)


@pytest.fixture(scope="session")
def odd_rows() -> list[dict]:
    return documents()
