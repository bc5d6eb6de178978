"""BPE encoding and decoding by forced-boundary splitting.

A pair of neighbouring bytes that stands inside no token of the vocabulary can never be
merged, so it is a certain cut. Each word is cut there, the fragments are encoded on their
own (and remembered: most recur), and their ids are concatenated.

Null text encodes as empty text: no ids, decoded as ''. Any other text, however long, is
encoded whole. Rows are independent: repeated rows give equal results, an empty table gives
an empty one, and the new columns replace existing ones of the same name.
"""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Callable, Iterable
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tablecrate.llm.arrow import with_computed

# Fixed values of the word-BPE file: its word pattern for lower-case ASCII, and the white
# space of str.split() that is an ordinary character for the pattern.
ASCII_WORD = r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+"
NOT_SPACE = re.compile("[\x1c-\x1f]")
SPACES = re.compile(r"[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")

# What a worker remembers of each kind before it forgets what it has not met lately; jobs with
# room for it ask for several times as much.
CHUNKS, WORDS, FRAGMENTS = 60_000, 120_000, 30_000
LONGEST_REMEMBERED = 48
# Fragments of more symbols are merged with a heap.
SHORT = 64
NEVER = 1 << 60


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte: printable Latin-1 for itself, the
    others for the letters from U+0100 on."""
    shown = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(0x100, 0x200))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


class Memory(dict):
    """`make(key)` remembered: two generations, so that it is bounded and common keys stay."""

    def __init__(self, most: int, make: Callable):
        super().__init__()
        self.most, self.make, self.old = most // 2, make, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(key) <= LONGEST_REMEMBERED:
            if len(self) >= self.most:
                self.old = dict(self)
                self.clear()
            self[key] = value
        return value


class WordBpe:
    """The encoder and decoder of one tokenizer file."""

    def __init__(self, path: str, memory: int = 1):
        with open(path, encoding="utf-8") as file:
            parsed = json.load(file)
        model = parsed["model"]
        self.end: str = model["end_of_word_suffix"] or ""
        self.ids: dict[str, int] = model["vocab"]
        self.ranks = {tuple(pair): rank for rank, pair in enumerate(model["merges"])}
        self.special = {t["content"]: t["id"] for t in parsed["added_tokens"]}
        self.special_cut = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")
        tokens = {**self.ids, **self.special}
        self.tokens = pa.array(sorted(tokens, key=tokens.__getitem__), pa.string())
        if sorted(tokens.values()) != list(range(len(tokens))):
            raise ValueError(f"the ids of {path} have gaps")
        self.letters = byte_letters()
        spelled = map(self.symbols, self.ids)
        self.inside = {pair for symbols in spelled for pair in zip(symbols, symbols[1:])}
        # Unicode rules of the file (normal form, lower case, word classes) are the library's.
        library = Tokenizer.from_file(path)
        self.normalizer, self.pre_tokenizer = library.normalizer, library.pre_tokenizer
        self.ascii_word = re.compile(ASCII_WORD)
        # Ids are kept as the bytes of 32-bit integers: joining them is one copy.
        self.chunks = Memory(memory * CHUNKS, self.encode_chunk)
        self.known_words = Memory(memory * WORDS, self.encode_word)
        self.fragments = Memory(memory * FRAGMENTS, self.encode_fragment)

    def symbols(self, token: str) -> list[str]:
        """One symbol a byte; the last one carries the word end if `token` does."""
        body = token.removesuffix(self.end) if self.end else token
        symbols = list(body)
        if symbols and len(body) < len(token):
            symbols[-1] += self.end
        return symbols

    def words(self, chunk: str) -> list[str]:
        """The words of a chunk without white space, as letters that stand for bytes."""
        if chunk.isascii() and chunk.isprintable():
            return self.ascii_word.findall(chunk.lower())
        normal = self.normalizer.normalize_str(chunk)
        return [word for word, _ in self.pre_tokenizer.pre_tokenize_str(normal)]

    def cut(self, word: str) -> list[tuple[str, ...]]:
        """The fragments of a word: cut at every pair that stands inside no token."""
        symbols = (*word[:-1], word[-1] + self.end) if word else ()
        held = list(map(self.inside.__contains__, zip(symbols, symbols[1:])))
        if all(held):
            return [symbols]
        cuts = [at for at, inside in enumerate(held, 1) if not inside]
        return [symbols[a:b] for a, b in zip([0, *cuts], [*cuts, len(symbols)])]

    def merge(self, fragment: tuple[str, ...]) -> list[str]:
        """The tokens of one fragment: the best ranked pair is joined first, of equal
        ones the leftmost."""
        if len(fragment) > SHORT:
            return self.merge_long(fragment)
        parts, rank = list(fragment), self.ranks.get
        ranks = list(map(rank, zip(parts, parts[1:]), repeat(NEVER)))
        while ranks and (best := min(ranks)) < NEVER:
            at = ranks.index(best)
            parts[at] += parts.pop(at + 1)
            del ranks[at]
            if at:
                ranks[at - 1] = rank((parts[at - 1], parts[at]), NEVER)
            if at < len(ranks):
                ranks[at] = rank((parts[at], parts[at + 1]), NEVER)
        return parts

    def merge_long(self, fragment: tuple[str, ...]) -> list[str]:
        """`merge` in n log n: a heap of pairs over a linked list."""
        parts: list[str | None] = list(fragment)
        size, ranks = len(parts), self.ranks
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        queue = [
            (ranks[pair], at) for at, pair in enumerate(zip(parts, parts[1:])) if pair in ranks
        ]
        heapq.heapify(queue)
        while queue:
            rank, left = heapq.heappop(queue)
            right = after[left]
            if parts[left] is None or right >= size or ranks.get((parts[left], parts[right])) != rank:
                continue
            parts[left], parts[right] = parts[left] + parts[right], None
            after[left] = after[right]
            if after[left] < size:
                before[after[left]] = left
            for a in (before[left], left):
                b = after[a] if a >= 0 else size
                if b < size and (new := ranks.get((parts[a], parts[b]))) is not None:
                    heapq.heappush(queue, (new, a))
        return [p for p in parts if p is not None]

    def encode_fragment(self, fragment: tuple[str, ...]) -> bytes:
        return np.array([self.ids[token] for token in self.merge(fragment)], np.int32).tobytes()

    def encode_word(self, word: str) -> bytes:
        cut = self.cut(word)
        if len(cut) == 1:  # remembered as a word
            return self.encode_fragment(cut[0])
        return b"".join(map(self.fragments.__getitem__, cut))

    def encode_chunk(self, chunk: str) -> bytes:
        return b"".join(map(self.known_words.__getitem__, self.words(chunk)))

    def encode(self, text: str | None) -> bytes:
        """The ids of a text, as the bytes of 32-bit integers."""
        text = text or ""
        made = []
        for piece in self.special_cut.split(text) if "<|" in text else [text]:
            if piece in self.special:
                made.append(np.int32(self.special[piece]).tobytes())
            else:
                chunks = SPACES.split(piece) if NOT_SPACE.search(piece) else piece.split()
                made.extend(map(self.chunks.__getitem__, chunks))
        return b"".join(made)

    def encode_all(self, texts: Iterable[str | None]) -> pa.ListArray:
        rows = list(map(self.encode, texts))
        offsets = np.zeros(len(rows) + 1, np.int32)
        np.cumsum([len(r) // 4 for r in rows], out=offsets[1:])
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(rows), np.int32)))

    def decode_all(self, ids: pa.ListArray) -> pa.Array:
        """The file names no decoder, so tokens are joined by one space. Ids it does not
        have, and null ones, are left out; null rows give ''."""
        flat, rows = ids.flatten(), pc.fill_null(pc.list_value_length(ids), 0).to_numpy()
        owner = np.repeat(np.arange(len(rows)), rows)
        found = pc.fill_null(pc.less(pc.cast(flat, pa.uint32(), safe=False), len(self.tokens)), False)
        kept = np.bincount(owner[found.to_numpy(zero_copy_only=False)], minlength=len(rows))
        offsets = np.zeros(len(rows) + 1, np.int32)
        np.cumsum(kept, out=offsets[1:])
        tokens = self.tokens.take(flat.filter(found))
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), tokens), " ")


@lru_cache(maxsize=4)
def tokenizer(path: str, memory: int = 1) -> WordBpe:
    """One per worker process, file and size of memory."""
    return WordBpe(path, memory)


def encode(df: DataFrame, path: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """`df` with the ids of each text, array<int>."""

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        return {ids: tokenizer(path).encode_all(batch.column(text).to_pylist())}

    return with_computed(df, compute, f"`{ids}` array<int>")


def decode(df: DataFrame, path: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """`df` with the text of its ids; null ids give ''."""

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        return {decoded: tokenizer(path).decode_all(batch.column(ids))}

    return with_computed(df, compute, f"`{decoded}` string")


def round_trip(
    df: DataFrame, path: str, text: str = "text", keep: list[str] | None = None, memory: int = 1
) -> DataFrame:
    """`df` (or its columns `keep`) with `ids` and `decoded`, made in one visit to Python. Workers
    remember `memory` times as much as usual: results are the same, rare words cost less."""

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        bpe = tokenizer(path, memory)
        ids = bpe.encode_all(batch.column(text).to_pylist())
        return {"ids": ids, "decoded": bpe.decode_all(ids)}

    return with_computed(df, compute, "ids array<int>, decoded string", keep)
