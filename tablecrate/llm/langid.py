"""Language identification by hierarchical discrimination.

Letters 1- to 3-grams of a whole text are hashed into a profile. Linear support vector
machines first choose the language family, one versus one; others, again one versus one, then
separate the languages within it. They are trained by Spark ML on at most
`per_language` labelled texts of each language (a documented bound, drawn by hash).

Null texts and texts without a letter are `und` with score 0. Only languages with a labelled
text are learned; with a single one it is always predicted, with none everything is `und`.
Ties between votes go to the larger summed margin, then to the first name.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LinearSVC
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablecrate.llm.arrow import with_computed
from tablecrate.llm.common import stored

UNKNOWN = "und"
BITS = 11

# The family of each language code. Other codes are families of their own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb fy yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs bg mk",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "celtic": "ga gd cy br",
    "turkic": "tr az kk uz ky tk",
    "indic": "hi bn mr gu pa ne ur si",
    "iranian": "fa ku ps tg",
    "semitic": "ar he mt am",
    "austronesian": "id ms tl jv",
    "dravidian": "ta te kn ml",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


def family_of(lang: str) -> str:
    code = lang.lower().replace("_", "-").split("-")[0]
    return _FAMILY.get(code, f"={code}")


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """For each code point: its lower case if that is a letter, else 0 (no letter)."""
    table = np.zeros(sys.maxunicode + 1, np.uint32)
    for c in range(sys.maxunicode + 1):
        if chr(c).isalpha():
            low = chr(c).lower()
            table[c] = ord(low[0])
    return table


def profile(text: str | None) -> np.ndarray | None:
    """The hashed 1- to 3-gram counts of the letters (runs of others count as one space),
    square roots scaled to length 1; None without a letter."""
    if not text:
        return None
    codes = _letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    kept = codes != 0
    if not kept.any():
        return None
    kept[1:] |= kept[:-1]  # a space is kept after a letter only
    codes = np.concatenate(([0], codes[kept], [0])).astype(np.uint32)
    one = codes * np.uint32(0x9E3779B1)
    two = one[:-1] ^ (codes[1:] * np.uint32(0x85EBCA77))
    three = two[:-1] ^ (codes[2:] * np.uint32(0xC2B2AE3D))
    hashed = np.concatenate((one, two + np.uint32(1), three + np.uint32(2)))
    hashed ^= hashed >> np.uint32(15)
    hashed *= np.uint32(0x2C1B3C6D)
    counts = np.bincount(hashed >> np.uint32(32 - BITS), minlength=1 << BITS)
    root = np.sqrt(counts)
    return root / np.linalg.norm(root)


@dataclass
class Duel:
    """One machine: its margin is positive for `first`."""

    first: str
    second: str
    weights: np.ndarray
    intercept: float


@dataclass
class LanguageModel:
    languages: dict[str, list[str]]  # by family
    families: list[Duel] = field(default_factory=list)
    within: dict[str, list[Duel]] = field(default_factory=dict)

    def predict(self, profiles: np.ndarray) -> tuple[list[str], np.ndarray]:
        """The language of each profile, and how sure both choices are (0 to 1)."""
        names = sorted(self.languages)
        family, sure = _votes(names, self.families, profiles)
        chosen: list[str] = [""] * len(profiles)
        for at, name in enumerate(names):
            rows = np.flatnonzero(family == at)
            if len(rows):
                members = sorted(self.languages[name])
                lang, more = _votes(members, self.within.get(name, []), profiles[rows])
                sure[rows] *= more
                for row, winner in zip(rows, lang):
                    chosen[row] = members[winner]
        return chosen, sure


def _votes(names: list[str], duels: list[Duel], profiles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The index of the winner of all duels, and the probability of its closest one."""
    n = len(profiles)
    votes, margins = np.zeros((n, len(names))), np.zeros((n, len(names)))
    closest = np.full((n, len(names)), np.inf)
    for duel in duels:
        margin = profiles @ duel.weights + duel.intercept
        for name, signed in ((duel.first, margin), (duel.second, -margin)):
            at = names.index(name)
            votes[:, at] += signed > 0
            margins[:, at] += signed
            closest[:, at] = np.minimum(closest[:, at], signed)
    winner = np.argmax(votes * 1e6 + np.clip(margins, -1e5, 1e5), axis=1)
    nearest = closest[np.arange(n), winner]
    return winner, np.where(np.isinf(nearest), 1.0, 1 / (1 + np.exp(-4 * np.clip(nearest, -50, 50))))


def sample(labelled: DataFrame, key: Column, lang: str, per_language: int) -> DataFrame:
    """About `per_language` rows of each language, never more, drawn by a hash of the key."""
    spark = labelled.sparkSession
    counts = labelled.groupBy(lang).count().collect()  # one row a language
    if not counts:
        return labelled.limit(0)
    shares = spark.createDataFrame(
        [(r[0], min(1.0, 1.2 * per_language / r[1])) for r in counts], ["__lang", "__share"]
    )
    drawn = F.abs(F.xxhash64(key, F.lit("sample")) % 1_000_000) / 1_000_000
    order = Window.partitionBy("__lang").orderBy("__drawn")
    return (
        labelled.withColumn("__drawn", drawn)
        .join(F.broadcast(shares), labelled[lang] == F.col("__lang"))
        .where(F.col("__drawn") < F.col("__share"))
        .withColumn("__rank", F.row_number().over(order))
        .where(F.col("__rank") <= per_language)
        .drop("__drawn", "__share", "__rank", "__lang")
    )


def fit(labelled: DataFrame, key: Column, text: str = "text", lang: str = "lang", per_language: int = 400) -> LanguageModel:
    """The model of `labelled`. Rows without a language or without a letter teach nothing."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull())
    rows = sample(rows, key, lang, per_language)

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        found = [profile(t) for t in batch.column(text).to_pylist()]
        return {"profile": pa.array([None if p is None else p.tolist() for p in found], pa.list_(pa.float64()))}

    # Bounded, and read once for each machine.
    train = stored(
        with_computed(rows.select(lang, text), compute, "profile array<double>", [lang]).where(
            "profile is not null"
        ),
        "language_sample",
    )
    names = [r[0] for r in train.select(lang).distinct().collect()]
    languages: dict[str, list[str]] = {}
    for name in names:
        languages.setdefault(family_of(name), []).append(name)
    model = LanguageModel(languages)
    vectors = train.select(F.col(lang).alias("lang"), array_to_vector("profile").alias("features")).coalesce(6)
    for first, second in combinations(sorted(languages), 2):
        model.families.append(_duel(vectors, first, second, languages[first], languages[second]))
    for family, members in languages.items():
        model.within[family] = [
            _duel(vectors, a, b, [a], [b]) for a, b in combinations(sorted(members), 2)
        ]
    return model


def _duel(vectors: DataFrame, first: str, second: str, ours: list[str], theirs: list[str]) -> Duel:
    rows = vectors.where(F.col("lang").isin(*ours, *theirs)).withColumn(
        "label", F.col("lang").isin(*ours).cast("double")
    )
    svm = LinearSVC(maxIter=25, regParam=1e-3, standardization=False).fit(rows)
    return Duel(first, second, svm.coefficients.toArray(), float(svm.intercept))


def identify(df: DataFrame, model: LanguageModel, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`df` with `lang_pred` and `score`."""

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        texts = batch.column(text).to_pylist()
        langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if model.languages:
            for start in range(0, len(texts), 256):  # profiles are dense
                found = [(start + i, profile(t)) for i, t in enumerate(texts[start : start + 256])]
                found = [(i, p) for i, p in found if p is not None]
                if found:
                    chosen, sure = model.predict(np.array([p for _, p in found]))
                    for (i, _), lang, score in zip(found, chosen, sure):
                        langs[i], scores[i] = lang, score
        return {"lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores)}

    return with_computed(df, compute, "lang_pred string, score double", keep)
