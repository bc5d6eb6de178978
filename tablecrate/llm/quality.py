"""Quality scores by a regularised quadratic discriminant.

Each text becomes a vector of transformed statistics. Every class gets a mean and a shrunken
covariance: part of it is replaced by the pooled covariance, part of that by its diagonal.
A score is the logistic of the difference of the two log-densities (Mahalanobis distances
through the cached Cholesky factors) plus the log prior odds.

The moments are plain sums, taken by Spark over all labelled rows; only they, d + d*d
numbers a class, reach the driver. Null and empty texts have the statistics of no words and
get a score like any other. Labels other than 0 and 1, and null ones, teach nothing. If a
class has no labelled row at all, every score is the share of the class 1 (0.5 without any).
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablecrate.llm.arrow import with_computed

STATISTICS = (
    "words", "word_chars", "symbols", "capitals", "digits", "marks", "repeated_words",
    "repeated_lines", "distinct_words", "commonest_word", "other_letters", "line_words",
)

# How much of a class covariance the pooled one replaces, and of the result its diagonal.
POOLED, DIAGONAL = 0.3, 0.1
# Added to each variance: statistics that never vary must not make a density infinite.
FLOOR = 1e-3

# Shares of very short texts are drawn towards those of a clean one.
FEW_LETTERS, FEW_WORDS, FEW_LINES = 30, 10, 4

_SYMBOL, _CAPITAL, _DIGIT, _MARK, _OTHER, _SPACE, _LETTER = 1, 2, 4, 8, 16, 32, 0
_KIND = np.zeros(256, np.uint8)
_KIND[list(b"#*$%&|<>")] = _SYMBOL
_KIND[ord("A") : ord("Z") + 1] = _CAPITAL
_KIND[ord("0") : ord("9") + 1] = _DIGIT
_KIND[list(b"!\"'(),-./:;?@[]\\^_`{}~+=")] = _MARK
_KIND[0x80:] = _OTHER
_KIND[:0x21] = _SPACE


def _logit(share: float) -> float:
    return math.log((share + 0.01) / (1.01 - share))


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one text: logarithms of counts, logits of shares."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.lower().split()
    n = len(words)
    kinds = np.bincount(_KIND[np.frombuffer(raw, np.uint8)], minlength=33)
    letters = max(1, len(raw) - int(kinds[_SPACE]))
    grams = Counter(zip(words, words[1:], words[2:], words[3:]))
    repeated = sum(c for c in grams.values() if c > 1)
    counts = Counter(words)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    return [
        math.log1p(n),
        math.log1p(letters / max(1, n)),
        _logit(int(kinds[_SYMBOL]) / (letters + FEW_LETTERS)),
        _logit(int(kinds[_CAPITAL]) / (letters + FEW_LETTERS)),
        _logit(int(kinds[_DIGIT]) / (letters + FEW_LETTERS)),
        _logit(int(kinds[_MARK]) / (letters + FEW_LETTERS)),
        _logit(repeated / (n + FEW_WORDS)),
        _logit((len(lines) - len(set(lines))) / (len(lines) + FEW_LINES)),
        _logit((len(counts) + FEW_WORDS) / (n + FEW_WORDS)),
        _logit(max(counts.values(), default=0) / (n + FEW_WORDS)),
        _logit(int(kinds[_OTHER]) / letters),
        math.log1p(n / max(1, len(lines))),
    ]


def with_statistics(df: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`df` with `statistics`, array<double> in the order of `STATISTICS`."""

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        rows = [statistics(t) for t in batch.column(text).to_pylist()]
        return {"statistics": pa.array(rows, pa.list_(pa.float64()))}

    return with_computed(df, compute, "statistics array<double>", keep)


@dataclass(frozen=True)
class Discriminant:
    """Means, inverse Cholesky factors and log constants of the classes 0 and 1."""

    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray

    def score(self, vectors: np.ndarray) -> np.ndarray:
        logs = []
        for mean, factor, constant in zip(self.means, self.factors, self.constants):
            distance = ((vectors - mean) @ factor.T) ** 2
            logs.append(constant - 0.5 * distance.sum(axis=1))
        return 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -500, 500)))


@dataclass(frozen=True)
class Share:
    """The stand-in while a class is missing."""

    share: float

    def score(self, vectors: np.ndarray) -> np.ndarray:
        return np.full(len(vectors), self.share)


def fit(rows: DataFrame, label: str = "label", statistics: str = "statistics") -> Discriminant | Share:
    """The discriminant of rows with a label (0 or 1) and their statistics."""
    d = len(STATISTICS)
    x = [F.col(statistics)[i] for i in range(d)]
    sums = [F.sum(v).alias(f"s{i}") for i, v in enumerate(x)]
    squares = [F.sum(x[i] * x[j]).alias(f"q{i}_{j}") for i in range(d) for j in range(i, d)]
    taught = rows.where(F.col(label).isin(0, 1))
    moments = {r[0]: r for r in taught.groupBy(label).agg(F.count(F.lit(1)).alias("n"), *sums, *squares).collect()}
    counts = [moments[c]["n"] if c in moments else 0 for c in (0, 1)]
    if min(counts) == 0:
        return Share(counts[1] / sum(counts) if sum(counts) else 0.5)
    means, covariances = [], []
    for c in (0, 1):
        r = moments[c]
        mean = np.array([r[f"s{i}"] for i in range(d)]) / r["n"]
        second = np.zeros((d, d))
        for i in range(d):
            for j in range(i, d):
                second[i, j] = second[j, i] = r[f"q{i}_{j}"] / r["n"]
        means.append(mean)
        covariances.append(second - np.outer(mean, mean))
    pooled = sum(n * c for n, c in zip(counts, covariances)) / sum(counts)
    factors, constants = [], []
    for n, covariance in zip(counts, covariances):
        shrunk = (1 - POOLED) * covariance + POOLED * pooled
        shrunk = (1 - DIAGONAL) * shrunk + DIAGONAL * np.diag(np.diag(shrunk))
        lower = np.linalg.cholesky(shrunk + FLOOR * np.eye(d))
        factors.append(np.linalg.inv(lower))
        constants.append(math.log(n / sum(counts)) - np.log(np.diag(lower)).sum())
    return Discriminant(np.array(means), np.array(factors), np.array(constants))


def scored(rows: DataFrame, model: Discriminant | Share, statistics: str = "statistics") -> DataFrame:
    """`rows` with `score`, the probability of class 1."""

    def compute(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        flat = batch.column(statistics).flatten().to_numpy()
        return {"score": pa.array(model.score(flat.reshape(-1, len(STATISTICS))))}

    return with_computed(rows, compute, "score double")
