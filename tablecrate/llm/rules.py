"""Quality rules as a short-circuit cascade, in DataFrame functions only.

Each rule is a condition under which a text fails. On a sample, the share each rule rejects
and the work it does (characters or words it visits, times a constant for each visit) are
estimated; the cascade tries the rules by rejection per cost, and stops at the first that
rejects. The order changes the time, never the verdict.

Null text counts as empty: no words, so it fails the base rule. A text is one row, however
long: its windows are compared within the row, by sorting. Columns of the input that have
the name of a result are replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecrate.llm.common import stored, unused, without_space, words

WINDOW = 5
SYMBOLS = "#*$%&|<>"
SAMPLE_ROWS = 5_000


@dataclass(frozen=True)
class Rule:
    """`fails` over the columns text, words, n_words, word_chars, n_symbols, n_dup_lines,
    n_lines; `visits` is what it walks through, at `unit` nanoseconds each."""

    name: str
    fails: Column
    visits: Column
    unit: float


def standard_rules() -> list[Rule]:
    """The limits of the usual web-text heuristics, on the lenient side."""
    text, n = F.coalesce(F.col("text"), F.lit("")), F.col("n_words")
    chars = F.length(text)
    letters = F.length(F.regexp_replace(text, r"\P{L}", ""))
    capitals = F.length(F.regexp_replace(text, r"\P{Lu}", ""))
    lettered = F.size(F.filter("words", lambda w: w.rlike(r"\p{L}")))
    one = F.lit(1)
    return [
        Rule("symbols", 100 * F.col("n_symbols") > 25 * n, one, 1.0),
        Rule("repeated_lines", 100 * F.col("n_dup_lines") > 50 * F.col("n_lines"), one, 1.0),
        Rule("word_length", (F.col("word_chars") < 2 * n) | (F.col("word_chars") > 25 * n), one, 1.0),
        Rule("capitals", 100 * capitals > 60 * letters, chars, 40.0),
        Rule("lettered_words", 100 * lettered < 50 * n, n, 150.0),
        Rule("distinct_words", 100 * F.size(F.array_distinct("words")) < 5 * n, n, 60.0),
    ]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body(value)` with the value computed once, also where an optimizer copies columns
    into conditions."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def repeated_words(words: Column) -> Column:
    """How many words stand in a window of five that occurs at least twice."""
    zero = F.lit(0).cast("long")

    def hashes(held: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(held) - WINDOW)
        return F.transform(places, lambda i: F.xxhash64(*(F.get(held, i + k) for k in range(WINDOW))))

    def covered(places: Column) -> Column:
        step = lambda p, j: F.least(F.lit(WINDOW), F.coalesce(F.get(places, j + 1) - p, F.lit(WINDOW)))
        return F.aggregate(F.transform(places, step), zero, lambda total, more: total + more)

    def among(ordered: Column) -> Column:
        like = lambda j, x: F.get(ordered, j)["g"].eqNullSafe(x["g"])
        twin = lambda x, j: ((j > 0) & like(F.greatest(j - 1, F.lit(0)), x)) | like(j + 1, x)
        places = F.transform(F.filter(ordered, twin), lambda x: x["i"])
        return _let(F.sort_array(places), covered)

    def sorted_windows(grams: Column) -> Column:
        pairs = F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i")))
        # Only texts with a repeated window pay for the sort.
        distinct = F.size(F.array_distinct(grams)) == F.size(grams)
        return F.when(distinct, zero).otherwise(_let(F.sort_array(pairs), among))

    return F.when(F.size(words) < WINDOW, zero).otherwise(_let(hashes(words), sorted_windows))


def measured(df: DataFrame) -> DataFrame:
    """`df` with the base counts n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, and what rules use besides: words, n_lines."""
    text = F.coalesce(F.col("text"), F.lit(""))
    (lines,) = unused(df, "lines")
    with_word = F.filter(F.split(text, "\n"), lambda line: F.length(without_space(line)) > 0)
    df = df.withColumns({"words": words(F.col("text")), lines: with_word})
    df = df.withColumns(
        {
            "n_words": F.size("words").cast("long"),
            "word_chars": F.length(without_space(text)).cast("long"),
            "n_symbols": (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long"),
            "n_lines": F.size(lines).cast("long"),
            "n_dup_lines": (F.size(lines) - F.size(F.array_distinct(lines))).cast("long"),
            "n_repeat_words": repeated_words(F.col("words")),
        }
    ).drop(lines)
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return df.withColumn("base_failed", failed)


def in_order(sample: DataFrame, rules: list[Rule]) -> list[Rule]:
    """The rules by rejection per cost, from one pass over a measured sample."""
    sums = [F.avg(F.coalesce(r.fails, F.lit(False)).cast("double")).alias(f"r{i}") for i, r in enumerate(rules)]
    work = [F.avg(r.visits.cast("double")).alias(f"c{i}") for i, r in enumerate(rules)]
    found = sample.agg(*sums, *work).first()
    gain = lambda i: (found[f"r{i}"] or 0.0) / max(1.0, (found[f"c{i}"] or 0.0) * rules[i].unit)
    cost = lambda i: (found[f"c{i}"] or 0.0) * rules[i].unit
    return [rules[i] for i in sorted(range(len(rules)), key=lambda i: (-gain(i), cost(i), i))]


def cascade(rules: list[Rule]) -> Column:
    """True where no rule fails; CASE stops at the first that does. A null condition is no
    failure."""
    verdict = F.when(F.col("base_failed"), F.lit(False))
    for rule in rules:
        verdict = verdict.when(F.coalesce(rule.fails, F.lit(False)), F.lit(False))
    return verdict.otherwise(F.lit(True))


def judged(df: DataFrame, rules: list[Rule] | None = None) -> DataFrame:
    """`df` (with a column text) with the base counts and `kept`."""
    rules = standard_rules() if rules is None else rules
    rows = df.count()  # from file footers
    share = min(1.0, SAMPLE_ROWS / max(1, rows))
    sample = stored(measured(df.select("text").sample(False, share, seed=7)), "rule_sample")
    sample = sample.where(~F.col("base_failed"))
    return measured(df).withColumn("kept", cascade(in_order(sample, rules))).drop("words", "n_lines")
