"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only.

Every source gets a target size. A source whose target is k times its size and a rest takes
each document k times for certain; the rest is a Pareto order sample: with u a random number
of the document and p the inclusion probability of its source (rest / size), documents are
ranked by u/(1-u) over p/(1-p), the random odds by the inclusion odds, and the first ones
that fill the rest are taken. The sample has a fixed size in words: it ends at the document
whose end comes nearest to the target.

Random numbers are md5 of the key and a seed, so reruns agree. Null keys share one number.
Rows of equal key, source and size are taken or left together. A null source is a source of
its own, the last one. Sources without words get target 0 and nothing is taken. An empty
table gives an empty result. No source is gathered in one task: sums are taken for narrow
ranges of u, and only the range that holds the cut is sorted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablecrate.llm.common import stored, with_facts
from tablecrate.operators.numbering import with_positions

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
# Ranges of the random number: a source's largest sort is its rows divided by this.
RANGES = 65_536


def random_number(key: Column, seed: str) -> Column:
    """In (0, 1), 52 bits, the same wherever md5 is."""
    digest = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(key.cast("string"), F.lit(""))))
    return (F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def targets(sizes: DataFrame) -> DataFrame:
    """source, source_size, target. `sizes` has one row a document: source, size.

    Sources in code point order, nulls last, weigh 5, 2, 1 and so on, and share the whole
    size. Where a share is over three times the source's size, the excess goes to the others
    by weight. In that process the size a unit of weight gets only rises, so each round is one
    aggregate over the sources with that number, until no further source is capped.
    """
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = with_positions(sources, "place", [F.col("source").asc_nulls_last()])
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("place") % len(WEIGHTS) + 1).cast("int"))
    weighed = stored(ranked.select("source", "source_size", weight.cast("long").alias("weight")), "sources")
    unit, capped_before = 0.0, -1
    while True:
        capped = F.col("weight") * F.lit(unit) > MOST_COPIES * F.col("source_size")
        found = weighed.agg(
            F.count_if(capped).alias("capped"),
            F.sum("source_size").alias("total"),
            F.sum(F.when(capped, MOST_COPIES * F.col("source_size"))).alias("given"),
            F.sum(F.when(~capped, F.col("weight"))).alias("weight"),
        ).first()
        if found["capped"] == capped_before or not found["weight"]:
            break
        capped_before = found["capped"]
        unit = ((found["total"] or 0) - (found["given"] or 0)) / found["weight"]
    most = (MOST_COPIES * F.col("source_size")).cast("double")
    return weighed.select(
        "source", "source_size", F.least(F.col("weight") * F.lit(unit), most).alias("target")
    )


def mixed(sizes: DataFrame, seed: str = "mix") -> DataFrame:
    """`sizes` (key, source, size) with source_size, target and copies.

    `sizes` must be cheap to read again: it is used for the sums, the cut and the result.
    """
    goals = targets(sizes).withColumns(
        {
            "whole": F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
            .otherwise(0)
            .cast("int"),
        }
    )
    goals = goals.withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    goals = goals.withColumn("chance", F.when(F.col("source_size") > 0, F.col("rest") / F.col("source_size")))
    goals = stored(goals, "targets")

    # Odds of u over odds of p. It rises with u, so ranges of u are ranges of rank.
    u, p = F.col("u"), F.col("chance")
    rows = (
        sizes.withColumn("u", random_number(F.col("key"), seed))
        .join(goals.withColumnRenamed("source", "goal_source"), F.col("source").eqNullSafe(F.col("goal_source")))
        .drop("goal_source")
        .withColumn("rank", F.when(p > 0, (u / (1 - u)) / (p / (1 - p))))
        .withColumn("range", F.floor(u * RANGES).cast("int"))
    )
    order = F.struct("rank", F.col("key").alias("k"), F.col("size").alias("n"))
    asked = rows.where((F.col("chance") > 0) & (F.col("size") > 0))
    sums = asked.groupBy("source", "range").agg(F.sum("size").alias("in_range"), F.first("rest").alias("rest"))
    upto = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    cut_range = (
        sums.withColumn("upto", F.sum("in_range").over(upto))
        .where(F.col("upto") > F.col("rest"))
        .groupBy("source")
        .agg(F.min_by(F.struct("range", (F.col("upto") - F.col("in_range")).alias("before")), "range").alias("cut"))
        .select(F.col("source").alias("cut_source"), "cut.range", "cut.before")
        .withColumnRenamed("range", "cut_range")
    )
    cut_range = stored(cut_range, "cut_ranges")
    same = F.col("source").eqNullSafe(F.col("cut_source"))
    edge = (
        asked.join(cut_range, same & (F.col("range") == F.col("cut_range")))
        .groupBy("source", order.alias("order"), "rest", "before")
        .agg(F.sum("size").alias("size"))
    )
    within = Window.partitionBy("source").orderBy("order").rowsBetween(Window.unboundedPreceding, 0)
    edge = edge.withColumn("end", F.col("before") + F.sum("size").over(within))
    # Taken if its end is nearer to the target than its start.
    nearer = F.col("end") - F.col("rest") <= F.col("rest") - (F.col("end") - F.col("size"))
    last = edge.where(nearer).groupBy("source").agg(F.max("order").alias("last_order"))
    cuts = cut_range.join(
        last.withColumnRenamed("source", "last_source"),
        F.col("cut_source").eqNullSafe(F.col("last_source")),
        "left",
    ).drop("last_source")
    taken = F.coalesce(
        (F.col("range") < F.col("cut_range"))
        | ((F.col("range") == F.col("cut_range")) & F.coalesce(order <= F.col("last_order"), F.lit(False))),
        F.col("chance") > 0,  # no cut: the whole source does not exceed the rest
        F.lit(False),
    )
    # Many rows ask for the cut of one source: it is written and copied, see `with_facts`.
    return (
        with_facts(rows, stored(cuts, "cuts"), "source", "cut_source", F.col("key"))
        .withColumn("copies", F.col("whole") + taken.cast("int"))
        .select(*sizes.columns, "source_size", "target", "copies")
    )
