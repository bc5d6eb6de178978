"""The first n rows in an order, by ranges of the sort keys, for any n.

The key of row n is searched for, and rows up to that key are the result: they stay spread
over the cluster as a filter leaves them, and no task ever holds n of them. The search keeps a
range of keys that row n must be in. Each round sorts a bounded sample of the range's keys,
takes the two that most likely enclose row n, and counts in one scan how many rows stand
before and up to each of them; the same scan draws the next sample. A range of few rows is
read whole, and its keys tell the answer exactly.

Scans read the keys only, and the bounds are literals, so the first key's reaches the files'
statistics. Samples are the only keys that come to the driver.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tablecrate.operators.numbering import with_positions

# Keys of one sample; a range of so few rows is read whole.
SAMPLE = 1 << 16
# How far from the expected place the enclosing keys are taken, in standard deviations.
MARGIN = 4.0


@dataclass(frozen=True)
class SortKey:
    value: Column
    descending: bool = False
    nulls_first: bool = False

    @property
    def order(self) -> Column:
        if self.descending:
            return self.value.desc_nulls_first() if self.nulls_first else self.value.desc_nulls_last()
        return self.value.asc_nulls_first() if self.nulls_first else self.value.asc_nulls_last()


def _portable(value: Column, kind: T.DataType) -> Column:
    """A value of the same order that comes to the driver and back unchanged: time zones and
    clock changes would alter timestamps on the way."""
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(value)
    if isinstance(kind, T.TimestampNTZType):
        days = F.unix_date(value.cast("date")).cast("long")
        minutes = (days * 24 + F.hour(value)) * 60 + F.minute(value)
        return (minutes * 60 + F.second(value)) * 1_000_000 + F.date_format(value, "SSSSSS").cast("long")
    if isinstance(kind, T.YearMonthIntervalType):
        return value.cast("interval month").cast("int")
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _portable(x, kind.elementType))
    if isinstance(kind, T.StructType):
        fields = [_portable(value.getField(f.name), f.dataType).alias(f"f{i}") for i, f in enumerate(kind)]
        return F.when(value.isNotNull(), F.struct(*fields))
    return value


def _literal(value: object, kind: T.DataType) -> Column:
    if value is not None and isinstance(kind, T.ArrayType):
        return F.array(*(_literal(x, kind.elementType) for x in value)).cast(kind)
    if value is not None and isinstance(kind, T.StructType):
        return F.struct(*(_literal(value[f.name], f.dataType).alias(f.name) for f in kind)).cast(kind)
    return F.lit(value).cast(kind)


@dataclass(frozen=True)
class _Bound:
    """One sampled key, in the columns it is compared with."""

    keys: tuple[SortKey, ...]
    kinds: tuple[T.DataType, ...]
    values: tuple

    def same(self) -> Column:
        found = F.lit(True)
        for key, kind, value in zip(self.keys, self.kinds, self.values):
            found = found & key.value.eqNullSafe(_literal(value, kind))
        return found

    def before(self) -> Column:
        """Whether a row comes strictly before the bound."""
        found = F.lit(False)
        for key, kind, value in reversed(list(zip(self.keys, self.kinds, self.values))):
            own, bound = key.value, _literal(value, kind)
            if value is None:  # nulls are first, and nothing precedes them, or last
                less = F.lit(False) if key.nulls_first else own.isNotNull()
            else:
                less = F.coalesce(own > bound if key.descending else own < bound, F.lit(key.nulls_first))
            found = less | (own.eqNullSafe(bound) & found)
        return found & self._reached()

    def upto(self) -> Column:
        return (self.before() | self.same()) & self._reached()

    def _reached(self) -> Column:
        """What `before` implies for the first key alone: files can be skipped by it."""
        key, value = self.keys[0], self.values[0]
        if value is None or key.nulls_first:
            return F.lit(True)
        bound = _literal(value, self.kinds[0])
        return key.value >= bound if key.descending else key.value <= bound


def first_rows(df: DataFrame, keys: list[SortKey], n: int) -> DataFrame:
    """The first `n` rows of `df` by `keys`; which of rows equal in all keys come is open.
    `df` must give the same rows whenever it is read."""
    if n <= 0:
        return df.limit(0)
    size = df.count()
    if n >= size:
        return df
    names = [f"__key_{i}" for i in range(len(keys))]
    kinds = df.select(*(key.value.alias(name) for key, name in zip(keys, names))).schema
    own = [SortKey(_portable(k.value, f.dataType), k.descending, k.nulls_first) for k, f in zip(keys, kinds)]
    keyed = df.withColumns({name: key.value for name, key in zip(names, own)})
    named = tuple(SortKey(F.col(name), k.descending, k.nulls_first) for name, k in zip(names, keys))
    bound, before, copies = _search(keyed.select(*names), named, n, size)
    if before + copies == n:
        return keyed.where(bound.upto()).drop(*names)
    # More rows share the last key than are left to take.
    last = with_positions(keyed.where(bound.same()), "__copy").where(F.col("__copy") < n - before)
    return keyed.where(bound.before()).unionByName(last.drop("__copy")).drop(*names)


def _sorted_sample(rows: DataFrame, keys: tuple[SortKey, ...], share: float) -> pa.Table:
    drawn = rows.sample(share, seed=17) if share < 1 else rows
    return drawn.repartition(1).sortWithinPartitions(*(key.order for key in keys)).toArrow()


def _search(rows: DataFrame, keys: tuple[SortKey, ...], n: int, size: int) -> tuple[_Bound, int, int]:
    """The key of row `n`, the number of rows before it and the number of rows that have it."""
    names, kinds = rows.columns, tuple(f.dataType for f in rows.schema)

    def bound_at(sample: pa.Table, place: int) -> _Bound:
        return _Bound(keys, kinds, tuple(sample.column(i)[place - 1].as_py() for i in range(len(keys))))

    inside, base, share = rows, 0, SAMPLE / size
    sample = _sorted_sample(inside, keys, share)
    while True:
        target = n - base  # 1 for the first row of the range
        if share >= 1:
            return _exact(sample, bound_at(sample, target), target, base)
        drawn, at = sample.num_rows, target / size
        spread = MARGIN * math.sqrt(drawn * at * (1 - at)) + 1
        places = math.floor(at * drawn - spread), math.ceil(at * drawn + spread)
        low, high = (bound_at(sample, p) if 1 <= p <= drawn else None for p in places)
        flags = {
            f"__{side}_{what}": condition
            for side, b in (("low", low), ("high", high))
            if b is not None
            for what, condition in (("before", b.before()), ("upto", b.upto()))
        }
        # One scan counts around both keys and draws from between them.
        seen = Observation()
        counts = [F.count_if(F.col(name)).alias(name) for name in flags] or [F.count(F.lit(1)).alias("__rows")]
        flagged = inside.withColumns(flags)
        part, between = flagged.observe(seen, *counts), inside
        if low is not None:
            part, between = part.where(~F.col("__low_upto")), between.where(~low.upto())
        if high is not None:
            part, between = part.where(F.col("__high_upto")), between.where(high.upto())
        guess = size * max(min(places[1], drawn) - max(places[0], 0), 1) / max(drawn, 1)
        share = 1.0 if guess <= SAMPLE / 2 else SAMPLE / guess / 2
        sample = _sorted_sample(part.select(*names), keys, share)
        if sample.num_rows:
            found = {name: seen.get[name] for name in flags}
        else:  # an empty result may be planned away together with what was observed
            found = flagged.agg(*counts).first().asDict()
        low_before, low_upto = found.get("__low_before", 0), found.get("__low_upto", 0)
        high_before, high_upto = found.get("__high_before", size), found.get("__high_upto", size)
        for b, first, last in ((low, low_before, low_upto), (high, high_before, high_upto)):
            if b is not None and first < target <= last:
                return b, base + first, last - first
        if low_upto < target <= high_upto:
            inside, base, size = between, base + low_upto, high_upto - low_upto
            continue
        # Row n is outside the two keys, against the odds: go on there with a new sample.
        if target <= low_upto:
            inside, size = inside.where(low.upto()), low_upto
        else:
            inside, base, size = inside.where(~high.upto()), base + high_upto, size - high_upto
        share = SAMPLE / size
        sample = _sorted_sample(inside, keys, share)


def _exact(sample: pa.Table, bound: _Bound, target: int, base: int) -> tuple[_Bound, int, int]:
    """Of a range read whole: the rows that equal its row `target` stand next to it."""

    def same(place: int) -> bool:
        values = (sample.column(i)[place].as_py() for i in range(len(bound.values)))
        return all(a == b or (a != a and b != b) for a, b in zip(values, bound.values))

    first = last = target - 1
    while first > 0 and same(first - 1):
        first -= 1
    while last + 1 < sample.num_rows and same(last + 1):
        last += 1
    return bound, base + first, last - first + 1
