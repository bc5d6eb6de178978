"""Selections: projection, WHERE, ORDER BY and LIMIT over one `schema.object`.

The text is only cut into its clauses here. Expressions are left to Spark's own parser.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablecrate.errors import CrateError
from tablecrate.functions.digest import row_hash
from tablecrate.functions.names import backtick, double_quoted, double_quoted_path
from tablecrate.operators.numbering import reads_files
from tablecrate.operators.ranges import SortKey, first_rows
from tablecrate.session import scratch_dir

_FLAGS = re.IGNORECASE | re.ASCII | re.DOTALL
_QUOTED = re.compile(r"""'(?:[^']|'')*'|"(?:[^"]|"")*\"""", re.DOTALL)
_INNER_PARENS = re.compile(r"\([^()]*\)")
_STATEMENT = re.compile(r"\s*select(?!\w)(?P<columns>.*?)(?<!\w)from(?!\w)(?P<rest>.*)", _FLAGS)
_CLAUSES = re.compile(
    r"\s*(?:where(?!\w)(?P<where>.*?))?"
    r"(?:(?<!\w)order\s+by(?!\w)(?P<order_by>.*?))?"
    r"(?:(?<!\w)limit(?!\w)(?P<limit>.*))?",
    _FLAGS,
)
_NAME = r'"(?:[^"]|"")+"|'
_RELATION = re.compile(
    rf"\s*(?P<schema>{_NAME}\w+)\s*\.\s*(?P<name>{_NAME}\w+)(?P<tail>.*)", _FLAGS
)
_COLUMN = re.compile(rf"{_NAME}[a-z_]\w*", _FLAGS)
_EXCEPT = re.compile(r"\*\s*except\s*\((?P<list>.*)\)", _FLAGS)
_SORT_ITEM = re.compile(
    r"(?P<key>.*?)(?:(?<!\w)(?P<direction>asc|desc)(?!\w)\s*)?"
    r"(?:(?<!\w)nulls\s+(?P<nulls>first|last))?\s*",
    _FLAGS,
)


@dataclass(frozen=True)
class SortItem:
    key: str
    descending: bool
    nulls_first: bool

    def sort_key(self, df: DataFrame, outputs: list[str]) -> SortKey:
        if self.key.isdigit():
            position = int(self.key)
            if not 1 <= position <= len(outputs):
                raise CrateError(f"ORDER BY position {self.key} is not in the select list")
            value = df[backtick(outputs[position - 1])]
        else:
            # In parentheses, so that a stray word is an error and not an alias.
            value = F.expr(f"({spark_text(self.key)})")
        return SortKey(value, self.descending, self.nulls_first)

    def column(self, df: DataFrame, outputs: list[str]) -> Column:
        return self.sort_key(df, outputs).order


@dataclass(frozen=True)
class Selection:
    text: str
    schema: str
    name: str
    columns: tuple[str, ...] | None = None
    excluded: tuple[str, ...] | None = None
    where: str | None = None
    order_by: str | None = None
    limit: int | None = None

    @property
    def source(self) -> tuple[str, str]:
        return self.schema, self.name

    @property
    def projection(self) -> str:
        """Code stored in manifests."""
        if self.columns is not None:
            return "columns_list"
        return "*" if self.excluded is None else "except_list"

    @property
    def has_clauses(self) -> bool:
        return (self.where, self.order_by, self.limit) != (None, None, None)

    @property
    def sort_items(self) -> list[SortItem]:
        if self.order_by is None:
            return []
        return [_sort_item(item) for item in _split_commas(self.order_by)]

    def effective_columns(self, available: list[str]) -> list[str]:
        listed = self.columns if self.columns is not None else self.excluded
        kind = "select" if self.columns is not None else "except"
        label = f"{self.schema}.{self.name}"
        for index, column in enumerate(listed or ()):
            if column not in available:
                raise CrateError(f"column {column!r} of {self.text!r} is not in {label}")
            if column in listed[:index]:
                raise CrateError(f"column {column!r} is duplicated in the {kind} list of {self.text!r}")
        if self.columns is not None:
            return list(self.columns)
        kept = [column for column in available if column not in (self.excluded or ())]
        if not kept:
            raise CrateError(f"no columns are left to select from {label}")
        if len(set(kept)) < len(kept):
            raise CrateError(f"{label} has duplicate column names")
        return kept

    def canonical_sql(self, columns: list[str]) -> str:
        sql = (
            f"SELECT {', '.join(double_quoted(column) for column in columns)}"
            f" FROM {double_quoted_path(self.schema, self.name)}"
        )
        if self.where is not None:
            sql += f" WHERE {self.where}"
        if self.order_by is not None:
            sql += f" ORDER BY {self.order_by}"
        if self.limit is not None:
            sql += f" LIMIT {self.limit}"
        return sql

    def rows(self, source: DataFrame) -> DataFrame:
        """The selected rows of `source`, in the order asked for. Filter, sort and limit may
        use columns that are not selected."""
        outputs = self.effective_columns(source.columns)
        kept = source.where(spark_text(hashed_exclusions(self.where))) if self.where is not None else source
        if self.limit is not None:
            kept = settled(kept)
        keys = [item.sort_key(kept, outputs) for item in self.sort_items]
        projected = [kept[backtick(column)] for column in outputs]
        if not keys and self.limit is None:
            return kept.select(*projected)
        # Equal keys would all land in one range partition; the hash spreads them.
        ties = row_hash(kept.select(*projected))
        if self.limit is not None:
            # A limit without an order takes the rows of least hash, so reruns agree.
            kept = first_rows(kept, [*keys, SortKey(ties)], self.limit)
            if not keys:
                return kept.select(*projected)
        spread = [ties]
        if reads_files(kept):
            # Copies of one row are told apart by a row number, which needs the fixed order of
            # files: behind a shuffle, a repeated task could number them anew.
            spread.append(F.monotonically_increasing_id())
        return kept.orderBy(*(key.order for key in keys), *spread).select(*projected)


def settled(df: DataFrame) -> DataFrame:
    """`df`, or a written copy if it gives other rows each time it is read, as rand() does."""
    if df._jdf.queryExecution().analyzed().deterministic():
        return df
    path = scratch_dir(df.sparkSession, "settled")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def parse(text: str) -> Selection:
    text = text.strip()
    masked = _mask(text)
    statement = _STATEMENT.fullmatch(masked)
    if not statement:
        raise CrateError(f"expected SELECT ... FROM schema.object, got {text!r}")
    columns, excluded = _projection(text[slice(*statement.span("columns"))].strip())

    relation = _RELATION.fullmatch(text, statement.start("rest"))
    if not relation:
        raise CrateError(f"the source of {text!r} must be fully qualified as schema.object")
    tail_start = relation.start("tail")
    if ";" in text[tail_start:]:
        raise CrateError(f"the clauses of {text!r} must not contain ';'")
    clauses = _CLAUSES.fullmatch(masked, tail_start)
    if not clauses:
        raise CrateError(
            f"unsupported clause in {text!r}: only WHERE, ORDER BY and LIMIT may follow, in this order"
        )

    def clause(group: str) -> str | None:
        if clauses[group] is None:
            return None
        body = text[slice(*clauses.span(group))].strip()
        if not body:
            raise CrateError(f"empty {group.replace('_', ' ').upper()} clause in {text!r}")
        return body

    selection = Selection(
        text=text,
        schema=_identifier(relation["schema"]),
        name=_identifier(relation["name"]),
        columns=columns,
        excluded=excluded,
        where=clause("where"),
        order_by=clause("order_by"),
        limit=_limit(clause("limit"), text),
    )
    selection.sort_items  # reject a malformed ORDER BY list now
    return selection


def full_table(schema: str, name: str) -> Selection:
    return parse(f"select * from {double_quoted_path(schema, name)}")


def spark_text(expression: str) -> str:
    """Selection text follows the SQL standard, where a backslash in a string is an
    ordinary character; Spark's parser wants it doubled."""
    return _QUOTED.sub(
        lambda match: match[0].replace("\\", "\\\\") if match[0][0] == "'" else match[0], expression
    )


_EXCLUSION = re.compile(r"(?P<lead>\s*)(?P<value>[^()=<>!]*?)(?<!\w)not\s+in\s*(?P<list>\0+)\s*", _FLAGS)
_QUERY = re.compile(r"\(\s*(?:select|with)(?!\w).*\)", _FLAGS)
# Words that bind looser than NOT IN, or make it part of something else.
_OTHER_WORDS = re.compile(r"(?<!\w)(?:or|not|between|like|rlike|is|case|when|then|else|end|exists)(?!\w)", _FLAGS)


def hashed_exclusions(where: str) -> str:
    """`where` with each condition `value NOT IN (SELECT ...)` in its three-valued meaning.

    Spark runs NOT IN as a broadcast of the whole list, or as a nested loop. Here one aggregate
    tells whether the list is empty or holds a NULL, and the rest is a lookup of equal values,
    which Spark hashes or sorts. Only conditions joined by AND at the top are rewritten;
    elsewhere the text stays.
    """
    masked = _mask(where)
    cuts = [(0, 0), *(m.span() for m in re.finditer(r"(?<!\w)and(?!\w)", masked, _FLAGS)), (len(where), len(where))]
    parts = []
    for (_, start), (end, after) in zip(cuts, cuts[1:]):
        found = _EXCLUSION.fullmatch(masked, start, end)
        value, query = (where[slice(*found.span(g))] for g in ("value", "list")) if found else ("", "")
        plain = value.strip() and not _OTHER_WORDS.search(found["value"]) and _QUERY.fullmatch(query)
        parts.append((f" {_excluded(value.strip(), query)} " if plain else where[start:end]) + where[end:after])
    return "".join(parts)


def _excluded(value: str, query: str) -> str:
    listed = f"{query} AS listed__(item__)"
    return (
        f"((SELECT count(*) FROM {listed}) = 0 OR (({value}) IS NOT NULL"
        f" AND (SELECT count(*) = count(item__) FROM {listed})"
        f" AND NOT EXISTS (SELECT 1 FROM {listed} WHERE item__ = ({value}))))"
    )


def _mask(text: str) -> str:
    """Blank out quoted text and parentheses, keeping every offset."""

    def blank(match: re.Match) -> str:
        return "\0" * len(match[0])

    text = _QUOTED.sub(blank, text)
    while True:
        shorter = _INNER_PARENS.sub(blank, text)
        if shorter == text:
            return text
        text = shorter


def _split_commas(text: str) -> list[str]:
    cuts = [-1, *(m.start() for m in re.finditer(",", _mask(text))), len(text)]
    return [text[a + 1 : b].strip() for a, b in zip(cuts, cuts[1:])]


def _projection(text: str) -> tuple[tuple[str, ...] | None, tuple[str, ...] | None]:
    if text == "*":
        return None, None
    if text.startswith("*"):
        excepted = _EXCEPT.fullmatch(text)
        if not excepted:
            raise CrateError(f"unsupported projection {text!r}")
        return None, _identifiers(excepted["list"])
    return _identifiers(text), None


def _identifiers(text: str) -> tuple[str, ...]:
    items = _split_commas(text)
    for item in items:
        if not _COLUMN.fullmatch(item):
            raise CrateError(f"invalid column name {item!r} in {text!r}: only plain names are allowed")
    return tuple(_identifier(item) for item in items)


def _identifier(token: str) -> str:
    if token.startswith('"'):
        return token[1:-1].replace('""', '"')
    return token.lower()


def _sort_item(text: str) -> SortItem:
    match = _SORT_ITEM.fullmatch(_mask(text))
    key = text[slice(*match.span("key"))].strip()
    if not key:
        raise CrateError(f"invalid ORDER BY item {text!r}")
    descending = (match["direction"] or "asc").lower() == "desc"
    # NULLs count as larger than any value, unless the text says otherwise.
    nulls_first = match["nulls"].lower() == "first" if match["nulls"] else descending
    return SortItem(key, descending, nulls_first)


def _limit(text: str | None, statement: str) -> int | None:
    if text is None:
        return None
    if not re.fullmatch(r"\+?[0-9]+", text):
        raise CrateError(f"LIMIT must be one non-negative integer, got {text!r} in {statement!r}")
    if int(text) >= 1 << 63:
        raise CrateError(f"LIMIT must be below 2^63, got {text} in {statement!r}")
    return int(text)
