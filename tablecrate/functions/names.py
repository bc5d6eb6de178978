"""Quoting of identifiers and literals in SQL text."""

from __future__ import annotations

from collections.abc import Iterable


def backtick(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def backtick_path(*parts: str) -> str:
    return ".".join(backtick(part) for part in parts)


def double_quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def double_quoted_path(*parts: str) -> str:
    return ".".join(double_quoted(part) for part in parts)


def literal(value: str) -> str:
    """A standard string literal: only the quote is doubled."""
    return "'" + value.replace("'", "''") + "'"


def spark_literal(value: str) -> str:
    """A string literal for Spark's parser, which also reads backslash escapes."""
    return literal(value.replace("\\", "\\\\"))


def column_list(names: Iterable[str]) -> str:
    return ", ".join(backtick(name) for name in names)
