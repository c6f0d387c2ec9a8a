"""Rows that cannot be cast, kept apart from the others with the reason, in one pass over the source."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from sluiceway import spec
from sluiceway.functions.columns import as_column, quoted

# Text in quotes, which is left alone, or the beginning of a cast.
_PIECE = re.compile(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`(?:[^`]|``)*`|(?<![\w.])cast\s*\(""", re.IGNORECASE)
_AS = re.compile(r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*"|`(?:[^`]|``)*`|[()]|(?<!\w)as(?!\w)""", re.IGNORECASE)


@dataclass(frozen=True)
class Cast:
    """One ``CAST(value AS kind)`` of an expression, its value without failing casts."""

    value: str
    kind: str


def lenient(expression: str) -> tuple[str, list[Cast]]:
    """The expression with ``TRY_CAST`` for ``CAST``, and its casts, inner ones before outer ones."""
    out, casts, at = [], [], 0
    while found := _PIECE.search(expression, at):
        out.append(expression[at : found.start()])
        if not found[0].endswith("("):
            out.append(found[0])
            at = found.end()
            continue
        depth, middle, end = 1, None, None
        for mark in _AS.finditer(expression, found.end()):
            depth += {"(": 1, ")": -1}.get(mark[0], 0)
            if mark[0].lower() == "as" and depth == 1:
                middle = mark
            if depth == 0:
                end = mark.start()
                break
        if middle is None or end is None:  # for Spark to complain about
            return expression, []
        value, inner = lenient(expression[found.end() : middle.start()])
        casts += [*inner, Cast(value.strip(), expression[middle.end() : end].strip())]
        out.append(f"TRY_CAST({value}AS{expression[middle.end() : end]})")
        at = end + 1
    return "".join([*out, expression[at:]]), casts


def _failure(columns: Sequence[spec.Column]) -> Column:
    """The first cast of a row that fails, as text; NULL if none does."""
    checks = []
    for column in columns:
        for cast in lenient(column.name)[1]:
            value = F.expr(cast.value)
            failed = value.isNotNull() & F.expr(f"TRY_CAST({cast.value} AS {cast.kind})").isNull()
            reason = f"{column.alias.strip() or column.name}: cannot cast {cast.value} to {cast.kind}: "
            text = F.coalesce(value.cast("string"), F.lit("")) if cast.kind.lower() != "binary" else F.lit("")
            checks.append(F.when(failed, F.concat(F.lit(reason), text)))
    return F.coalesce(*checks, F.lit(None).cast("string")) if checks else F.lit(None).cast("string")


def with_reason(frame: DataFrame, columns: Sequence[spec.Column]) -> DataFrame:
    """``reason`` (NULL for good rows), ``good`` (the projected columns of good rows) and ``bad`` (a bad row as it came).

    Only casts written as ``CAST(… AS …)`` in the columns are watched; other errors fail the job.
    """
    mild = [spec.Column(lenient(column.name)[0], column.alias) for column in columns]
    kept = frame.select(*(as_column(c) for c in mild)).schema if columns else frame.schema
    reason = F.col("<reason>")
    whole = F.struct(*(F.col(quoted(name)) for name in frame.columns))
    every = frame.select("*", _failure(columns).alias("<reason>"), whole.alias("<row>"))
    projected = every.select(*(as_column(c) for c in mild) if columns else map(quoted, frame.columns), "<reason>", "<row>")
    good = F.struct(*(F.col(quoted(item.name)) for item in kept))
    return projected.select(
        reason.alias("reason"), F.when(reason.isNull(), good).alias("good"), F.when(reason.isNotNull(), F.col("<row>")).alias("bad")
    )
