"""Column-in, column-out helpers (E-01..E-16).  All are built-in Spark expressions, so
they stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def safe_divide(a, b) -> Column:
    """``a / b`` that gives NULL for a zero divisor (ANSI mode raises on plain ``/``)."""
    return F.try_divide(_c(a), _c(b))


def safe_int(x) -> Column:
    """R's ``as.integer`` on text: NULL for text that is not a number."""
    return _c(x).try_cast("int")


def last_chars(x, n: int) -> Column:
    """Last ``n`` characters (``substr(x, nchar(x)-n+1, nchar(x))``)."""
    return F.right(_c(x), F.lit(n))


def year_from_text(x, missing: str = "1900") -> Column:
    """Year as the last four characters of a date text; empty text becomes ``missing``.

    ``substr(x, nchar(x) - 4 + 1, 4)`` then ``ifelse(year == "", "1900", year)`` then
    ``as.integer``.  A NULL text stays NULL (R's ``ifelse`` on NA gives NA).
    """
    x = _c(x)
    tail = F.when(F.length(x) >= 4, x.substr(F.length(x) - 3, F.lit(4))).otherwise(x)
    txt = F.when(tail == "", F.lit(missing)).otherwise(tail)
    return txt.try_cast("int")


def code_to_label(x, codes: Sequence, labels: Sequence[str]) -> Column:
    """R ``factor(x, labels=...)``: the sorted distinct codes take the labels in order."""
    x = _c(x)
    pairs = sorted(zip(codes, labels), key=lambda p: p[0])
    expr = None
    for code, lab in pairs:
        expr = F.when(x == F.lit(code), F.lit(lab)) if expr is None else expr.when(x == F.lit(code), F.lit(lab))
    return expr


def indicator(x, value) -> Column:
    """``as.numeric(x == value)`` — a 0/1 double response."""
    return (_c(x) == F.lit(value)).cast("double")


def gaussian_kernel(x, mu, sigma) -> Column:
    """``exp(-(x - mu)^2 / (2 sigma^2))``."""
    sigma = sigma if isinstance(sigma, Column) else F.lit(sigma)
    return F.exp(-F.pow(_c(x) - mu, 2) / (F.lit(2.0) * F.pow(sigma, 2)))


def number_sequence(start, stop, step) -> Column:
    """R ``seq(start, stop, step)`` as an array column (explode it for rows)."""
    n = int(round((stop - start) / step)) + 1
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.round(F.lit(start) + i * F.lit(step), 10))
