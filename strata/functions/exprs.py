"""Column-expression builders.

Every helper returns a ``Column`` made only of Spark built-ins, so the
expressions stay inside whole-stage codegen and need no Python at run time.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col_of(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_label(c: ColumnOrName, default: str, null_tokens: Sequence[str] = ("N/A", "NA", "Unknown", "")) -> Column:
    """Trim a label; NULL or a placeholder token becomes ``default``."""
    t = F.trim(col_of(c))
    return F.when(t.isNull() | t.isin(*null_tokens), F.lit(default)).otherwise(t)


def decode_map(mapping: Mapping, key: ColumnOrName) -> Column:
    """Literal code -> name lookup (B12). Missing keys give NULL."""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return m[col_of(key)]


def ladder(cases: Iterable[tuple[Column, str]], default: str) -> Column:
    """First-match ``when`` chain."""
    expr = None
    for cond, label in cases:
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def row_hash(cols: Sequence[ColumnOrName], sep: str = "|", null_token: str | None = None) -> Column:
    """SHA-256 hex of the text of ``cols`` joined by ``sep``.

    ``concat_ws`` skips NULLs, so with two neighbouring nullable keys the rows
    (NULL, x) and (x, NULL) collide; ``null_token`` closes that gap (S-13).
    """
    parts = []
    for c in cols:
        s = col_of(c).cast("string")
        parts.append(F.coalesce(s, F.lit(null_token)) if null_token is not None else s)
    return F.sha2(F.concat_ws(sep, *parts), 256)


def pct(num: ColumnOrName, den: ColumnOrName, digits: int = 2) -> Column:
    """Percentage that is NULL on a zero divisor instead of failing under ANSI."""
    return F.round(F.try_divide(col_of(num) * F.lit(100.0), col_of(den)), digits)


def mean(c: ColumnOrName, scale: int | None = None) -> Column:
    """Average; exact for a measure already rounded to ``scale`` decimals.

    Such measures are summed as scaled whole numbers, so the quotient is one correctly
    rounded division: an exact tie such as (17.703 + 18.507) / 2 = 18.105 stays
    a tie for the half-up ``round``, whatever the partitioning. A double sum
    would let the summation order decide it. The sum is a decimal, so no measure
    overflows it. NaN and infinite values take no part in an average.
    """
    x = finite(c)
    if scale is None:
        return F.avg(x)
    m = 10 ** scale
    total = F.try_sum(F.round(x * F.lit(m)).try_cast("decimal(38,0)")).cast("double")
    return F.try_divide(total, F.count(x) * F.lit(m))


def total(c: ColumnOrName, scale: int = 6) -> Column:
    """Exact sum of the finite values, each to ``scale`` decimals; NULL where there is none.

    Whole numbers are added, so neither the partitioning nor the order of rows can change the result, and a NaN or an
    infinite value takes no part instead of taking the whole sum with it.
    """
    m = 10 ** scale
    return F.try_sum(F.round(finite(c) * F.lit(m)).try_cast("decimal(38,0)")).cast("double") / F.lit(m)


def finite(c: ColumnOrName) -> Column:
    """The value, or NULL where it is NaN or infinite."""
    x = col_of(c)
    d = x.cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) < F.lit(float("inf"))), x)


def avg_where(c: ColumnOrName, cond: Column | None = None, digits: int = 2, scale: int | None = None) -> Column:
    """Rounded average over the rows where ``cond`` is true."""
    x = col_of(c) if cond is None else F.when(cond, col_of(c))
    return F.round(mean(x, scale), digits)


def count_true(c: ColumnOrName) -> Column:
    """Number of rows where a boolean is true; NULL is ignored."""
    return F.sum(col_of(c).cast("int"))


def rate_true(c: ColumnOrName, digits: int = 2) -> Column:
    """Percentage of true among the non-NULL booleans."""
    return F.round(F.avg(col_of(c).cast("int")) * F.lit(100.0), digits)


def positive_or_null(c: ColumnOrName) -> Column:
    """0, negative or NULL -> NULL."""
    return F.when(col_of(c) > 0, col_of(c))


def any_true(flags: Sequence[ColumnOrName]) -> Column:
    """True when any flag is true; NULL flags count as false, result never NULL."""
    ints = [F.coalesce(col_of(f), F.lit(False)).cast("int") for f in flags]
    if not ints:
        return F.lit(False)
    if len(ints) == 1:
        return ints[0] == 1
    return F.greatest(*ints) == 1


def month_start(ym: str) -> _dt.date:
    y, m = map(int, ym.split("-"))
    return _dt.date(y, m, 1)


def next_month_start(ym: str) -> _dt.date:
    y, m = map(int, ym.split("-"))
    return _dt.date(y + (m == 12), m % 12 + 1, 1)


def in_month(ts: ColumnOrName, ym: ColumnOrName) -> Column:
    """``ts`` falls in month ``ym`` ('yyyy-MM').

    With a literal month the test is a half-open range, which Parquet can push
    down; with a month column it is a text comparison of the formatted month.
    """
    t = col_of(ts)
    if isinstance(ym, str):
        return in_months(t, ym, ym)
    return F.date_format(t, "yyyy-MM") == ym


def in_months(ts: ColumnOrName, first: str, last: str) -> Column:
    """``ts`` falls in the months ``first`` to ``last``: a half-open range of literals, which Parquet can push down."""
    t = col_of(ts)
    return (t >= F.lit(month_start(first).isoformat())) & (t < F.lit(next_month_start(last).isoformat()))


def minutes_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole-second difference in minutes (B16 before rounding).

    Each value is truncated to the second before subtracting, like a difference
    of epoch seconds; on wall-clock (NTZ) values the difference does not depend on
    the session time zone, so a trip across a daylight-saving change keeps its
    wall-clock duration (S-21).
    """
    s = F.date_trunc("second", col_of(start))
    e = F.date_trunc("second", col_of(end))
    return F.timestamp_diff("SECOND", s, e) / F.lit(60)
