"""Column expressions shared by the reports and the quality rules.

All of these are built-in Spark expressions (JVM side, inside whole-stage
codegen); none is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


MOST_MONEY = 1e15  # from here on a double does not tell cents apart


def money_sum(price: str | Column) -> Column:
    """Exact sum of a money column, in cents, to a millionth of a unit.

    Summing raw doubles depends on the order rows arrive in. Whole units and
    millionths are summed as longs, which does not, stays in generated code and
    adds parts of a cent up too; one decimal is made of the two sums. NaN and
    amounts of ``MOST_MONEY`` and more count as missing.
    """
    amount = col_(price).cast("double")
    amount = F.when(F.abs(amount) < MOST_MONEY, amount)
    whole = F.floor(amount)
    parts = F.round((amount - whole) * 1_000_000).cast("long")
    units = F.sum(whole).cast("decimal(20,0)") * 100
    return (units + F.sum(parts).cast("decimal(20,0)") / 10_000).cast("decimal(30,4)")


def from_cents(total: str | Column) -> Column:
    return col_(total) / F.lit(100.0)


def pct(num: str | Column, den: str | Column, scale: int) -> Column:
    """``round(num * 100.0 / den, scale)`` as double; NULL when den is 0."""
    ratio = F.try_divide(col_(num).cast("double") * F.lit(100.0),
                         col_(den).cast("double"))
    return F.round(ratio, scale)


def ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den`` as double; NULL when den is 0 (ANSI-safe)."""
    return F.try_divide(col_(num).cast("double"), col_(den).cast("double"))


def correlation(x: Column, y: Column) -> Column:
    """Pearson correlation; NULL where a side does not vary (``corr`` fails)."""
    return F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))


def day_diff(start: str | Column, end: str | Column) -> Column:
    """Calendar-day boundaries crossed from ``start`` to ``end``.

    Same as DATEDIFF(DAY, start, end): 23:59 to 00:01 next day is 1.
    """
    return F.datediff(col_(end).cast("date"), col_(start).cast("date"))


def month_label(ts: str | Column) -> Column:
    return F.date_format(col_(ts), "yyyy-MM")


# every character that Unicode counts as white space (a Java pattern: plain \\s
# knows the ASCII ones only), and the four separators that text libraries strip
_BLANK = r"[\s\p{IsWhite_Space}\x1c-\x1f]"


def strip_ws(c: str | Column) -> Column:
    """Remove leading/trailing whitespace of any kind, no-break spaces too."""
    return F.regexp_replace(col_(c), f"^{_BLANK}+|{_BLANK}+$", "")


def add_days(ts: str | Column, days: str | Column | int) -> Column:
    n = F.lit(days) if isinstance(days, int) else col_(days)
    return F.timestamp_add("DAY", n.cast("int"), col_(ts))
