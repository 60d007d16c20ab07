"""Column expressions with the reference's null / NaN / zero-division rules.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so
it stays inside whole-stage codegen; nothing runs in Python per row.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

NAN = float("nan")
POS_INF = float("inf")
NEG_INF = float("-inf")

# Days are stored as negative offsets before the application date.
DAYS_PER_YEAR = -365.25

# Money columns carry at most four fractional digits; summing them as exact
# integer units of 10^-4 makes every total independent of partitioning.
MONEY_SCALE = 4
MONEY_TYPE = f"decimal(18,{MONEY_SCALE})"


def col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: ColumnLike, den: ColumnLike, on_zero: str = "ieee") -> Column:
    """``num / den`` in double precision with an explicit zero rule.

    ``ieee``: x/0 is +inf / -inf / NaN (0/0, NaN/0) like float division,
    including the sign of a negative zero;
    ``null``: x/0 is null; ``zero``: x/0 is 0. A null operand gives null.
    """
    n = col(num).cast("double")
    d = col(den).cast("double")
    quotient = F.try_divide(n, d)
    if on_zero == "ieee":
        # sign of the infinity = sign of num XOR sign bit of the zero (-0.0
        # is the only zero whose text starts with "-"; Spark compares -0.0 == 0)
        neg_zero = d.cast("string").startswith("-")
        at_zero = (
            F.when(n.isNull(), F.lit(None).cast("double"))
            .when(F.isnan(n) | (n == 0), F.lit(NAN))
            .when((n < 0) != neg_zero, F.lit(NEG_INF))
            .otherwise(F.lit(POS_INF))
        )
    elif on_zero == "null":
        at_zero = F.lit(None).cast("double")
    elif on_zero == "zero":
        at_zero = F.when(n.isNotNull(), F.lit(0.0))
    else:
        raise ValueError(f"unknown on_zero rule: {on_zero!r}")
    return F.when(d == 0, at_zero).otherwise(quotient)


def years_from_days(days: ColumnLike) -> Column:
    """Relative days (negative = past) to positive years."""
    return col(days).cast("double") / F.lit(DAYS_PER_YEAR)


def flag_gt(c: ColumnLike, threshold: float) -> Column:
    """``(c > threshold)`` as int; null stays null."""
    return (col(c) > F.lit(threshold)).cast("int")


def null_above(c: ColumnLike, threshold: float) -> Column:
    """Replace values above a sentinel threshold with null."""
    return F.when(col(c) > F.lit(threshold), F.lit(None)).otherwise(col(c))


def is_missing_flag(c: ColumnLike) -> Column:
    return col(c).isNull().cast("int")


def fill(c: ColumnLike, value) -> Column:
    """Fill nulls only; NaN is a value and is kept (unlike ``na.fill``)."""
    return F.coalesce(col(c), F.lit(value))


def row_sum(cols: Sequence[ColumnLike]) -> Column:
    """Null-propagating horizontal sum (``a + b + ...``)."""
    return reduce(add, [col(c) for c in cols])


def row_sum_skip_null(cols: Sequence[ColumnLike]) -> Column:
    """Horizontal sum that treats null as 0 (``sum_horizontal``)."""
    return reduce(add, [F.coalesce(col(c), F.lit(0)) for c in cols])


def bucketize(c: ColumnLike, cuts: Sequence[float], labels: Sequence[str]) -> Column:
    """``c < cuts[0] -> labels[0]`` ... else ``labels[-1]``.

    A null value matches no ``<`` test and falls to the last label.
    """
    if len(labels) != len(cuts) + 1:
        raise ValueError("need one more label than cuts")
    expr = None
    for cut, label in zip(cuts, labels):
        cond = col(c) < F.lit(cut)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(labels[-1])) if expr is not None else F.lit(labels[-1])


def in_set_flag(c: ColumnLike, values: Iterable[str]) -> Column:
    """1 if the value is in the set, else 0 (null gives 0)."""
    return F.when(col(c).isin(list(values)), F.lit(1)).otherwise(F.lit(0))


# ---------------------------------------------------------------- aggregates


def count_if(cond: Column) -> Column:
    """Rows where ``cond`` is true (null counts as false)."""
    return F.count(F.when(cond, F.lit(1)))


def sum0(c: ColumnLike, exact_scale: int | None = None) -> Column:
    """Sum that is 0 (not null) for an all-null group.

    ``exact_scale`` sums a fractional column exactly at that scale and
    returns a double, so the total does not depend on the order in which
    partitions are merged.
    """
    return F.coalesce(exact_sum(c, exact_scale), F.lit(0).cast(_sum_type(exact_scale)))


def exact_sum(c: ColumnLike, exact_scale: int | None = None) -> Column:
    """Sum; with ``exact_scale``, a double sum that does not depend on the
    order of the rows where the values allow it.

    Values that are whole multiples of 10^-scale (and below 2^40) are added as
    integer units, held in two longs so that no number of rows overflows. Any
    other value of a group (more digits, larger, NaN, infinite) is added as a
    double beside them: nothing is rounded away, and NaN and infinities follow
    IEEE rules. That third total is null in most groups, so the partial rows of
    a shuffle hold little more than the units."""
    if exact_scale is None:
        return F.sum(col(c))
    x = col(c).cast("double")
    fits, units = money_units(x, exact_scale)
    high, low = F.sum(F.shiftright(units, 32)), F.sum(units.bitwiseAND(F.lit(0xFFFFFFFF)))
    total = (high.cast("double") * F.lit(float(1 << 32)) + low.cast("double")) / F.lit(float(10 ** exact_scale))
    others = F.sum(F.when(~fits, x))
    return F.when(others.isNull(), total).otherwise(others + F.coalesce(total, F.lit(0.0)))


def money_units(x: Column, scale: int) -> tuple[Column, Column]:
    """Whether a double is a whole number of 10^-scale units, and that number."""
    unit = F.lit(float(10 ** scale))
    units = F.rint(x * unit)
    fits = (F.abs(x) < F.lit(float(1 << 40))) & (units / unit == x)
    return fits, F.when(fits, units.cast("long"))


def _sum_type(exact_scale: int | None) -> str:
    return "double" if exact_scale is not None else "long"


def mean(c: ColumnLike, exact_scale: int | None = None) -> Column:
    """Mean over non-null values; null for an all-null group.

    Computed as exact sum / count so that it is reproducible.
    """
    if exact_scale is None:
        total = F.sum(col(c).cast("double"))
    else:
        total = exact_sum(c, exact_scale)
    return F.try_divide(total, F.count(col(c)).cast("double"))


def n_unique_with_null(c: ColumnLike) -> Column:
    """Distinct count where null counts as one more value."""
    return F.count_distinct(col(c)) + F.max(col(c).isNull().cast("int"))
