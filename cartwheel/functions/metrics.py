"""Column builders shared by the Gold, inspection and profiling operators.

All of them are plain Catalyst expressions, so they stay inside whole-stage codegen
and take part in partial (map-side) aggregation.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_type(event_type: str, column: str = "event_type") -> Column:
    return F.col(column) == F.lit(event_type)


def null_count(column: str) -> Column:
    return F.sum(F.when(F.col(column).isNull(), 1).otherwise(0))


def null_or_blank(column: str) -> Column:
    """Null, or only whitespace. Empty CSV fields already read as null."""
    return F.col(column).isNull() | (F.trim(F.col(column)) == "")


def null_or_blank_count(column: str) -> Column:
    return F.sum(F.when(null_or_blank(column), 1).otherwise(0))


# Revenue = sum of unit_price * quantity over purchases, rounded to cents.
#
# Doubles added in another order give another sum, so the sum is kept as an exact decimal
# wherever that is possible: prices below 10^10 with up to 10 decimals, whole quantities.
# A group with any other price (NaN, infinite, larger, finer) takes the plain double sum
# of all its purchases instead, which is what IEEE arithmetic says: NaN stays NaN. No row
# is ever left out. Three numbers carry that through several levels of aggregation.
_PRICE, _QUANTITY = "decimal(20,10)", "decimal(10,0)"


def revenue_parts(price: str = "unit_price", quantity: str = "quantity") -> list[Column]:
    """First-level aggregates: rev_exact, rev_other (purchases without an exact value)
    and rev_double. A null price or quantity adds nothing, as in SUM."""
    bought = is_type("purchase")
    known = F.col(price).isNotNull() & F.col(quantity).isNotNull()
    exact = F.col(price).try_cast(_PRICE)
    fits = exact.cast("double") == F.col(price)  # null (no decimal) or false: not exact
    value = exact * F.col(quantity).cast(_QUANTITY)
    return [
        F.try_sum(F.when(bought, F.when(fits, value)).otherwise(F.lit(0))).alias("rev_exact"),
        F.count_if(bought & known & ~F.coalesce(fits, F.lit(False))).alias("rev_other"),
        F.sum(F.when(bought, F.col(price) * F.col(quantity)).otherwise(F.lit(0.0))).alias("rev_double"),
    ]


def merged_revenue_parts(when: Column | None = None) -> list[Column]:
    """The parts again, over rows that hold parts (only those where ``when`` is true)."""
    def of(name: str) -> Column:
        return F.col(name) if when is None else F.when(when, F.col(name))

    return [F.try_sum(of("rev_exact")).alias("rev_exact"), F.sum(of("rev_other")).alias("rev_other"),
            F.sum(of("rev_double")).alias("rev_double")]


def revenue() -> Column:
    """Rounded revenue from the three parts; null where there were no rows."""
    exact = F.round(F.col("rev_exact"), 2).cast("double")
    plain = F.round(F.col("rev_double"), 2)
    return F.when((F.col("rev_other") == 0) & F.col("rev_exact").isNotNull(), exact).otherwise(plain)


def pct(numerator: str | Column, denominator: str | Column) -> Column:
    """round(numerator / denominator * 100, 2); null when the denominator is 0 or null."""
    num = F.col(numerator) if isinstance(numerator, str) else numerator
    den = F.col(denominator) if isinstance(denominator, str) else denominator
    return F.round(F.try_divide(num, den) * F.lit(100), 2)
