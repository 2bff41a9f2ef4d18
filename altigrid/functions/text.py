"""Text fields to numbers and numbers to short text."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, functions as F

# Fixed value: what counts as a whole number.
INTEGER_PATTERN = r"^[+-]?[0-9]+$"


def parse_rows(
    lines: DataFrame, fields: Callable[[Callable[[int], Column]], dict[str, Column]],
    needed: list[str], keep: list[str] = (), sep: str = ",",
) -> DataFrame:
    """Zero or one row per text line.

    ``fields`` gets a function from position to field (null where the line is
    too short) and returns the columns. Lines with a null in ``needed`` vanish.

    The row is made by a generator and not by a projection with a filter on
    top: Spark would push such a filter down and parse every line twice.
    """
    split = lines.select(*keep, F.split("line", sep).alias("_f"))
    columns = fields(lambda i: F.get("_f", F.lit(i)))
    rows = F.array(F.struct(*[c.alias(name) for name, c in columns.items()]))
    if needed:
        whole = lambda row: reduce(and_, [row[name].isNotNull() for name in needed])
        rows = F.filter(rows, whole)
    return split.select(*keep, F.inline(rows))


def to_integer(text: Column, kind: str = "int") -> Column:
    """Whole number or null; blanks and ``12.0`` are not whole numbers."""
    return F.when(text.rlike(INTEGER_PATTERN), text.try_cast(kind))


def to_double(text: Column) -> Column:
    """Any double, NaN and infinities included, or null."""
    return text.try_cast("double")


def with_significant_text(df: DataFrame, columns: list[str], digits: int = 10) -> DataFrame:
    """Number columns as the shortest text with at most ``digits`` significant digits.

    Trailing zeros go; magnitudes below 1e-4 take exponent form. Meant for
    degrees (below 1000). Digits come from one whole number per value, which is
    much cheaper than formatting each; the steps are columns of their own, so
    that each is computed once and the generated code stays small.
    """
    step = lambda name, make: {f"_{name}_{c}": make(c) for c in columns}
    made = lambda name, c: F.col(f"_{name}_{c}")

    def places(c: str) -> Column:
        # Decimals that leave ``digits`` digits, by the place of the first one.
        firsts = range(2, -4, -1)
        return F.coalesce(
            *[F.when(F.abs(c) >= 10.0**first, digits - 1 - first) for first in firsts],
            F.lit(digits + 3))

    units = F.array(*[F.lit(10**k).cast("bigint") for k in range(digits + 4)])
    out = df.withColumns(step("places", places))
    out = out.withColumns(step("unit", lambda c: F.get(units, made("places", c))))
    out = out.withColumns(step("whole", lambda c: F.rint(
        F.abs(c) * made("unit", c).cast("double")).cast("bigint")))

    def text(c: str) -> Column:
        value, whole, unit = F.col(c), made("whole", c), made("unit", c)
        decimals = F.lpad((whole % unit).cast("string"), made("places", c), F.lit("0"))
        plain = F.concat(
            F.when(value < 0.0, "-").otherwise(""),
            F.call_function("div", whole, unit).cast("string"), F.lit("."), decimals)
        exponent = F.regexp_replace(F.format_string(f"%.{digits - 1}e", value), r"\.?0+e", "e")
        return F.when((F.abs(value) < 1e-4) & (value != 0.0), exponent).otherwise(
            F.rtrim(F.rtrim(plain, F.lit("0")), F.lit(".")))

    return out.withColumns({c: text(c) for c in columns}).select(df.columns)
