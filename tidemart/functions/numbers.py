"""Money, ratios and rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType


def net_price(extended_price: Column, discount: Column) -> Column:
    """Price after discount."""
    return extended_price * (1 - discount)


def gross_price(extended_price: Column, discount: Column, tax: Column) -> Column:
    """Price after discount, tax added."""
    return net_price(extended_price, discount) * (1 + tax)


# A sum is kept in whole-number limbs of 24 bits. A long holds the sum of 2^39 of them.
LIMB = 1 << 24
WHOLE_LIMIT = float(1 << 62)


def _limbs(value: str) -> list[tuple[str, float]]:
    """Whole numbers with the sign of the value, and what each is worth: 2^-72, 2^-48, 2^-24, 1 and 2^24.

    Every step is exact: a double less its whole part, a double times a power of
    two, and remainders of longs. Bits below 2^-72 are cut off, value by value.
    """
    whole = f"CAST({value} AS BIGINT)"
    scaled = f"(({value} - {whole}) * {float(LIMB**2)!r}D)"
    middle = f"CAST({scaled} AS BIGINT)"
    lowest = f"CAST(({scaled} - {middle}) * {float(LIMB)!r}D AS BIGINT)"
    return [(lowest, float(LIMB) ** -3), (f"{middle} % {LIMB}", float(LIMB) ** -2), (f"{middle} DIV {LIMB}", 1.0 / LIMB),
            (f"{whole} % {LIMB}", 1.0), (f"{whole} DIV {LIMB}", float(LIMB))]


def exact_sum(df: DataFrame, name: str) -> Column:
    """Sum that is the same, bit for bit, in any order and partitioning of the rows.

    Integers and decimals are summed as they are. Doubles are cut into
    whole-number limbs, which add without rounding, and are put together once, to
    the nearest double or its neighbour, for up to 5e11 rows a group. NaN, infinities and
    values from 2^62 on (4.6e18) are added as doubles on top.
    """
    if df.schema[name].dataType.typeName() not in ("double", "float"):
        return F.sum(name)
    # As one text, since a column made piece by piece takes a call to the JVM for every piece.
    value = f"CAST(`{name}` AS DOUBLE)"
    common = f"abs({value}) < {WHOLE_LIMIT!r}D"
    lowest, low, part, one, top = [
        f"sum({limb}) * {worth!r}D" for limb, worth in _limbs(f"(CASE WHEN {common} THEN {value} END)")]
    total = f"(({top} + {one}) + ({part} + ({low} + {lowest})))"
    others = f"sum(CASE WHEN NOT {common} THEN {value} END)"
    return F.expr(f"coalesce({total} + {others}, {total}, {others})")


def exact_avg(df: DataFrame, name: str) -> Column:
    """Mean of the non-null values, from the exact sum."""
    return exact_sum(df, name) / F.nullif(F.count(F.col(name)), F.lit(0))


def round_to(value: Column, digits: int) -> Column:
    """Round half away from zero on the decimal text, to ten digits, of a number.

    What no decimal can hold (1e28 and more, NaN, infinity) is rounded as a double.
    """
    exact = F.round(value.try_cast("decimal(38,10)"), digits).cast("double")
    return F.coalesce(exact, F.round(value.cast("double"), digits))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that gives NULL for a zero denominator."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def percent(part: Column, whole: Column, digits: int) -> Column:
    """``part`` as a rounded percentage of ``whole``; NULL for an empty whole."""
    return round_to(ratio(part.cast("double") * 100.0, whole), digits)


def money_text(value: Column) -> Column:
    """Dollar amount with two digits, NULL for NULL.

    Rounds half up on the decimal text (0.125 gives $0.13) and not on the binary
    value; that is deliberate.
    """
    return F.when(value.isNotNull(), F.format_string("$%.2f", round_to(value, 2)))


def safe_cast(column: Column, kind: str) -> Column:
    """Cast that turns malformed text into NULL."""
    return column.try_cast(kind)


def typed_null(kind: str | DataType) -> Column:
    """NULL that still carries a type, so a UNION input keeps its contract."""
    return F.lit(None).cast(kind)
