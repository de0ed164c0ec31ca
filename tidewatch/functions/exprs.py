"""Small column-expression helpers shared by the operators (all JVM-side)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col_(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(cond: Column) -> Column:
    """Boolean condition -> 0/1 int where an unknown (NULL) comparison counts as 0."""
    return F.when(F.coalesce(cond, F.lit(False)), F.lit(1)).otherwise(F.lit(0)).cast("int")


def failing(ok: Column) -> Column:
    """True when a domain rule does not hold; a NULL value counts as failing."""
    return F.coalesce(~ok, F.lit(True))


def nan_to_null(c) -> Column:
    """NaN (of a floating column) as NULL; other types pass unchanged."""
    c = col_(c)
    return F.when(F.coalesce(F.isnan(c.cast("double")), F.lit(False)), F.lit(None)).otherwise(c)


def safe_ratio(num, den) -> Column:
    """num / den as double, NULL when den is 0 (no ANSI divide-by-zero error)."""
    return F.try_divide(col_(num).cast("double"), col_(den).cast("double"))


def zero_if_undefined(num, den) -> Column:
    """num / den, 0.0 when den is 0 (precision/recall convention)."""
    return F.coalesce(safe_ratio(num, den), F.lit(0.0))


def scalar_row(one_row: DataFrame) -> Column:
    """A one-row aggregate as a struct-valued scalar subquery.

    Spark evaluates the subquery once, before the consuming stage runs, and
    inlines the result as a literal; no join or driver round trip is planned.
    """
    return one_row.select(F.struct(*one_row.columns).alias("s")).scalar()


def rounded_units(x, digits: int) -> Column:
    """``|x| * 10**digits`` as the nearest long; an exact tie goes to the even neighbour.

    A tie is exact when ``x`` has at most ``digits + 1`` binary places (6.25 to one
    digit); a decimal that only looks like a tie (0.15) is not one in binary and goes
    up.  ``x`` is first rounded to 9 decimals, which absorbs summation-order noise.
    """
    x = F.abs(F.round(col_(x).cast("double"), 9))
    scaled = x * F.lit(float(10 ** digits))
    low = F.floor(scaled)
    bits = x * F.lit(float(2 ** (digits + 1)))
    to_even = (scaled - low == 0.5) & (bits == F.floor(bits)) & (low % 2 == 0)
    return F.when(to_even, low).otherwise(F.floor(scaled + F.lit(0.5))).cast("bigint")


def fixed_decimals(x, digits: int) -> Column:
    """Text of ``x`` with exactly ``digits`` decimals, rounded as in :func:`rounded_units`.

    Integer arithmetic gives the same digits on every engine, unlike printf-style
    formatting of a binary double.
    """
    scale = 10 ** digits
    q = rounded_units(x, digits)
    x = F.round(col_(x).cast("double"), 9)
    sign = F.when((x < 0) & (q > 0), F.lit("-")).otherwise(F.lit(""))
    if digits == 0:
        return F.concat(sign, q.cast("string"))
    frac = F.lpad((q % F.lit(scale)).cast("string"), digits, "0")
    return F.concat(sign, F.floor(q / F.lit(scale)).cast("bigint").cast("string"), F.lit("."), frac)


def round_doubles(df: DataFrame, digits: int = 9) -> DataFrame:
    """Round every double column to ``digits`` (presentation step for reports)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
