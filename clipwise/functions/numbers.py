"""Numbers rounded and written as SQL and C do it, by their binary values; Spark goes by the shortest decimal that names them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def rounded(c: Column | str, places: int) -> Column:
    """``c`` times a power of ten, rounded half away from zero and divided again; what the power takes out of range stays as it is.

    What rounds to zero keeps its sign, as in SQL: -0.001 gives -0.0.
    """
    c = F.col(c) if isinstance(c, str) else c
    scale = F.lit(10.0**places)
    return F.transform(F.array(c.cast("double")), lambda x: F.when(F.abs(x) * scale < 0.5, x * 0.0).when(F.abs(x) < 1e290, F.round(x * scale) / scale).otherwise(x))[0]


def rounded_column(name: str, places: int) -> Column:
    """``rounded`` of a column that is there already, in operations that Spark compiles: for results of very many rows."""
    x, scale = F.col(name).cast("double"), F.lit(10.0**places)
    v = F.abs(x) * scale
    whole = F.floor(v).cast("double")
    near = (whole + F.when(v - whole >= 0.5, 1.0).otherwise(0.0)) / scale
    # From 2^52 on there are no fractions to round.
    return F.when(v < 0.5, x * 0.0).when(v < 4503599627370496.0, F.when(x < 0, -near).otherwise(near)).when(F.abs(x) < 1e290, x * scale / scale).otherwise(x)


def _half_even(x: Column, scale: Column) -> Column:
    """The whole number nearest to ``x * scale``, half to even. ``x`` is cut in two halves whose products are exact, so the sign of ``over`` is right."""
    cut = x * 134217729.0
    high = cut - (cut - x)
    a, b = high * scale, (x - high) * scale
    whole = F.floor(a + b).cast("double")
    over = (a - whole - 0.5) + b
    return whole + F.when((over > 0) | ((over == 0) & (whole % 2 == 1)), 1.0).otherwise(0.0)


def written(pattern: str, c: Column | str, places: int = 2) -> Column:
    """``pattern`` with its one ``%s`` replaced by ``c`` with so many places, as C's ``printf`` writes it; from 1e12 on as Java does."""
    c = F.col(c) if isinstance(c, str) else c
    scale = F.lit(10.0**places)
    near = lambda x: F.when(x < 0, -_half_even(-x, scale)).otherwise(_half_even(x, scale)) / scale
    value = F.transform(F.array(c.cast("double")), lambda x: F.when(F.abs(x) < 1e12, near(x)).otherwise(x))[0]
    return F.format_string(pattern.replace("%s", f"%.{places}f"), value)
