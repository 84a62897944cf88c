"""Vector expressions over array columns; sums run in doubles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column) -> Column:
    """0 where either vector is zero."""
    n = norm(a) * norm(b)
    return F.when(n == 0, F.lit(0.0)).otherwise(dot(a, b) / n)


def unit(a: Column) -> Column:
    n = norm(a)
    # the norm is spread by array_repeat: inside a lambda it would be summed again for each element
    return F.when(n == 0, a.cast("array<double>")).otherwise(F.zip_with(a, F.array_repeat(n, F.size(a)), lambda x, y: x.cast("double") / y))


def non_zero(a: Column) -> Column:
    return F.exists(a, lambda x: x != 0)


def embed(df: DataFrame, text: str = "text", to: str = "embedding", dims: int = 64) -> DataFrame:
    """A deterministic stand-in for a text encoder: counts of words by hash, to unit length.

    Each step is a projection whose inputs are read twice, so that Catalyst doesn't put one inside another's lambda.
    """
    slots, counts = F.col(f"{to}_slots"), F.col(f"{to}_counts")
    found = F.transform(F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != ""), lambda w: F.pmod(F.conv(F.substring(F.md5(w), 1, 7), 16, 10).cast("int"), F.lit(dims)))
    out = df.withColumn(f"{to}_slots", found)
    spread = F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda k: (F.size(slots) - F.size(F.array_remove(slots, k))).cast("double"))
    out = out.withColumn(f"{to}_counts", F.when(F.size(slots) == 0, F.array_repeat(F.lit(0.0), dims)).otherwise(spread))
    return out.withColumn(to, unit(counts)).drop(f"{to}_slots", f"{to}_counts")
