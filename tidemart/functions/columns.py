"""Column expressions: fixed-point money, clocks, text, scores, row identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY_SCALE = 10_000  # money is summed as whole ten-thousandths


def money_units(amount: Column) -> Column:
    """A double amount as whole ten-thousandths: long sums are exact in any order.

    What is not finite has no amount and reads as null; a sum beyond the long range raises (ANSI).
    """
    return F.when(F.abs(amount) < float("inf"), F.round(amount * MONEY_SCALE).cast("long"))


def line_units(price: Column, quantity: Column) -> Column:
    return money_units(price) * quantity


def units_to_decimal(units: Column) -> Column:
    return units.cast("decimal(20,0)") * F.lit("0.0001").cast("decimal(5,4)")


def cents(amount: Column) -> Column:
    """Round half-up to two places and leave decimals behind."""
    return F.round(amount, 2).cast("double")


def mean_cents(units: Column, n: Column) -> Column:
    return F.when(n > 0, cents(units_to_decimal(units) / n.cast("decimal(20,0)")))


def whole_seconds(ts: Column) -> Column:
    return F.unix_seconds(ts.cast("timestamp"))


def time_slice(ts: Column, seconds: int) -> Column:
    """Number of the fixed-width time slice; rows without a time share a slice of their own."""
    return F.coalesce(F.floor(whole_seconds(ts) / F.lit(seconds)).cast("long"), F.lit(-(2**62)))


def joined_text(*parts: Column) -> Column:
    return F.concat_ws(" | ", *[F.coalesce(p, F.lit("")) for p in parts])


def unit_interval(x: Column) -> Column:
    """Clip to [0, 1]; missing and NaN read as 0."""
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.nanvl(F.coalesce(x, F.lit(0.0)), F.lit(0.0))))


def log_share(x: Column, ceiling: Column) -> Column:
    """log1p(x) against log1p(ceiling); 0 where there is no ceiling."""
    return F.when(ceiling > 0, F.log1p(F.greatest(x, F.lit(0))) / F.log1p(ceiling)).otherwise(F.lit(0.0))


def ratio(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole)


def fingerprint(df: DataFrame, skip: tuple[str, ...] = ()) -> Column:
    """Hash of a whole row, the last tiebreak where all else is equal."""
    def hashable(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        return F.array_sort(F.map_entries(c)) if isinstance(field.dataType, T.MapType) else c

    return F.xxhash64(*[hashable(f) for f in df.schema if f.name not in skip])
