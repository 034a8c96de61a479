"""Per-key results when a few keys hold most rows.

Value-frequency compression: rows are grouped by key *and value* before
they are grouped by key.  The first grouping combines map-side and spreads a
hot key over as many tasks as it has values; the second one sees a weighted
value once, however many rows had it.  Totals, exact distinct counts, modes
and percentiles all come from the weights.

Defined results: a null value takes part in row counts but in no total,
distinct count, mode or percentile; a key without any value has null there;
of equally frequent values the smallest is the mode; the percentile is the
lower one (the smallest value at or above which the share of rows lies);
rows without key count in the share of all rows but give no key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.operators.ordered import RANGE_VALUES, running_totals
from quillmesh.sources.stages import durable


def value_frequencies(rows: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """(key..., values..., frequency): one row per key and combination of values."""
    return rows.groupBy(*key, *values).agg(F.count("*").alias("frequency"))


def key_totals(frequencies: DataFrame, key: Sequence[str], values: Sequence[str]) -> DataFrame:
    """(key..., n_rows, total_<value>...) from weighted values."""
    return frequencies.groupBy(*key).agg(
        F.sum("frequency").alias("n_rows"),
        *[F.sum(F.col(v) * F.col("frequency")).alias(f"total_{v}") for v in values],
    )


def key_distribution(frequencies: DataFrame, key: Sequence[str], value: str, percent: Sequence[float] = (0.5,), range_values: int = RANGE_VALUES) -> DataFrame:
    """(key..., distinct_<value>, mode_<value>, p<NN>_<value>...) of one value, exactly; the values of a key are put in order range by range."""
    weighted = frequencies.where(F.col(value).isNotNull()).groupBy(*key, value).agg(F.sum("frequency").alias("frequency"))
    ranked = running_totals(weighted, key, value, "frequency", range_values)
    return ranked.groupBy(*key).agg(
        F.count("*").alias(f"distinct_{value}"),
        F.max_by(value, F.struct(F.col("frequency"), -F.col(value))).alias(f"mode_{value}"),
        *[F.min(F.when(F.col("upto") >= F.ceil(F.lit(p) * F.col("total")), F.col(value))).alias(f"p{round(p * 100):02d}_{value}") for p in percent],
    )


def key_profile(rows: DataFrame, key: Sequence[str], values: Sequence[str], percent: Sequence[float] = (0.5,)) -> DataFrame:
    """Totals and distributions of every value for every key.

    The frequencies are written once: the rows are read and shuffled for them only, and each part reads its columns.
    """
    frequencies = durable(value_frequencies(rows, key, values))
    out = key_totals(frequencies, key, values)
    for v in values:
        d = key_distribution(frequencies, key, v, percent)
        renamed = d.select(*[F.col(k).alias(f"__{k}") for k in key], *[c for c in d.columns if c not in key])
        out = out.join(renamed, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in key], "left").drop(*[f"__{k}" for k in key])
    return out


def two_sided(rows: DataFrame, sides: dict[str, Column], values: Sequence[str]) -> DataFrame:
    """Rows in long form (side, key, values...), one row per side of each row."""
    options = F.array(*[F.struct(F.lit(name).alias("side"), key.alias("key")) for name, key in sides.items()])
    return rows.select(F.explode(options).alias("o"), *values).select("o.side", "o.key", *values)


def heavy_keys(totals: DataFrame, by: str, share_percent: int) -> DataFrame:
    """Keys of each ``by`` that hold at least ``share_percent`` per cent of all its rows.

    The number of rows of a side is summed over the keys (null key included), so no second scan is needed;
    the result has at most 100 / share_percent keys a side.
    """
    sizes = totals.groupBy(by).agg(F.sum("n_rows").alias("side_rows"))
    # The null key is ruled out in the comparison, not by a filter of its own: pushed below the totals it would keep
    # the two uses of the totals from sharing one exchange.
    counted = F.when(F.col("key").isNull(), F.lit(-1)).otherwise(F.col("n_rows"))
    return totals.join(sizes, by).where(counted * 100 >= F.col("side_rows") * share_percent)
