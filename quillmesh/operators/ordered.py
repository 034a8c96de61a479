"""Running totals over ordered values, for groups of any number of values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Distinct values of a group that one task puts in order; beyond, they are cut into RANGES ranges.
RANGE_VALUES = 100_000
RANGES = 64


def running_totals(counted: DataFrame, by: Sequence[str], value: str, weight: str, range_values: int = RANGE_VALUES) -> DataFrame:
    """(by..., value, weight, upto, total): the weight of all values not above each value, and of the whole group.

    ``counted`` has every value of a group once.  The values of a large group are cut into ranges of about equal size, a task
    orders one range, and what lies below comes from the totals of the ranges before it: no task sees more of a
    group than a range.  Any cuts give the same totals, so approximate ones do.
    """
    cuts = F.percentile_approx(value, [i / RANGES for i in range(1, RANGES)], 1000)
    groups = counted.groupBy(*by).agg(F.count("*").alias("__values"), F.sum(weight).alias("total"), cuts.alias("__cuts"))
    g = groups.select(*[F.col(c).alias(f"__{c}") for c in by], "total", "__cuts", (F.col("__values") > range_values).alias("__big"))
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in by]
    below = F.when(F.col("__big"), F.size(F.filter("__cuts", lambda x: x < F.col(value)))).otherwise(0)
    ranged = counted.join(g, same).select(*by, value, weight, "total", below.alias("__range"))
    # At most RANGES rows a group.
    totals = ranged.groupBy(*by, "__range").agg(F.sum(weight).alias("__in"))
    earlier = totals.select(*[F.col(c).alias(f"__{c}") for c in by], F.col("__range").alias("__r"), (F.sum("__in").over(W.partitionBy(*by).orderBy("__range")) - F.col("__in")).alias("__before"))
    within = F.sum(weight).over(W.partitionBy(*by, "__range").orderBy(value).rangeBetween(W.unboundedPreceding, 0))
    placed = ranged.withColumn("__upto", within).join(earlier, [*same, F.col("__range") == F.col("__r")])
    return placed.select(*by, value, weight, (F.col("__before") + F.col("__upto")).alias("upto"), "total")
