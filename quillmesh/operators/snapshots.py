"""Changes between consecutive full snapshots.

Each snapshot is reduced to one state per key by a map-side combinable
``max(struct(...))``; the state carries only a 128-bit hash of the compared
columns, so what is shuffled does not grow with the width of the table.
Consecutive snapshots then meet in one full outer join on (date, key): a
missing side is an addition or a removal, unequal hashes are a change.

Defined results: rows without key or snapshot date do not count; repeated
rows collapse; of several versions the newest ``order_by`` wins, then the
largest hash; a table with fewer than two snapshots gives no rows; null
is a value of its own and differs from empty text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def canonical_hash(columns: Sequence[Column]) -> Column:
    """MD5 of the length-prefixed text of the columns; null has a mark no text can imitate."""
    parts = []
    for c in columns:
        text = c.cast("string")
        parts.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("~")))
    return F.md5(F.concat(*parts))


def snapshot_states(rows: DataFrame, key: Column, snapshot: Column, order_by: Sequence[Column], compared: Sequence[Column]) -> DataFrame:
    """One row (snapshot, key, row_hash) per key and snapshot."""
    version = F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order_by)], canonical_hash(compared).alias("row_hash"))
    slim = rows.select(key.alias("key"), snapshot.alias("snapshot"), version.alias("version"))
    return (
        slim.where(F.col("key").isNotNull() & F.col("snapshot").isNotNull())
        .groupBy("snapshot", "key")
        .agg(F.max("version").getField("row_hash").alias("row_hash"))
    )


def snapshot_changes(states: DataFrame) -> DataFrame:
    """(snapshot, key, change_type) of each snapshot against the one before it."""
    dates = states.select("snapshot").distinct()
    # One row per delivered snapshot: the only window without a partition sees the list of dates.
    pairs = dates.select("snapshot", F.lead("snapshot").over(W.orderBy("snapshot")).alias("next"), F.lag("snapshot").over(W.orderBy("snapshot")).alias("previous"))
    before = (
        states.join(pairs.where("next IS NOT NULL").select("snapshot", "next"), "snapshot")
        .select(F.col("next").alias("snapshot"), "key", F.col("row_hash").alias("old_hash"))
    )
    # The same kind of join on both sides: a semi-join would move below the states and keep them from being shared.
    after = (
        states.join(pairs.where("previous IS NOT NULL").select("snapshot", "previous"), "snapshot")
        .select("snapshot", "key", F.col("row_hash").alias("new_hash"))
    )
    change = (
        F.when(F.col("old_hash").isNull(), "added")
        .when(F.col("new_hash").isNull(), "removed")
        .when(F.col("old_hash") != F.col("new_hash"), "changed")
    )
    return before.join(after, ["snapshot", "key"], "full_outer").select("snapshot", "key", change.alias("change_type")).where("change_type IS NOT NULL")
