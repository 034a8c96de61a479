"""References to records that do not exist (or did not exist yet).

Parents and children are written in one long form (ref_table, ref_key, tag)
and grouped by parent table and key.  A group is reduced to its parent
flags, the first time from which a parent holds without end and the span of
times at which children ask; all of that combines map-side, so a key that a
third of all rows refer to costs one row per map task.  Groups without
parent, or whose span begins before that time, are *suspect*; only those
meet the children again, over ``2**SALT_BITS`` tasks a key (the suspects, one
row per key, are repeated instead), and adaptive execution splits what is
still too large.  Children that are still open meet the intervals with an end
in one sorted union per salted key: of the intervals begun so far only the
latest end counts, so a key may have any number of them.

Defined results: null and blank references are no references; repeated
references of one child count once; a child without a time is an orphan
unless parents have no times at all; empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SALT_BITS = 4

CHILD_COLUMNS = ["ref_table", "period", "child_key", "ref_key", "scope", "asked_at"]
PARENT_COLUMNS = ["ref_table", "ref_key", "scope", "valid_from", "valid_to"]


def suspect_groups(children: DataFrame, parents: DataFrame) -> DataFrame:
    """Groups (ref_table, ref_key, scope) some of whose children may lack a parent.

    ``children`` has :data:`CHILD_COLUMNS` (asked_at null: no time condition),
    ``parents`` has :data:`PARENT_COLUMNS` (both times null: always valid).
    """
    no_time = F.lit(None).cast("timestamp")
    asked = children.select("ref_table", "ref_key", "scope", F.lit(0).alias("is_parent"), "asked_at", no_time.alias("valid_from"), no_time.alias("valid_to"))
    held = parents.select("ref_table", "ref_key", "scope", F.lit(1).alias("is_parent"), no_time.alias("asked_at"), "valid_from", "valid_to")
    is_child, endless = F.col("is_parent") == 0, F.col("valid_to").isNull()
    grouped = (
        asked.unionByName(held)
        .groupBy("ref_table", "ref_key", "scope")
        .agg(
            F.min("is_parent").alias("only_parents"),
            F.max(F.when(~is_child & endless & F.col("valid_from").isNull(), 1).otherwise(0)).alias("timeless"),
            F.min(F.when(endless, F.col("valid_from"))).alias("open_from"),
            F.min("asked_at").alias("first_asked"),
            F.max(F.when(is_child & F.col("asked_at").isNull(), 1).otherwise(0)).alias("asks_without_time"),
        )
    )
    covers_all = (F.col("timeless") == 1) | ((F.col("asks_without_time") == 0) & F.coalesce(F.col("open_from") <= F.col("first_asked"), F.lit(False)))
    return grouped.where((F.col("only_parents") == 0) & ~covers_all).select("ref_table", "ref_key", "scope", "open_from")


def orphan_references(children: DataFrame, parents: DataFrame) -> DataFrame:
    """Distinct (ref_table, period, child_key, missing_key) of references without a parent."""
    children = children.select(*CHILD_COLUMNS).where("ref_key IS NOT NULL").distinct()
    parents = parents.where("ref_key IS NOT NULL")
    salts = F.explode(F.sequence(F.lit(0), F.lit((1 << SALT_BITS) - 1)))
    spread = suspect_groups(children, parents).withColumn("salt", salts)
    salted = children.withColumn("salt", F.shiftrightunsigned(F.xxhash64("child_key", "period"), 64 - SALT_BITS).cast("int"))
    c, s = salted.alias("c"), spread.alias("s")
    same = (
        (F.col("c.ref_table") == F.col("s.ref_table"))
        & (F.col("c.ref_key") == F.col("s.ref_key"))
        & F.col("c.scope").eqNullSafe(F.col("s.scope"))
        & (F.col("c.salt") == F.col("s.salt"))
    )
    key = ["ref_table", "ref_key", "scope", "salt"]
    still_open = (
        c.join(s, same)
        .where(~F.coalesce(F.col("open_from") <= F.col("asked_at"), F.lit(False)))
        .select(*[f"c.{k}" for k in key], F.col("asked_at").alias("at"), F.lit(1).alias("is_child"), F.lit(None).cast("timestamp").alias("valid_to"), "period", "child_key")
    )
    ended = parents.where("valid_from IS NOT NULL AND valid_to IS NOT NULL").select("ref_table", "ref_key", "scope", salts.alias("salt"), F.col("valid_from").alias("at"), F.lit(0).alias("is_child"), "valid_to")
    begun = Window.partitionBy(*key).orderBy("at", "is_child").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        still_open.unionByName(ended, allowMissingColumns=True)
        .withColumn("until", F.max("valid_to").over(begun))
        .where((F.col("is_child") == 1) & ~F.coalesce(F.col("until") > F.col("at"), F.lit(False)))
        .select("ref_table", "period", "child_key", F.col("ref_key").alias("missing_key"))
        .distinct()
    )


def orphan_report(orphans: DataFrame) -> DataFrame:
    """Counts of orphan references, of missing keys and of the children concerned, by table and period.

    Missing keys and children are counted by grouping each first, so that no task holds a set.
    """
    by = ["ref_table", "period"]
    keys = orphans.groupBy(*by, "missing_key").agg(F.count("*").alias("n")).groupBy(*by).agg(F.sum("n").alias("n_references"), F.count("*").alias("n_missing_keys"))
    children = orphans.groupBy(*by, "child_key").agg(F.count("*").alias("n")).groupBy(*by).agg(F.count("*").alias("n_children"))
    k, c = keys.alias("k"), children.alias("c")
    return k.join(c, F.col("k.ref_table").eqNullSafe(F.col("c.ref_table")) & F.col("k.period").eqNullSafe(F.col("c.period"))).select("k.ref_table", "k.period", "k.n_references", "k.n_missing_keys", "c.n_children")
