"""Choosing among versions of a record, and patching records from reviewed ledgers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def latest_version(rows: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in ``order``.

    ``row_number() = 1`` lets Spark cut every key to one row before the shuffle (window group limit),
    so repeated versions never travel.
    """
    rank = F.row_number().over(W.partitionBy(*key).orderBy(*order))
    return rows.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def latest_with_ties(rows: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """All distinct rows that share the first place; more than one row of a key is a conflict to report."""
    rank = F.dense_rank().over(W.partitionBy(*key).orderBy(*order))
    return rows.withColumn("__rank", rank).where("__rank = 1").drop("__rank").distinct()


def patched(rows: DataFrame, key: str, ledger: DataFrame, columns: dict[str, str], excluded: DataFrame | None = None) -> DataFrame:
    """Rows with the ledger's values where it has the key, without the excluded keys.

    ``columns`` maps a column of ``rows`` to the ledger's column; both joins are equi-joins on the key, and the
    optimizer broadcasts a ledger only when its size is known to be small.
    """
    changes = ledger.select(key, *[F.col(new).alias(f"__new_{old}") for old, new in columns.items()], F.lit(True).alias("patched"))
    out = rows.join(changes, key, "left")
    out = out.withColumns({old: F.coalesce(f"__new_{old}", old) for old in columns} | {"patched": F.coalesce("patched", F.lit(False))}).drop(*[f"__new_{old}" for old in columns])
    return out if excluded is None else out.join(excluded.select(key), key, "left_anti")


def preimage_audit(rows: DataFrame, key: str, ledger: DataFrame, expected: dict[str, str]) -> DataFrame:
    """One row: ledger entries, entries without a record, entries whose record is not as expected (nulls compare as values)."""
    held = rows.select(F.col(key).alias("__held_id"), *[F.col(c).alias(f"__had_{c}") for c in expected])
    joined = ledger.alias("l").join(held, F.col(f"l.{key}") == F.col("__held_id"), "left")
    differs = None
    for column, wanted in expected.items():
        test = ~F.col(f"__had_{column}").eqNullSafe(F.col(f"l.{wanted}"))
        differs = test if differs is None else differs | test
    absent = F.col("__held_id").isNull()
    return joined.agg(F.count("*").alias("n_entries"), F.count_if(absent).alias("n_absent"), F.count_if(~absent & differs).alias("n_changed"))


def classified(rules: Mapping[str, Column], what: Column, review: bool = False) -> Column:
    """Name of the first rule that holds.  Content that no rule knows stops the plan, or with ``review`` gives null for a review table."""
    out = None
    for name, test in rules.items():
        out = F.when(test, name) if out is None else out.when(test, name)
    unknown = F.lit(None).cast("string") if review else F.raise_error(F.concat(F.lit("no rule knows: "), F.coalesce(what.cast("string"), F.lit("null"))))
    return out.otherwise(unknown)


def combined_ledgers(*ledgers: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(entries, conflicts) of several ledgers of the same columns: equal entries count once, a key with different ones is a conflict and no entry."""
    every = reduce(lambda a, b: a.unionByName(b), ledgers).distinct()
    torn = every.groupBy(key).agg(F.count("*").alias("n_entries")).where("n_entries > 1")
    return every.join(torn.select(key), key, "left_anti"), torn
