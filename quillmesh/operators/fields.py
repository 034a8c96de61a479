"""Research fields of journals from votes of their works."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

UNKNOWN = "Unknown"


def modal_field(votes: DataFrame, key: list[str]) -> DataFrame:
    """The named field with most votes (the first by name at a tie), how many tied, and its shares; no named vote gives ``Unknown``.

    ``votes`` is (key..., field, votes), already summed.
    """
    named = F.col("field") != UNKNOWN
    best = F.max(F.when(named, F.col("votes")))
    totals = votes.groupBy(*key).agg(F.sum("votes").alias("all_works"), F.coalesce(F.sum(F.when(named, F.col("votes"))), F.lit(0)).alias("classified_works"), best.alias("top"))
    at_top = votes.where(named).join(totals.select(*key, "top"), key).where("votes = top").groupBy(*key).agg(F.min("field").alias("mode"), F.count("*").alias("tied"))
    out = totals.join(at_top, key, "left")
    return out.select(
        *key,
        F.coalesce("mode", F.lit(UNKNOWN)).alias("field"),
        F.coalesce("top", F.lit(0)).alias("modal_works"),
        "classified_works",
        "all_works",
        F.try_divide(F.col("top"), F.col("classified_works")).alias("modal_share"),
        F.try_divide(F.col("classified_works"), F.col("all_works")).alias("coverage"),
        F.coalesce("tied", F.lit(0)).alias("tied_modes"),
    )


def top_fields(votes: DataFrame, key: list[str]) -> DataFrame:
    """The three named fields with most votes, and what is left of the classified works."""
    order = W.partitionBy(*key).orderBy(F.desc("votes"), "field")
    ranked = votes.where(F.col("field") != UNKNOWN).withColumn("pos", F.row_number().over(order))
    at = lambda k, c: F.max(F.when(F.col("pos") == k, F.col(c)))
    named = ranked.groupBy(*key).agg(
        F.sum("votes").alias("classified_works"),
        *[at(k, "field").alias(f"field_{k}") for k in (1, 2, 3)],
        *[F.coalesce(at(k, "votes"), F.lit(0)).alias(f"works_{k}") for k in (1, 2, 3)],
        F.coalesce(F.sum(F.when(F.col("pos") > 3, F.col("votes"))), F.lit(0)).alias("works_other"),
    )
    everyone = votes.select(*key).distinct()
    return everyone.join(named, key, "left").fillna(0, ["classified_works", "works_1", "works_2", "works_3", "works_other"])


def largest_remainder(works: list[Column], total: Column, units: int = 1000) -> Column:
    """Array of whole units that add up to ``units`` exactly; the largest remainders take what rounding down leaves, earlier parts first at a tie.

    Null when the parts do not add up to the total; an empty array when the total is 0.
    """
    whole = [F.floor(w * units / total).cast("long") for w in works]
    left = F.lit(units) - sum(whole, F.lit(0))
    rest = [(w * units) % total for w in works]
    taken = []
    for i, r in enumerate(rest):
        ahead = sum(((q > r) | ((q == r) & F.lit(k < i))).cast("int") for k, q in enumerate(rest) if k != i)
        taken.append(whole[i] + (ahead < left).cast("long"))
    return F.when(sum(works) != total, F.lit(None)).when(total == 0, F.array().cast("array<bigint>")).otherwise(F.array(*taken))


def field_shares(top: DataFrame, key: list[str]) -> DataFrame:
    """Tenths of a percent of the three top fields and the rest."""
    parts = [F.col("works_1"), F.col("works_2"), F.col("works_3"), F.col("works_other")]
    units = top.where("classified_works > 0").withColumn("u", largest_remainder(parts, F.col("classified_works")))
    return units.select(*key, *[(F.col("u")[i] / 10).alias(n) for i, n in enumerate(("percent_1", "percent_2", "percent_3", "percent_other"))])


def field_label(field: Column, share: Column) -> Column:
    """``Field (12.3%)``; only the field where the share is missing, out of range or of the unknown field."""
    text = F.coalesce(F.nullif(field, F.lit("")), F.lit("Unclassified"))
    return F.when(share.between(0, 1) & (text != UNKNOWN), F.concat(text, F.lit(" ("), F.format_string("%.1f", 100 * share), F.lit("%)"))).otherwise(text)
