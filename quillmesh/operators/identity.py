"""Projection of raw journal keys to effective keys, and attributes of effective journals.

Decisions are tables: overrides (source_id, expected_key, target), aliases
(alias, target), corrections (key, target).  The order is fixed: a source
override whose expected key matches, else the alias of the raw key, else the
raw key; then a correction of the result.  What has no valid key afterwards is
quarantined, never guessed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.functions.ids import issn_key_is_valid, issn_status

# What stands for a conflict and for a missing value in the published attributes.
CONFLICT_FOR = {"source_type": "Multiple source types", "oa_field": "Multiple OA fields", "oa_domain": "Multiple OA domains"}
UNKNOWN_FOR = dict.fromkeys(CONFLICT_FOR, "Unknown")
# How an attribute came about.
OWN, OWN_CONFLICT, ALL, ALL_CONFLICT, MISSING = "canonical_arm", "canonical_arm_conflict", "unanimous_component_fallback", "component_conflict", "missing"


def project_keys(rows: DataFrame, source: str, key: str, overrides: DataFrame, aliases: DataFrame, corrections: DataFrame) -> DataFrame:
    """``rows`` with ``effective_key`` (null: quarantined) and ``projected_by``.

    Null keys match an override that expects a missing key; three left equi-joins against the decision tables.
    """
    o = overrides.select(F.col("source_id").alias("__s"), F.coalesce("expected_key", F.lit("")).alias("__e"), F.col("target").alias("__o"))
    a = aliases.select(F.col("alias").alias("__a"), F.col("target").alias("__t"))
    c = corrections.select(F.col("key").alias("__k"), F.col("target").alias("__c"))
    out = rows.join(o, (F.col(source) == F.col("__s")) & (F.coalesce(key, F.lit("")) == F.col("__e")), "left").join(a, F.col(key) == F.col("__a"), "left")
    out = out.withColumn("__key", F.coalesce("__o", "__t", key)).join(c, F.col("__key") == F.col("__k"), "left")
    final = F.coalesce("__c", "__key")
    by = F.when(~F.coalesce(issn_key_is_valid(F.regexp_replace(final, "-", "")), F.lit(False)), "quarantine").when(F.col("__o").isNotNull(), "override").when(F.col("__c").isNotNull(), "correction").when(F.col("__t").isNotNull(), "alias").otherwise("raw")
    return out.withColumns({"effective_key": F.when(by != "quarantine", final), "projected_by": by}).drop("__s", "__e", "__o", "__a", "__t", "__k", "__c", "__key")


def quarantine(projected: DataFrame, key: str, masses: list[str]) -> DataFrame:
    """What fell out of the projection, by reason, with its mass; conservation holds if kept plus quarantined is all."""
    status = F.when(F.col("effective_key").isNotNull(), "kept").otherwise(issn_status(F.col(key)))
    return projected.groupBy(status.alias("status")).agg(F.count("*").alias("n_rows"), *[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in masses])


def null_safe_mapping(edges: DataFrame, mapping: DataFrame, ends: dict[str, tuple[str, str]]) -> DataFrame:
    """Both ends of each edge mapped over (source_id, raw key) with nulls equal to nulls.

    ``ends`` maps an output column to the edge's source and key columns; ``mapping`` is (source_id, raw_key, effective_key).
    """
    out = edges
    for name, (source, key) in ends.items():
        m = mapping.select(F.col("source_id").alias("__s"), F.col("raw_key").alias("__k"), F.col("effective_key").alias(name))
        out = out.join(m, F.col(source).eqNullSafe(F.col("__s")) & F.col(key).eqNullSafe(F.col("__k"))).drop("__s", "__k")
    return out


def project_edges(edges: DataFrame, overrides: DataFrame, aliases: DataFrame, corrections: DataFrame) -> DataFrame:
    """Citations between raw identities with both ends projected: (score_year, citing, cited, n_raw, n_filtered), null where an end is quarantined.

    ``edges`` is (score_year, citing_source_id, raw_citing_issn_l, cited_source_id, raw_cited_issn_l, n_raw, n_filtered).
    """
    out = edges
    for end in ("citing", "cited"):
        out = project_keys(out, f"{end}_source_id", f"raw_{end}_issn_l", overrides, aliases, corrections).withColumnRenamed("effective_key", end).drop("projected_by")
    return out.groupBy("score_year", "citing", "cited").agg(F.sum("n_raw").alias("n_raw"), F.sum("n_filtered").alias("n_filtered"))


def edge_conservation(projected: DataFrame) -> DataFrame:
    """Per score year: mass under effective keys and mass in quarantine; together they are what went in."""
    kept = F.col("citing").isNotNull() & F.col("cited").isNotNull()
    sums = [F.coalesce(F.sum(F.when(test, F.col(m))), F.lit(0)).alias(f"{name}_{m}") for name, test in (("effective", kept), ("quarantined", ~kept)) for m in ("n_raw", "n_filtered")]
    return projected.groupBy("score_year").agg(F.count_if(kept).alias("effective_edges"), *sums)


def consensus(column: str, canonical: Column) -> tuple[Column, Column]:
    """(value, how) of an attribute over a group: the canonical members' value if it is one, else the group's, else a conflict.

    The sets hold distinct values of one attribute of one journal; they do not grow with its rows.
    """
    own, every = F.collect_set(F.when(canonical, F.col(column))), F.collect_set(column)
    conflict, missing = F.lit(CONFLICT_FOR.get(column)), F.lit(UNKNOWN_FOR.get(column))
    value = F.when(F.size(own) == 1, own[0].cast("string")).when(F.size(own) > 1, conflict).when(F.size(every) == 1, every[0].cast("string")).when(F.size(every) > 1, conflict).otherwise(missing)
    how = F.when(F.size(own) == 1, OWN).when(F.size(own) > 1, OWN_CONFLICT).when(F.size(every) == 1, ALL).when(F.size(every) > 1, ALL_CONFLICT).otherwise(MISSING)
    return value, how


def effective_sources(sources: DataFrame, columns: list[str]) -> DataFrame:
    """One row per effective key with the consensus of each column and how it came about.

    A source is canonical for a key that is its own raw key.
    """
    canonical = F.col("raw_key") == F.col("effective_key")
    parts = {c: consensus(c, canonical) for c in columns}
    return sources.where("effective_key IS NOT NULL").groupBy("effective_key").agg(
        F.count("*").alias("n_sources"),
        F.count_if(canonical).alias("n_canonical"),
        F.array_join(F.array_sort(F.collect_set("source_id")), ";").alias("source_ids"),
        *[v.alias(c) for c, (v, _) in parts.items()],
        *[h.alias(f"{c}_by") for c, (_, h) in parts.items()],
    )


def suppress_arms(sources: DataFrame, decisions: DataFrame) -> DataFrame:
    """Sources with ``shown``: in a decided component only the chosen source stands for display; its mass stays with the others."""
    d = decisions.select(F.col("source_id").alias("__m"), "chosen")
    joined = sources.join(d, F.col("source_id") == F.col("__m"), "left").drop("__m")
    return joined.withColumn("shown", F.coalesce(F.col("chosen") == F.col("source_id"), F.lit(True))).drop("chosen")


def journal_view(projected: DataFrame) -> DataFrame:
    """(effective_key, source_id, title) of effective journals of type journal whose key belongs to exactly one source of that raw key."""
    own = projected.where((F.col("raw_key") == F.col("effective_key")) & (F.lower(F.trim("source_type")) == "journal"))
    return own.groupBy("effective_key").agg(F.count("*").alias("__n"), F.min(F.struct("source_id", "title")).alias("s")).where("__n = 1").select("effective_key", "s.source_id", "s.title")


def overlapping_components(members: DataFrame) -> DataFrame:
    """(source_id, n_components) of sources in more than one component; ``members`` is (component, source_id)."""
    return members.distinct().groupBy("source_id").agg(F.count("*").alias("n_components")).where("n_components > 1")


def alias_conflicts(aliases: DataFrame) -> DataFrame:
    """(issn, n_keys) of aliases that lead to more than one effective key; ``aliases`` is (issn, effective_key)."""
    return aliases.distinct().groupBy("issn").agg(F.count("*").alias("n_keys")).where("n_keys > 1")
