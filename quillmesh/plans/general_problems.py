"""Queries of the general problems: snapshot changes, orphan references, nested records, heavy keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions.ids import blank_to_null, entity_id, issn_key, issn_set, issn_text
from quillmesh.operators import heavy_keys, nested, orphans, snapshots
from quillmesh.sources.tables import table

#: Columns of a source that count as its state, as they are compared.
SOURCE_STATE = ["raw_issn_l", "source_type", "title", "publisher", "issns", "oa_field", "oa_domain", "is_open_access"]


def source_states(sources: DataFrame) -> DataFrame:
    compared = [issn_key("raw_issn_l") if c == "raw_issn_l" else F.array_join(issn_set("issns"), ",") if c == "issns" else F.col(c) for c in SOURCE_STATE]
    return snapshots.snapshot_states(sources, entity_id("source_id", "S"), blank_to_null("snapshot_date"), [F.col("updated_date"), F.col("loaded_at")], compared)


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    changes = snapshots.snapshot_changes(source_states(table(spark, d, "source_rows")))
    return changes.select(F.col("snapshot").alias("snapshot_date"), F.col("key").alias("source_id"), "change_type")


def p2_counts(spark: SparkSession, d: str) -> DataFrame:
    return p2_found(spark, d).groupBy("snapshot_date", "change_type").agg(F.count("*").alias("n_sources"))


def _children(spark: SparkSession, d: str) -> DataFrame:
    citing = table(spark, d, "citing").select(
        F.lit("citing").alias("ref_table"),
        F.col("publication_year").cast("int").alias("period"),
        entity_id("work_id", "W").alias("child_key"),
        F.explode("references").alias("reference"),
        F.lit(None).cast("int").alias("scope"),
        F.col("arrived_at").alias("asked_at"),
    ).select("ref_table", "period", "child_key", entity_id("reference", "W").alias("ref_key"), "scope", "asked_at")
    edges = table(spark, d, "effective_edges").select(
        F.lit("effective_edges").alias("ref_table"),
        F.col("score_year").cast("int").alias("period"),
        issn_text("citing_issn_l").alias("child_key"),
        issn_text("cited_issn_l").alias("ref_key"),
        F.col("score_year").cast("int").alias("scope"),
        F.lit(None).cast("timestamp").alias("asked_at"),
    )
    return citing.unionByName(edges)


def _parents(spark: SparkSession, d: str) -> DataFrame:
    works = table(spark, d, "targets").where("arrived_at IS NOT NULL").select(
        F.lit("citing").alias("ref_table"), entity_id("work_id", "W").alias("ref_key"), F.lit(None).cast("int").alias("scope"), F.col("arrived_at").alias("valid_from"), F.col("deleted_at").alias("valid_to")
    )
    never = F.lit(None).cast("timestamp")
    counts = table(spark, d, "effective_counts").select(
        F.lit("effective_edges").alias("ref_table"), issn_text("issn_l").alias("ref_key"), F.col("score_year").cast("int").alias("scope"), never.alias("valid_from"), never.alias("valid_to")
    )
    return works.unionByName(counts)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_references(_children(spark, d), _parents(spark, d))


def p3_report(spark: SparkSession, d: str) -> DataFrame:
    return orphans.orphan_report(p3_found(spark, d))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    typed = nested.typed_records(table(spark, d, "fixture"))
    parsed = nested.parsed_records(table(spark, d, "raw_works"))
    return nested.flatten(typed.unionByName(parsed))


def p4_children(spark: SparkSession, d: str) -> DataFrame:
    return p4_found(spark, d).groupBy("child").agg(F.count("*").alias("n_rows"), F.count_distinct("record_id").alias("n_records"))


def _edge_sides(spark: SparkSession, d: str) -> DataFrame:
    sides = {"cited": issn_text("cited_issn_l"), "citing": issn_text("citing_issn_l")}
    return heavy_keys.two_sided(table(spark, d, "effective_edges"), sides, ["n_raw", "n_filtered"])


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    frequencies = heavy_keys.value_frequencies(_edge_sides(spark, d), ["side", "key"], ["n_raw", "n_filtered"])
    totals = heavy_keys.key_totals(frequencies, ["side", "key"], ["n_raw", "n_filtered"])
    return heavy_keys.heavy_keys(totals, "side", 3).select("side", F.col("key").alias("issn_l"))


def p6_profile(spark: SparkSession, d: str) -> DataFrame:
    profile = heavy_keys.key_profile(_edge_sides(spark, d).where("key IS NOT NULL"), ["side", "key"], ["n_raw", "n_filtered"], (0.5, 0.9))
    return profile.withColumnRenamed("key", "issn_l")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (p2_found, p2_counts, p3_found, p3_report, p4_found, p4_children, p6_found, p6_profile)
}
