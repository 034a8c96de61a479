"""Clean relations that the journal queries share."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions.ids import blank_to_null, entity_id, issn_key_is_valid, issn_key, issn_text
from quillmesh.operators import graph, identity, register
from quillmesh.operators.versions import latest_version
from quillmesh.sources.stages import durable
from quillmesh.sources.tables import table

#: What the query that is being built has asked for already, and whether shared relations are written.
_CALL: ContextVar[tuple[dict, bool] | None] = ContextVar("call", default=None)


@contextmanager
def one_call(written: bool = False) -> Iterator[None]:
    """Relations and years that one query asks for several times are made once; with ``written`` the shared relations are stages.

    A query inside a query shares the outer one's.  Nothing outlives the call, so tables may change between two.
    """
    if _CALL.get() is not None:
        yield
        return
    token = _CALL.set(({}, written))
    try:
        yield
    finally:
        _CALL.reset(token)


def shared(write: bool):
    """Marks a relation or value of (spark, folder, ...) that queries share; ``write``: worth a stage where several parts of a plan read it."""

    def mark(f):
        @wraps(f)
        def run(spark: SparkSession, d: str, *given):
            call = _CALL.get()
            if call is None:
                return f(spark, d, *given)
            memo, written = call
            key = (f.__name__, id(spark), d, *given)
            if key not in memo:
                made = f(spark, d, *given)
                memo[key] = durable(made) if write and written else made
            return memo[key]

        return run

    return mark


@shared(write=False)
def years_of(spark: SparkSession, d: str, name: str, column: str) -> list[int]:
    """Distinct years of a table in order; as many values as there are years reach the driver."""
    return sorted(r[0] for r in table(spark, d, name).select(column).where(F.col(column).isNotNull()).distinct().collect())


def score_years(spark: SparkSession, d: str) -> list[int]:
    return years_of(spark, d, "effective_counts", "score_year")


def citation_years(spark: SparkSession, d: str) -> list[int]:
    return years_of(spark, d, "citing", "publication_year")


@shared(write=True)
def newest_sources(spark: SparkSession, d: str) -> DataFrame:
    """The newest version of every source in the newest snapshot; the snapshot date is one value, found first so that the scan is filtered."""
    rows = table(spark, d, "source_rows")
    newest = rows.agg(F.max("snapshot_date")).first()[0]
    kept = rows.where(F.col("snapshot_date") == newest).withColumn("source_id", entity_id("source_id", "S")).where("source_id IS NOT NULL")
    latest = latest_version(kept, ["source_id"], [F.desc_nulls_last("updated_date"), F.desc_nulls_last("loaded_at")])
    raw = issn_key("raw_issn_l")
    return latest.select(
        "source_id",
        "raw_issn_l",
        issn_text("raw_issn_l").alias("raw_key"),
        F.when(issn_key_is_valid(raw), issn_text("raw_issn_l")).alias("effective_key"),
        F.lower(blank_to_null("source_type")).alias("source_type"),
        "title",
        "publisher",
        "issns",
        "oa_field",
        "oa_domain",
        "is_open_access",
        "updated_date",
    )


@shared(write=True)
def counts(spark: SparkSession, d: str) -> DataFrame:
    """(score_year, issn_l, a_raw, a_filtered): the last delivered row of each journal year."""
    rows = table(spark, d, "effective_counts").select("score_year", issn_text("issn_l").alias("issn_l"), "a_raw", "a_filtered", "loaded_at").where("issn_l IS NOT NULL AND score_year IS NOT NULL")
    order = [F.desc_nulls_last("loaded_at"), F.desc_nulls_last("a_raw"), F.desc_nulls_last("a_filtered")]
    return latest_version(rows, ["score_year", "issn_l"], order).drop("loaded_at")


def edges(spark: SparkSession, d: str) -> DataFrame:
    """(score_year, citing, cited, n_raw, n_filtered): partial counts summed, rows delivered twice counted once."""
    rows = table(spark, d, "effective_edges").select("score_year", "chunk_no", issn_text("citing_issn_l").alias("citing"), issn_text("cited_issn_l").alias("cited"), "n_raw", "n_filtered", "extracted_at")
    # Partitioned by the pair, the rows of a pair meet once for dropping repeats and for the sums.
    once = rows.where("citing IS NOT NULL AND cited IS NOT NULL").repartition("score_year", "citing", "cited").distinct()
    return once.groupBy("score_year", "citing", "cited").agg(F.sum("n_raw").alias("n_raw"), F.coalesce(F.sum("n_filtered"), F.lit(0)).alias("n_filtered"))


def _flat_works(rows: DataFrame) -> DataFrame:
    return rows.select(
        "record_id",
        entity_id("id", "W").alias("work_id"),
        entity_id("primary_location.source.id", "S").alias("source_id"),
        issn_text("primary_location.source.issn_l").alias("raw_issn_l"),
        F.col("publication_year").alias("year"),
        F.col("type").alias("work_type"),
        (F.coalesce("referenced_works_count", F.lit(0)) > 0).alias("has_refs"),
        F.transform(F.coalesce("referenced_works", F.array().cast("array<string>")), lambda x: entity_id(x, "W")).alias("refs"),
        "updated_date",
        "is_paratext",
        "is_retracted",
        F.coalesce(F.nullif("primary_topic.field.display_name", F.lit("")), F.lit("Unknown")).alias("field"),
        "doi",
        F.col("primary_location.landing_page_url").alias("url"),
        fingerprint().alias("fingerprint"),
    )


def fingerprint() -> Column:
    """Hash of what a version of a work says to the graph: source, key, year, type and references."""
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("~"))
    refs = F.coalesce(F.array_join("referenced_works", ",", "~"), F.lit("~"))
    return F.md5(F.concat_ws("|", said("primary_location.source.id"), said("primary_location.source.issn_l"), said("publication_year"), said("type"), said("referenced_works_count"), refs))


def works(spark: SparkSession, d: str) -> DataFrame:
    """Works of all types with flat columns, the newest version of each."""
    flat = _flat_works(table(spark, d, "fixture"))
    return latest_version(flat.where("work_id IS NOT NULL"), ["work_id"], [F.desc_nulls_last("updated_date"), F.desc("record_id")])


def eligible_works(spark: SparkSession, d: str, years: list[int] | None = None) -> DataFrame:
    """Works that count for the score years: records are filtered at the scan, then the newest version of each work is chosen.

    Ties go to the smaller key, then to the smaller fingerprint, then to the earlier record.  References are kept for
    works of a score year only, the others cite nothing here.
    """
    years = score_years(spark, d) if years is None else years
    flat = _flat_works(graph.eligible_rows(table(spark, d, "fixture"), years)).where("work_id IS NOT NULL AND raw_issn_l IS NOT NULL")
    chosen = latest_version(flat, ["work_id"], [F.desc_nulls_last("updated_date"), F.asc("raw_issn_l"), F.asc("fingerprint"), F.asc("record_id")])
    return chosen.withColumn("refs", F.when(F.col("year").isin(years), F.col("refs")))


@shared(write=True)
def targets(spark: SparkSession, d: str) -> DataFrame:
    """Citable works, the last delivery of each, without those that are withdrawn."""
    rows = table(spark, d, "targets").withColumn("work_id", entity_id("work_id", "W")).where("work_id IS NOT NULL")
    last = latest_version(rows, ["work_id"], [F.desc_nulls_last("arrived_at"), F.asc_nulls_last("deleted_at"), F.asc_nulls_last("journal_id")]).where("deleted_at IS NULL")
    return last.select("work_id", blank_to_null("journal_id").alias("journal_id"), "publication_year", "work_type", (F.coalesce("observed_references", F.lit(0)) > 0).alias("has_refs"), F.coalesce("is_retracted", F.lit(False)).alias("is_retracted"))


@shared(write=True)
def citing(spark: SparkSession, d: str) -> DataFrame:
    """Citing works, the last delivery of each."""
    rows = table(spark, d, "citing").withColumn("work_id", entity_id("work_id", "W")).where("work_id IS NOT NULL")
    last = latest_version(rows, ["work_id"], [F.desc_nulls_last("arrived_at"), F.desc(F.size(F.coalesce("references", F.array().cast("array<string>"))))])
    return last.select(
        "work_id",
        blank_to_null("journal_id").alias("journal_id"),
        "publication_year",
        F.filter(F.transform(F.coalesce("references", F.array().cast("array<string>")), lambda x: entity_id(x, "W")), lambda x: x.isNotNull()).alias("refs"),
        F.coalesce("is_retracted", F.lit(False)).alias("is_retracted"),
        F.coalesce("in_n", F.lit(False)).alias("in_n"),
        "source_component",
    )


@shared(write=True)
def matched_register(spark: SparkSession, d: str) -> DataFrame:
    members = register.roster(table(spark, d, "norwegian_membership"))
    return register.match_by_issn(members, register.aliases_of_sources(newest_sources(spark, d)))


@shared(write=True)
def universes(spark: SparkSession, d: str) -> DataFrame:
    """(score_year, universe, issn_l): ``n`` are register members, ``oa`` keys of sources of type journal, in every score year."""
    n = matched_register(spark, d).where("issn_l IS NOT NULL").select("score_year", F.lit("n").alias("universe"), "issn_l")
    oa = newest_sources(spark, d).where("effective_key IS NOT NULL AND source_type = 'journal'").select(F.explode(F.lit(score_years(spark, d)).cast("array<int>")).alias("score_year"), F.lit("oa").alias("universe"), F.col("effective_key").alias("issn_l"))
    return n.unionByName(oa).distinct()


def states(spark: SparkSession, d: str) -> DataFrame:
    return graph.universe_states(counts(spark, d), edges(spark, d), universes(spark, d))


@shared(write=True)
def decisions(spark: SparkSession, d: str) -> DataFrame:
    """(component, member, chosen) of approved decisions; the smallest choice where reviews differ."""
    reviewed = table(spark, d, "reviewed_representative").where(F.lower(blank_to_null("review_status")).startswith("approved"))
    rows = reviewed.select(issn_text("issn_l").alias("component"), entity_id("canonical_source_id", "S").alias("chosen"), F.explode("expected_component_source_ids").alias("m"))
    rows = rows.select("component", entity_id("m", "S").alias("member"), "chosen").where("member IS NOT NULL AND chosen IS NOT NULL AND component IS NOT NULL")
    return rows.groupBy("member").agg(F.min("component").alias("component"), F.min("chosen").alias("chosen"))


@shared(write=False)
def identity_tables(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(overrides, aliases, corrections) that the project's reviews and source lists give."""
    src = newest_sources(spark, d)
    overrides = decisions(spark, d).join(src.select(F.col("source_id").alias("member"), "raw_key"), "member").select(F.col("member").alias("source_id"), F.col("raw_key").alias("expected_key"), F.col("component").alias("target"))
    other = register.aliases_of_sources(src).where("issn <> regexp_replace(effective_key, '-', '')")
    aliases = other.groupBy(issn_text("issn").alias("alias")).agg(F.count_distinct("effective_key").alias("n"), F.min("effective_key").alias("target")).where("n = 1").select("alias", "target")
    corrections = table(spark, d, "reviewed_representative").where(F.lower(blank_to_null("review_status")) == "rejected").select(issn_text("issn_l").alias("key"), issn_text("issn_l").alias("target")).where("key IS NOT NULL").distinct()
    return overrides, aliases, corrections


def projected_sources(spark: SparkSession, d: str) -> DataFrame:
    """Newest sources under their effective key; the text ``Unknown`` is a missing field or domain."""
    known = {c: F.when(blank_to_null(c) != "Unknown", F.col(c)) for c in ("oa_field", "oa_domain")}
    return identity.project_keys(newest_sources(spark, d).drop("effective_key").withColumns(known), "source_id", "raw_key", *identity_tables(spark, d))


def attributes(spark: SparkSession, d: str) -> DataFrame:
    """Attributes of effective journals by consensus."""
    return identity.effective_sources(projected_sources(spark, d), ["title", "publisher", "source_type", "oa_field", "oa_domain", "is_open_access"])


def journal_years(spark: SparkSession, d: str) -> DataFrame:
    """One row per score year and journal key with counts, citations, consensus attributes, register areas and universes."""
    c = counts(spark, d)
    src = newest_sources(spark, d).where("effective_key IS NOT NULL")
    # A key of its own belongs to the ISSNs of a journal even where no source lists it.
    listed = src.select("effective_key", F.explode(F.array_append(F.coalesce("issns", F.array().cast("array<string>")), F.col("effective_key"))).alias("x")).select("effective_key", issn_text("x").alias("x")).where("x IS NOT NULL").groupBy("effective_key").agg(F.array_join(F.array_sort(F.collect_set("x")), ";").alias("issns"))
    agreed = attributes(spark, d).select("effective_key", "title", "publisher", F.col("oa_field").alias("field"), F.col("oa_domain").alias("domain"), (F.col("is_open_access") == "true").alias("is_open_access"))
    u = universes(spark, d).groupBy("score_year", "issn_l").agg(F.bool_or(F.col("universe") == "n").alias("in_n"), F.bool_or(F.col("universe") == "oa").alias("in_oa"))
    years = score_years(spark, d)
    areas = register.areas(matched_register(spark, d), table(spark, d, "norwegian_membership"))
    joined = (
        c.join(graph.recorded_citations(edges(spark, d)), ["score_year", "issn_l"], "left")
        .join(graph.active_years(graph.yearly_counts(eligible_works(spark, d, years)), years), ["score_year", "issn_l"], "left")
        .join(u, ["score_year", "issn_l"], "left")
        .join(areas, ["score_year", "issn_l"], "left")
        .join(agreed, F.col("issn_l") == F.col("effective_key"), "left").drop("effective_key")
        .join(listed, F.col("issn_l") == F.col("effective_key"), "left").drop("effective_key")
    )
    return joined.select(
        "score_year", F.col("issn_l").alias("journal_id"), "title", "publisher", "issns", "domain", "field", "is_open_access", "register_area", "register_field",
        F.coalesce("in_n", F.lit(False)).alias("in_n"), F.coalesce("in_oa", F.lit(False)).alias("in_oa"),
        F.col("a_raw").alias("works_raw"), F.col("a_filtered").alias("works_filtered"), F.coalesce("recorded_raw", F.lit(0)).alias("citations"), F.coalesce("recorded_filtered", F.lit(0)).alias("citations_filtered"),
        F.try_divide(100.0 * F.col("a_filtered"), F.col("a_raw")).alias("coverage"), F.coalesce("active_years", F.lit(0)).alias("active_years"),
    )
