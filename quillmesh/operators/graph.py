"""Publications, citations and the journal graph.

Years, universes and treatments are columns: one plan covers all score years.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# Work types that may cite.
CITING_TYPES = [
    "article", "review", "letter", "editorial", "preprint", "book-chapter", "erratum", "other", "retraction", "report", "dissertation",
    "supplementary-materials", "dataset", "reference-entry", "book",
]
# Work types that are cited.
CITED_TYPES = ["article", "review"]

#: Years before the score year whose publications count.
WINDOW = 5


def eligible_rows(works: DataFrame, years: list[int], window: int = WINDOW) -> DataFrame:
    """Works records of the years and types that count for the score years, with a journal key and no paratext.

    Null paratext counts as none.  The conditions are on the columns as stored, before a version is chosen: they reach the
    scan, and a work whose newest record does not count keeps its newest one that does.
    """
    if not years:
        return works.where(F.lit(False))
    return works.where(
        F.col("publication_year").between(min(years) - window, max(years)) & F.col("type").isin(CITING_TYPES) & F.col("primary_location.source.issn_l").isNotNull() & (F.col("is_paratext").isNull() | (F.col("is_paratext") == F.lit(False)))
    )


def yearly_counts(works: DataFrame) -> DataFrame:
    """(source_id, raw_issn_l, year, a_raw, a_filtered): citable works, and those with references."""
    citable = works.where(F.col("work_type").isin(CITED_TYPES))
    return citable.groupBy("source_id", "raw_issn_l", "year").agg(F.count("*").alias("a_raw"), F.count_if("has_refs").alias("a_filtered"))


def window_counts(yearly: DataFrame, score_years: list[int], window: int = WINDOW) -> DataFrame:
    """Totals over the window before each score year; each yearly count is repeated for the years it serves, so the rest is an equi-group."""
    served = F.filter(F.sequence(F.col("year") + 1, F.col("year") + window), lambda y: y.isin(score_years))
    return yearly.select("*", F.explode(served).alias("score_year")).groupBy("score_year", "source_id", "raw_issn_l").agg(F.sum("a_raw").alias("a_raw"), F.sum("a_filtered").alias("a_filtered"))


def active_years(yearly: DataFrame, score_years: list[int], window: int = WINDOW, key: str = "raw_issn_l") -> DataFrame:
    """(score_year, issn_l, active_years): years of the window before the score year in which the key has publications; ``yearly`` as of :func:`yearly_counts`."""
    alive = yearly.where(F.col(key).isNotNull() & (F.col("a_raw") > 0)).select(F.col(key).alias("issn_l"), "year").distinct()
    served = F.filter(F.sequence(F.col("year") + 1, F.col("year") + window), lambda y: y.isin(score_years))
    return alive.select("issn_l", F.explode(served).alias("score_year")).groupBy("score_year", "issn_l").agg(F.count("*").alias("active_years"))


def citation_edges(citing: DataFrame, cited: DataFrame, window: int = WINDOW) -> DataFrame:
    """Citations between journals for every score year.

    ``citing``: (work_id, year, source_id, raw_issn_l, refs); ``cited``: (work_id, year, source_id, raw_issn_l, has_refs).
    Repeated references of a work count once; the window is a residual test on the equi-join by work id.
    """
    refs = citing.where(F.size("refs") > 0).select(F.col("year").alias("score_year"), F.col("source_id").alias("citing_source_id"), F.col("raw_issn_l").alias("raw_citing_issn_l"), F.explode(F.array_distinct("refs")).alias("ref_id"))
    works = cited.select(F.col("work_id").alias("ref_id"), F.col("year").alias("cited_year"), F.col("source_id").alias("cited_source_id"), F.col("raw_issn_l").alias("raw_cited_issn_l"), "has_refs")
    met = refs.join(works, "ref_id").where((F.col("cited_year") < F.col("score_year")) & (F.col("cited_year") >= F.col("score_year") - window))
    return met.groupBy("score_year", "citing_source_id", "raw_citing_issn_l", "cited_source_id", "raw_cited_issn_l").agg(F.count("*").alias("n_raw"), F.count_if("has_refs").alias("n_filtered"))


def role_masses(counts: DataFrame, edges: DataFrame) -> DataFrame:
    """(score_year, key, a_raw, a_filtered, citing_n_raw, ..., cited_n_filtered): the mass of a key in each of its roles."""
    zero = F.lit(0).cast("long")

    def arm(rows: DataFrame, key: str, **given: str) -> DataFrame:
        names = ["a_raw", "a_filtered", "citing_n_raw", "citing_n_filtered", "cited_n_raw", "cited_n_filtered"]
        return rows.select("score_year", F.col(key).alias("issn_l"), *[(F.coalesce(F.col(given[n]), zero) if n in given else zero).alias(n) for n in names])

    arms = (
        arm(counts, "issn_l", a_raw="a_raw", a_filtered="a_filtered")
        .unionByName(arm(edges, "citing", citing_n_raw="n_raw", citing_n_filtered="n_filtered"))
        .unionByName(arm(edges, "cited", cited_n_raw="n_raw", cited_n_filtered="n_filtered"))
    )
    return arms.groupBy("score_year", "issn_l").agg(*[F.sum(c).alias(c) for c in arms.columns[2:]])


def key_variants(rows: DataFrame, entity: str, key: str, status: Column) -> DataFrame:
    """Per entity: its key variants in order, how many there are, and how many are missing or invalid."""
    pairs = rows.select(entity, key, status.alias("status")).distinct()
    return pairs.groupBy(entity).agg(
        F.count("*").alias("n_variants"),
        F.array_join(F.array_sort(F.collect_set(key)), " | ").alias("variants"),
        F.count_if(F.col("status") == "missing").alias("n_missing"),
        F.count_if(F.col("status").startswith("invalid")).alias("n_invalid"),
        F.bool_or(F.col("status") == "valid").alias("has_valid"),
    )


def universe_states(counts: DataFrame, edges: DataFrame, members: DataFrame) -> DataFrame:
    """(score_year, universe, issn_l): keys that are active (publications, or an edge on either side) and members.

    The state is fixed by the raw counts for both treatments.
    """
    ends = edges.where("n_raw > 0").select("score_year", F.explode(F.array("citing", "cited")).alias("issn_l"))
    active = counts.where("a_raw > 0").select("score_year", "issn_l").unionByName(ends).distinct()
    return members.select("score_year", "universe", "issn_l").distinct().join(active, ["score_year", "issn_l"], "left_semi").select("score_year", "universe", "issn_l")


def state_edges(edges: DataFrame, states: DataFrame) -> DataFrame:
    """Edges with both ends in the state, without self-citations, per universe.

    The universes of a key are one short array, so edges meet each end once and are repeated by universe only after both
    ends have passed.  The states have one row a key and year: adaptive execution broadcasts them below its
    size limit and splits hot keys beyond.
    """
    named = states.groupBy("score_year", "issn_l").agg(F.collect_set("universe").alias("u"))
    end = lambda side: named.select("score_year", F.col("issn_l").alias(side), F.col("u").alias(f"__{side}"))
    met = edges.where("citing <> cited").join(end("citing"), ["score_year", "citing"]).join(end("cited"), ["score_year", "cited"])
    return met.select(*edges.columns, F.explode(F.array_intersect("__citing", "__cited")).alias("universe"))


def used_citations(edges: DataFrame, states: DataFrame) -> DataFrame:
    """Citations a member receives inside its universe; members without any have 0, others no row."""
    sums = state_edges(edges, states).groupBy("score_year", "universe", F.col("cited").alias("issn_l")).agg(F.sum("n_raw").alias("used_raw"), F.sum("n_filtered").alias("used_filtered"))
    return states.join(sums, ["score_year", "universe", "issn_l"], "left").fillna(0, ["used_raw", "used_filtered"])


def recorded_citations(edges: DataFrame) -> DataFrame:
    """Citations received from all other journals."""
    return edges.where("citing <> cited").groupBy("score_year", F.col("cited").alias("issn_l")).agg(F.sum("n_raw").alias("recorded_raw"), F.sum("n_filtered").alias("recorded_filtered"), F.count("*").alias("n_citing_journals"))


def column_normalised(edges: DataFrame, cell: list[str], weight: str = "w") -> DataFrame:
    """Edges with ``h``: the weight over all weight that leaves the citing node."""
    return edges.withColumn("h", F.col(weight) / F.sum(weight).over(W.partitionBy(*cell, "citing")))
