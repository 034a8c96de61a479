"""Citations per citable item over windows of two or five years.

Citations and items are grouped once into components (type, references,
retraction, kind of citing source); every policy of citable types, every
treatment and every retraction rule is then a cheap second aggregation.
Journal self-citations stay.  Citations of types that are not citable stay in
both numerators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Kinds of citing sources.
COMPONENTS = ["N-journal", "N-nonjournal", "outside-N-journal", "outside-N-book-proceedings", "other"]
# Named sets of citable types.
POLICIES = {
    "AR": ["article", "review"],
    "AR_DP": ["article", "review", "data-paper"],
    "AR_DP_SP": ["article", "review", "data-paper", "software-paper"],
    "AR_DP_SP_CP": ["article", "review", "data-paper", "software-paper", "conference-paper"],
}
RETRACTION = ["all", "without_retracted"]
# States of a score.
DEFINED, NO_REF_ITEMS, NO_ITEMS = "defined", "ref_denominator_collapse", "no_raw_citable_items"


def component_column(label: str) -> str:
    """Column name of a kind of citing source: its label in lower case, words joined by underscores."""
    return "_".join(label.lower().split("-"))


def canonical_works(rows: DataFrame, aliases: DataFrame | None) -> DataFrame:
    """Rows under their own id; those that are an alias of another work drop out."""
    return rows if aliases is None else rows.join(aliases.select(F.col("alias_id").alias("work_id")), "work_id", "left_anti")


def flat_alias_violations(aliases: DataFrame) -> DataFrame:
    """Aliases whose canonical work is an alias itself; must be empty."""
    return aliases.alias("a").join(aliases.select(F.col("alias_id").alias("again")).alias("b"), F.col("a.canonical_id") == F.col("b.again"), "left_semi")


def reference_pairs(citing: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Distinct (citing id, target id) with both ends under their canonical id."""
    pairs = citing.where(F.size("refs") > 0).select(F.col("work_id").alias("citing_id"), F.explode(F.array_distinct("refs")).alias("target_id")).where("target_id IS NOT NULL")
    if aliases is not None:
        for end in ("citing_id", "target_id"):
            m = aliases.select(F.col("alias_id").alias("__a"), F.col("canonical_id").alias("__c"))
            pairs = pairs.join(m, F.col(end) == F.col("__a"), "left").withColumn(end, F.coalesce("__c", end)).drop("__a", "__c")
    return pairs.distinct()


def met_citations(targets: DataFrame, citing: DataFrame, aliases: DataFrame | None = None) -> DataFrame:
    """Distinct citations from register sources with what components need of both works, and ``gap``, the years between them."""
    c = canonical_works(citing, aliases).where("in_n").select(F.col("work_id").alias("citing_id"), F.col("publication_year").alias("citation_year"), F.col("journal_id").alias("citing_journal"), F.col("is_retracted").alias("citing_retracted"), "source_component")
    t = canonical_works(targets, aliases).select(F.col("work_id").alias("target_id"), "journal_id", "publication_year", "work_type", "has_refs", F.col("is_retracted").alias("target_retracted"))
    met = reference_pairs(citing, aliases).join(c, "citing_id").join(t, "target_id")
    clean = ~F.col("citing_retracted") & ~F.col("target_retracted")
    return met.select("citation_year", "journal_id", "work_type", "has_refs", "source_component", clean.alias("clean"), (F.col("citing_journal") == F.col("journal_id")).alias("own"), (F.col("citation_year") - F.col("publication_year")).alias("gap"))


def components_within(met: DataFrame, window: int) -> DataFrame:
    """(citation_year, journal_id, work_type, has_refs, n_<mode>, self_<mode>, <component>_<mode>) of the citations of a window."""
    sums = []
    for mode in RETRACTION:
        counted = F.lit(True) if mode == "all" else F.col("clean")
        sums.append(F.count_if(counted).alias(f"n_{mode}"))
        sums.append(F.count_if(counted & F.col("own")).alias(f"self_{mode}"))
        sums += [F.count_if(counted & (F.col("source_component") == label)).alias(f"{component_column(label)}_{mode}") for label in COMPONENTS]
    return met.where(F.col("gap").between(1, window)).groupBy("citation_year", "journal_id", "work_type", "has_refs").agg(*sums)


def citation_components(targets: DataFrame, citing: DataFrame, window: int, aliases: DataFrame | None = None) -> DataFrame:
    """Components of the citations of a window; the citing year is a column: all years come from one pass."""
    return components_within(met_citations(targets, citing, aliases), window)


def item_components(targets: DataFrame, years: list[int], window: int) -> DataFrame:
    """(citation_year, journal_id, work_type, has_refs, is_retracted, works): items of each window."""
    served = F.filter(F.sequence(F.col("publication_year") + 1, F.col("publication_year") + window), lambda y: y.isin(years))
    return targets.select("*", F.explode(served).alias("citation_year")).groupBy("citation_year", "journal_id", "work_type", "has_refs", "is_retracted").agg(F.count("*").alias("works"))


def policy_counts(items: DataFrame, citations: DataFrame, policies: dict[str, list[str]] = POLICIES) -> DataFrame:
    """(policy, citation_year, journal_id, d_raw, d_ref, c_raw, c_ref, ...) for every journal with items or citations; missing counts are 0."""
    named = F.explode(F.array(*[F.struct(F.lit(p).alias("policy"), F.col("work_type").isin(kinds).alias("citable")) for p, kinds in policies.items()]))
    keys = ["policy", "citation_year", "journal_id"]

    def over(rows: DataFrame, **sums: Column) -> DataFrame:
        return rows.select("*", named.alias("x")).select("*", "x.*").groupBy(*keys).agg(*[F.sum(v).alias(k) for k, v in sums.items()])

    yes, no = F.col("citable"), ~F.col("citable")
    n = lambda test, value: F.when(test, F.col(value)).otherwise(0)
    d = over(items, d_raw=n(yes, "works"), d_ref=n(yes & F.col("has_refs"), "works"), d_not_citable=n(no, "works"), d_retracted=n(yes & F.col("is_retracted"), "works"))
    counted = {}
    for mode in RETRACTION:
        tail = "" if mode == "all" else "_without_retracted"
        counted |= {f"c_raw{tail}": F.col(f"n_{mode}"), f"c_ref{tail}": n(no | F.col("has_refs"), f"n_{mode}"), f"c_not_citable{tail}": n(no, f"n_{mode}"), f"c_self{tail}": F.col(f"self_{mode}")}
    c = over(citations, **counted)
    out = d.join(c, keys, "full_outer")
    return out.fillna(0, [x for x in out.columns if x not in keys])


def score_grid(counts: DataFrame) -> DataFrame:
    """Every numerator (raw, ref) over every denominator (raw, ref) under both retraction rules; no items gives null and a status."""
    cells = []
    for mode in RETRACTION:
        tail = "" if mode == "all" else "_without_retracted"
        cells += [F.struct(F.lit(mode).alias("retraction"), F.lit(a).alias("numerator"), F.lit(b).alias("denominator"), F.col(f"c_{a}{tail}").alias("citations"), F.col(f"d_{b}").alias("items")) for a in ("raw", "ref") for b in ("raw", "ref")]
    long = counts.select("policy", "citation_year", "journal_id", "d_raw", F.explode(F.array(*cells)).alias("x")).select("policy", "citation_year", "journal_id", "d_raw", "x.*")
    status = F.when(F.col("items") > 0, DEFINED).when(F.col("d_raw") > 0, NO_REF_ITEMS).otherwise(NO_ITEMS)
    return long.select("policy", "citation_year", "journal_id", "retraction", "numerator", "denominator", "citations", "items", F.try_divide(F.col("citations"), F.col("items")).alias("score"), status.alias("status"))


def with_companion(main: DataFrame, other: DataFrame, keys: list[str], score: str) -> DataFrame:
    """Rows of one window joined by the score of the other; rows of the other alone come in without counts."""
    m, o = main.withColumn("__m", F.lit(True)), other.select(*keys, F.col(score).alias(f"companion_{score}"), F.lit(True).alias("__o"))
    joined = m.join(o, keys, "full_outer")
    side = F.when(F.col("__m").isNull(), "companion_only").when(F.col("__o").isNull(), "main_only").otherwise("both")
    return joined.withColumn("row_source", side).drop("__m", "__o")


def reporting_population(existing: DataFrame, eligible: DataFrame, keys: list[str]) -> DataFrame:
    """Existing rows and the eligible keys that are new, with where they come from."""
    old = existing.select(*keys).distinct().withColumn("origin", F.lit("existing"))
    new = eligible.select(*keys).distinct().join(old.select(*keys), keys, "left_anti").withColumn("origin", F.lit("added"))
    return old.unionByName(new)


#: From this citing year on retracted works leave the numerators.
RETRACTION_FROM = 2024


def annual_ratio(counts: DataFrame, policy: str, window: int) -> DataFrame:
    """One row per year and journal under one policy: both scores by the year's retraction rule, differences and status.

    A year is mature two years later; until then its count may still grow.
    """
    late = F.col("citation_year") >= RETRACTION_FROM
    c = lambda n: F.when(late, F.col(f"c_{n}_without_retracted")).otherwise(F.col(f"c_{n}"))
    raw, ref = F.try_divide(c("raw"), F.col("d_raw")), F.try_divide(c("ref"), F.col("d_ref"))
    status = F.when(F.col("d_ref") > 0, DEFINED).when(F.col("d_raw") > 0, NO_REF_ITEMS).otherwise(NO_ITEMS)
    return counts.where(F.col("policy") == policy).select(
        "citation_year", "journal_id", F.lit(window).alias("window_years"), c("raw").alias("citations_raw"), c("ref").alias("citations_ref"), "d_raw", "d_ref", raw.alias("score_raw"), ref.alias("score_ref"), (ref - raw).alias("score_difference"),
        status.alias("status"), F.when(late, "without_retracted").otherwise("all").alias("retraction"), F.concat((F.col("citation_year") + 2).cast("string"), F.lit("-01-01")).alias("mature_on"),
    )
