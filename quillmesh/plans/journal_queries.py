"""Queries of the citation engine over the project's tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.functions.ids import blank_to_null, entity_id, issn_status, issn_text
from quillmesh.operators import fields, graph, identity, publish, ranks, ratio, register, scores, versions, views
from quillmesh.plans import base
from quillmesh.sources.stages import durable
from quillmesh.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(f: Query) -> Query:
    """Registers a query; what it asks for several times is made once a call."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        with base.one_call():
            return f(spark, d)

    QUERIES[f.__name__] = run
    return f


def wide_query(f: Query) -> Query:
    """Registers a query whose plan reads shared relations in many places: they are written once a call."""

    def run(spark: SparkSession, d: str) -> DataFrame:
        with base.one_call(written=True):
            return f(spark, d)

    QUERIES[f.__name__] = run
    return f


# --- works, versions, ledgers ---------------------------------------------------------------------------------


@query
def version_dedup(spark, d):
    return base.works(spark, d).select("work_id", "record_id", "source_id", "raw_issn_l", "year", "work_type", "has_refs")


@query
def latest_with_ties(spark, d):
    rows = table(spark, d, "source_rows").select(blank_to_null("snapshot_date").alias("snapshot_date"), entity_id("source_id", "S").alias("source_id"), "updated_date", "title", "publisher", "oa_field", "is_open_access").where("source_id IS NOT NULL")
    tied = versions.latest_with_ties(rows, ["snapshot_date", "source_id"], [F.desc_nulls_last("updated_date")])
    return tied.groupBy("snapshot_date", "source_id").agg(F.count("*").alias("n_states"))


@query
def works_filter_project(spark, d):
    w = base.eligible_works(spark, d)
    return w.select("work_id", "raw_issn_l", "year", F.col("work_type").isin(graph.CITED_TYPES).alias("is_citable"), "has_refs", "field", F.when(F.col("refs").isNotNull(), F.size("refs")).cast("long").alias("n_refs"))


@query
def yearly_counts(spark, d):
    return graph.yearly_counts(base.eligible_works(spark, d))


@query
def window_counts(spark, d):
    return graph.window_counts(yearly_counts(spark, d), base.score_years(spark, d))


@query
def citation_edges(spark, d):
    w = base.eligible_works(spark, d)
    citing = w.where(F.col("has_refs") & F.col("refs").isNotNull())
    return graph.citation_edges(citing.select("work_id", "year", "source_id", "raw_issn_l", "refs"), w.where(F.col("work_type").isin(graph.CITED_TYPES)))


def _ledger(spark, d) -> tuple[DataFrame, DataFrame]:
    """Work overrides from approved decisions (works of a member go to the canonical source) and exclusions of retracted works."""
    decided = base.decisions(spark, d).where("member <> chosen").select(F.col("member").alias("expected_source_id"), F.col("chosen").alias("target_source_id"), F.col("component").alias("expected_raw_issn_l"))
    w = base.works(spark, d).select("work_id", "source_id", "is_retracted")
    overrides = w.join(decided, F.col("source_id") == F.col("expected_source_id")).select("work_id", "expected_source_id", "expected_raw_issn_l", "target_source_id")
    return overrides, w.where("is_retracted").select("work_id")


@query
def ledger_patch_exclude(spark, d):
    overrides, excluded = _ledger(spark, d)
    out = versions.patched(base.works(spark, d), "work_id", overrides, {"source_id": "target_source_id"}, excluded)
    return out.select("work_id", "source_id", "raw_issn_l", "year", "patched")


@query
def preimage_audit(spark, d):
    overrides, _ = _ledger(spark, d)
    return versions.preimage_audit(base.works(spark, d), "work_id", overrides, {"source_id": "expected_source_id", "raw_issn_l": "expected_raw_issn_l"})


@query
def field_votes(spark, d):
    w = base.eligible_works(spark, d).where(F.col("work_type").isin(graph.CITED_TYPES))
    return w.groupBy("raw_issn_l", "field").agg(F.count("*").alias("votes"))


@query
def doi_and_host(spark, d):
    host = F.lower(F.regexp_extract("url", r"^https?://([^/:?#]+)", 1))
    prefix = F.regexp_extract("doi", r"^(10\.[0-9]{4,9})/\S+$", 1)
    return base.works(spark, d).groupBy(F.coalesce(F.nullif(host, F.lit("")), F.lit("none")).alias("host"), F.coalesce(F.nullif(prefix, F.lit("")), F.lit("none")).alias("doi_prefix")).agg(F.count("*").alias("n_works"))


@query
def row_fingerprints(spark, d):
    """Repeated payloads: distinct fingerprints of the descriptive columns and how often each work repeats one."""
    rows = table(spark, d, "fixture").select(entity_id("id", "W").alias("work_id"), F.md5(F.concat_ws("|", F.coalesce("type", F.lit("~")), F.coalesce(F.col("publication_year").cast("string"), F.lit("~")), F.coalesce("doi", F.lit("~")), F.coalesce("title", F.lit("~")))).alias("fingerprint"))
    return rows.groupBy("work_id").agg(F.count("*").alias("n_rows"), F.count_distinct("fingerprint").alias("n_fingerprints")).where("n_rows > 1")


# --- identity -------------------------------------------------------------------------------------------------


@query
def identity_projection(spark, d):
    out = identity.project_keys(base.newest_sources(spark, d).drop("effective_key"), "source_id", "raw_key", *base.identity_tables(spark, d))
    return out.select("source_id", "raw_key", "effective_key", "projected_by")


@query
def identity_quarantine(spark, d):
    w = base.works(spark, d).where("source_id IS NOT NULL").withColumn("works", F.lit(1))
    out = identity.project_keys(w, "source_id", "raw_issn_l", *base.identity_tables(spark, d))
    return identity.quarantine(out, "raw_issn_l", ["works"])


@query
def projected_counts(spark, d):
    """Publication counts under effective keys; aliased keys add up."""
    out = identity.project_keys(window_counts(spark, d), "source_id", "raw_issn_l", *base.identity_tables(spark, d))
    return out.where("effective_key IS NOT NULL").groupBy("score_year", F.col("effective_key").alias("issn_l")).agg(F.sum("a_raw").alias("a_raw"), F.sum("a_filtered").alias("a_filtered"))


@query
def null_safe_identity(spark, d):
    w = base.works(spark, d)
    m = w.select("source_id", F.col("raw_issn_l").alias("raw_key"), F.coalesce("raw_issn_l", F.concat(F.lit("oa:"), "source_id"), F.lit("none")).alias("effective_key")).distinct()
    mapped = identity.null_safe_mapping(w.select("work_id", "source_id", "raw_issn_l"), m, {"journal_id": ("source_id", "raw_issn_l")})
    return mapped.groupBy("journal_id").agg(F.count("*").alias("n_works"))


@query
def projected_edges(spark, d):
    """Citations between effective keys; an end without a valid key is null: the edge is in quarantine."""
    return identity.project_edges(citation_edges(spark, d), *base.identity_tables(spark, d))


@query
def projection_conservation(spark, d):
    """What went into the projection of edges is what came out under keys and what is in quarantine."""
    before = citation_edges(spark, d).groupBy("score_year").agg(F.sum("n_raw").alias("input_n_raw"), F.sum("n_filtered").alias("input_n_filtered"))
    return before.join(identity.edge_conservation(projected_edges(spark, d)), "score_year")


@query
def attribute_consensus(spark, d):
    return base.attributes(spark, d)


@query
def journal_export_view(spark, d):
    return identity.journal_view(base.projected_sources(spark, d))


@query
def representative_arms(spark, d):
    decided = base.decisions(spark, d).select(F.col("member").alias("source_id"), "chosen")
    out = identity.suppress_arms(base.newest_sources(spark, d).select("source_id", "effective_key"), decided)
    return out.select("source_id", "effective_key", "shown")


@query
def issn_key_status(spark, d):
    rows = table(spark, d, "source_rows").select("snapshot_date", issn_status("raw_issn_l").alias("status"))
    return rows.groupBy("snapshot_date", "status").agg(F.count("*").alias("n_rows"))


@query
def source_key_variants(spark, d):
    rows = table(spark, d, "source_rows").select(entity_id("source_id", "S").alias("source_id"), issn_text("raw_issn_l").alias("raw_key")).where("source_id IS NOT NULL")
    return graph.key_variants(rows, "source_id", "raw_key", issn_status("raw_key"))


# --- register -------------------------------------------------------------------------------------------------


@query
def register_roster(spark, d):
    return register.roster(table(spark, d, "norwegian_membership")).select("score_year", "journal_id", "level", F.array_join("issns", ",").alias("issns"))


@query
def register_match(spark, d):
    return base.matched_register(spark, d)


@query
def register_match_summary(spark, d):
    return base.matched_register(spark, d).groupBy("score_year", "outcome").agg(F.count("*").alias("n_journals"))


@query
def register_group(spark, d):
    return register.grouped_members(base.matched_register(spark, d))


@query
def register_entries(spark, d):
    titles = table(spark, d, "norwegian_membership").select("score_year", blank_to_null("journal_id").alias("journal_id"), blank_to_null("international_title").alias("title"), "print_issn", "online_issn")
    return register.display_entries(base.matched_register(spark, d), titles)


@query
def register_primary_title(spark, d):
    """The slice of :func:`register_primary_titles` that its SQL twin fixes: score year 2025, international titles."""
    m = base.matched_register(spark, d).where("score_year = 2025 AND issn_l IS NOT NULL").select("journal_id", "issn_l")
    titles = table(spark, d, "norwegian_membership").where("score_year = 2025").select(blank_to_null("journal_id").alias("journal_id"), F.col("international_title").alias("title"))
    wanted = base.newest_sources(spark, d).where("effective_key IS NOT NULL").select(F.col("effective_key").alias("issn_l"), "title")
    return register.primary_by_title(m.join(titles, "journal_id"), wanted)


@query
def register_primary_titles(spark, d):
    """Of every score year, by the original or the international title; ``n_journals`` tells a choice among several entries from an only one."""
    m = base.matched_register(spark, d).where("issn_l IS NOT NULL").select("score_year", "journal_id", "issn_l")
    titles = table(spark, d, "norwegian_membership").select("score_year", blank_to_null("journal_id").alias("journal_id"), F.explode(F.array("original_title", "international_title")).alias("title"))
    wanted = base.newest_sources(spark, d).where("effective_key IS NOT NULL").select(F.col("effective_key").alias("issn_l"), "title")
    primary = register.primary_by_title(m.join(titles, ["score_year", "journal_id"]), wanted, years=True)
    return primary.join(m.groupBy("score_year", "issn_l").agg(F.count("*").alias("n_journals")), ["score_year", "issn_l"])


@query
def register_urls(spark, d):
    urls = register.grouped_members(base.matched_register(spark, d)).select("score_year", "issn_l", F.array_join(F.transform(F.split("journal_ids", r" \| "), lambda x: register.entry_url(x)), "; ").alias("urls"))
    return urls.select("score_year", "issn_l", F.array_join(register.ids_of_urls(F.col("urls")), ", ").alias("ids"))


@query
def register_levels(spark, d):
    rows = table(spark, d, "norwegian_membership").groupBy(blank_to_null("journal_id").alias("journal_id")).agg(F.array_join(F.array_sort(F.collect_set(F.col("norwegian_level").cast("string"))), " | ").alias("levels"))
    return rows.select("journal_id", register.level_text(F.col("levels")).alias("level"))


# --- graph and scores -----------------------------------------------------------------------------------------


@query
def journal_edges(spark, d):
    return base.edges(spark, d)


@query
def role_masses(spark, d):
    return graph.role_masses(base.counts(spark, d), base.edges(spark, d))


@query
def universe_states(spark, d):
    return base.states(spark, d)


@query
def used_citations(spark, d):
    states, edges, _ = _graph(spark, d)
    return graph.used_citations(edges, states)


@query
def recorded_citations(spark, d):
    return graph.recorded_citations(base.edges(spark, d))


@query
def active_years(spark, d):
    return graph.active_years(yearly_counts(spark, d), base.score_years(spark, d))


@query
def column_normalised(spark, d):
    _, e = _cells(spark, d)
    return graph.column_normalised(e, scores.CELL).select(*scores.CELL, "citing", "cited", F.round("h", 9).alias("h"))


def _graph(spark, d):
    """(states, edges, counts), written once: everything about scores reads them several times."""
    c, e = durable(base.counts(spark, d)), durable(base.edges(spark, d))
    return durable(graph.universe_states(c, e, base.universes(spark, d))), e, c


def _cells(spark, d, parts=None):
    s, e, c = parts or _graph(spark, d)
    nodes, arcs = scores.cells(s, graph.state_edges(e, s), c)
    return nodes, durable(arcs)


def _scores(spark, d):
    return scores.network_scores(*_cells(spark, d))


@query
def network_scores(spark, d):
    return _scores(spark, d).select(*scores.CELL, "issn_l", F.round("share", 8).alias("share"), F.round("per_article", 7).alias("per_article"), F.round("normalised", 7).alias("normalised"), "defined")


@query
def score_input_faults(spark, d):
    """What would make scores meaningless, rule by rule; a publication requires that every number is 0."""
    s, e, c = _graph(spark, d)
    return scores.input_faults(c, e, s)


@query
def score_audit(spark, d):
    nodes, e = _cells(spark, d)
    return scores.score_audit(scores.network_scores(nodes, e), e)


@query
def isolated_nodes(spark, d):
    nodes, e = _cells(spark, d)
    return scores.isolated(nodes, e).select(*scores.CELL, "issn_l", "articles")


@query
def annual_scores_wide(spark, d):
    wide = publish.wide_scores(_scores(spark, d))
    return wide.select("score_year", "issn_l", *[F.round(c, 7).alias(c) for c in wide.columns[2:]])


@wide_query
def annual_table(spark, d):
    parts = _graph(spark, d)
    jy = base.journal_years(spark, d).select("score_year", "journal_id", "title", "in_n", "in_oa", "works_raw", "works_filtered", "citations", "active_years")
    solved = scores.network_scores(*_cells(spark, d, parts))
    out = publish.annual_table(jy, solved, graph.used_citations(parts[1], parts[0]), fields.modal_field(_votes(spark, d), VOTES_BY), register.grouped_members(base.matched_register(spark, d)))
    return out.withColumns({c: F.round(c, 7) for c in out.columns if c.startswith(("share_", "per_article_"))})


@wide_query
def closed_share(spark, d):
    s, e, c = parts = _graph(spark, d)
    nodes, inside = _cells(spark, d, parts)
    every = e.where("citing <> cited").join(s.select("score_year", "universe", F.col("issn_l").alias("citing")), ["score_year", "citing"])
    _, full = scores.cells(s, every, c)
    out = scores.closed_share(full, inside, scores.network_scores(nodes, inside))
    return out.withColumn("closed_share", F.round("closed_share", 7))


# --- ratios ---------------------------------------------------------------------------------------------------

@base.shared(write=True)
def _met(spark, d):
    return ratio.met_citations(base.targets(spark, d).where("journal_id IS NOT NULL"), base.citing(spark, d))


def _ratio_parts(spark, d, window, aliases=None):
    t, c = base.targets(spark, d).where("journal_id IS NOT NULL"), base.citing(spark, d)
    met = _met(spark, d) if aliases is None else ratio.met_citations(t, c, aliases)
    return ratio.item_components(ratio.canonical_works(t, aliases), base.citation_years(spark, d), window), ratio.components_within(met, window)


@query
def ratio_components(spark, d):
    return _ratio_parts(spark, d, 5)[1]


@query
def ratio_items(spark, d):
    return _ratio_parts(spark, d, 5)[0]


def _policy_counts(spark, d, window):
    return ratio.policy_counts(*_ratio_parts(spark, d, window))


@query
def ratio_policies_two_years(spark, d):
    return _policy_counts(spark, d, 2)


@query
def ratio_policies_five_years(spark, d):
    return _policy_counts(spark, d, 5)


@query
def ratio_grid(spark, d):
    return ratio.score_grid(_policy_counts(spark, d, 2)).withColumn("score", F.round("score", 9))


@query
def ratio_annual(spark, d):
    out = ratio.annual_ratio(_policy_counts(spark, d, 5), "AR", 5)
    return out.withColumns({c: F.round(c, 9) for c in ("score_raw", "score_ref", "score_difference")})


def _aliases(spark, d) -> DataFrame:
    """Works that share a DOI stand for one: every later id is an alias of the smallest."""
    rows = base.works(spark, d).where("doi IS NOT NULL").select(F.lower("doi").alias("doi"), "work_id")
    first = rows.groupBy("doi").agg(F.min("work_id").alias("canonical_id"))
    return rows.join(first, "doi").where("work_id <> canonical_id").select(F.col("work_id").alias("alias_id"), "canonical_id").distinct()


@query
def ratio_alias_edges(spark, d):
    pairs = ratio.reference_pairs(base.citing(spark, d), _aliases(spark, d))
    return pairs.groupBy("target_id").agg(F.count("*").alias("n_citing"))


@wide_query
def ratio_companion(spark, d):
    score = lambda w: _policy_counts(spark, d, w).where("policy = 'AR'").select("citation_year", "journal_id", "c_raw", "d_raw", F.round(F.try_divide("c_raw", "d_raw"), 9).alias("score"))
    return ratio.with_companion(score(2), score(5), ["citation_year", "journal_id"], "score")


@wide_query
def reporting_population(spark, d):
    existing = base.journal_years(spark, d).select(F.col("score_year").alias("citation_year"), "journal_id").where(F.col("citation_year").isin(base.citation_years(spark, d)))
    eligible = _policy_counts(spark, d, 2).where("policy = 'AR' AND d_raw > 0").select("citation_year", "journal_id")
    return ratio.reporting_population(existing, eligible, ["citation_year", "journal_id"])


# --- fields ---------------------------------------------------------------------------------------------------


#: Fields are voted for by score year and effective key.
VOTES_BY = ["score_year", "issn_l"]


def _votes(spark, d):
    """(score_year, issn_l, field, votes) of citable works in the window before each score year, under effective keys."""
    years = base.score_years(spark, d)
    w = base.eligible_works(spark, d, years).where(F.col("work_type").isin(graph.CITED_TYPES))
    yearly = w.groupBy("source_id", "raw_issn_l", "field", "year").agg(F.count("*").alias("n"))
    keyed = identity.project_keys(yearly, "source_id", "raw_issn_l", *base.identity_tables(spark, d)).where("effective_key IS NOT NULL")
    served = F.filter(F.sequence(F.col("year") + 1, F.col("year") + graph.WINDOW), lambda y: y.isin(years))
    return keyed.select(F.explode(served).alias("score_year"), F.col("effective_key").alias("issn_l"), "field", "n").groupBy(*VOTES_BY, "field").agg(F.sum("n").alias("votes"))


@query
def field_modal(spark, d):
    return fields.modal_field(_votes(spark, d), VOTES_BY).withColumns({"modal_share": F.round("modal_share", 9), "coverage": F.round("coverage", 9)})


@query
def field_top3(spark, d):
    return fields.top_fields(_votes(spark, d), VOTES_BY)


@query
def field_shares(spark, d):
    return fields.field_shares(fields.top_fields(_votes(spark, d), VOTES_BY), VOTES_BY)


@query
def field_labels(spark, d):
    m = fields.modal_field(_votes(spark, d), VOTES_BY)
    return m.select(*VOTES_BY, fields.field_label(F.col("field"), F.round("modal_share", 6)).alias("label"))


# --- ranks and views ------------------------------------------------------------------------------------------

SELECTION = ranks.Selection(metric="ratio2", min_coverage=10, top_percent=75)
SEARCH = replace(SELECTION, query="journal of", sort_key="field_pct")
NETWORK = ranks.Selection(metric="per_article", min_coverage=10, min_years=1, top_percent=75)


def _ratio_columns(spark, d, window):
    """(score_year, journal_id, ratio<window>_raw, ratio<window>_filtered) under the main policy."""
    out = ratio.annual_ratio(_policy_counts(spark, d, window), "AR", window)
    return out.select(F.col("citation_year").alias("score_year"), "journal_id", F.col("score_raw").alias(f"ratio{window}_raw"), F.col("score_ref").alias(f"ratio{window}_filtered"))


def _ratio_years(spark, d, year=None):
    """Journal years with the ratio scores of both windows; one year only, where one is wanted."""
    jy = base.journal_years(spark, d)
    jy = jy if year is None else jy.where(F.col("score_year") == year)
    return jy.join(_ratio_columns(spark, d, 2), ranks.YEAR_AND_ID, "left").join(_ratio_columns(spark, d, 5), ranks.YEAR_AND_ID, "left")


def _network_years(spark, d):
    """Journal years with network scores."""
    wide = publish.wide_scores(_scores(spark, d)).withColumnRenamed("issn_l", "journal_id")
    return base.journal_years(spark, d).join(wide, ranks.YEAR_AND_ID, "left")


@wide_query
def journal_years(spark, d):
    return base.journal_years(spark, d).withColumn("coverage", F.round("coverage", 9))


@wide_query
def eligibility_reasons(spark, d):
    jy = _ratio_years(spark, d).withColumn("score", ranks.score_column(SELECTION)).withColumn("reason", F.coalesce(ranks.exclusion_reason(SELECTION), F.lit("eligible")))
    return jy.groupBy("score_year", "reason").agg(F.count("*").alias("n_journals"))


@query
def ecdf_percentiles(spark, d):
    rows = _ratio_columns(spark, d, 5).where("ratio5_raw IS NOT NULL")
    return ranks.ecdf(rows, ["score_year"], "ratio5_raw", "pct").select("score_year", "journal_id", F.round("pct", 9).alias("pct"), F.col("pct_of").alias("n"))


def _ranked(spark, d, year=None):
    return ranks.two_stage(_ratio_years(spark, d, year), SELECTION)


def _rank_columns(ranked):
    return ranked.select("score_year", "journal_id", "reason", F.round("field_pct", 9).alias("field_pct"), F.round("pool_pct", 9).alias("pool_pct"), "field_count")


@wide_query
def rank_two_stage(spark, d):
    return _rank_columns(_ranked(spark, d))


@wide_query
def rank_network(spark, d):
    return _rank_columns(ranks.two_stage(_network_years(spark, d), NETWORK))


@wide_query
def rank_three_year_mean(spark, d):
    out = ranks.three_year_mean(_ranked(spark, d))
    return out.withColumns({"field_mean": F.round("field_mean", 7), "pool_mean": F.round("pool_mean", 7)})


@wide_query
def rank_summary(spark, d):
    return ranks.rank_summary(_ranked(spark, d))


@wide_query
def view_page(spark, d):
    """The first page of the last score year."""
    year = max(base.score_years(spark, d), default=None)
    rows = views.visible(_ranked(spark, d, year), SELECTION)
    return views.sorted_page(rows, SELECTION).select("journal_id", "title", F.round("score", 9).alias("score"), F.round("field_pct", 9).alias("field_pct"))


@wide_query
def view_search(spark, d):
    return views.visible(_ranked(spark, d), SEARCH).select("score_year", "journal_id", "title", F.round("field_pct", 9).alias("field_pct"))


def _shown(spark, d, percentile):
    return views.visible(_ranked(spark, d), replace(SELECTION, percentile=percentile)).groupBy("score_year").agg(F.count("*").alias("n_journals"), F.min("journal_id").alias("first_id"), F.max("journal_id").alias("last_id"))


@wide_query
def view_total(spark, d):
    """What is shown where the total percentile is asked for."""
    return _shown(spark, d, "total")


@wide_query
def view_both(spark, d):
    """Where both percentiles are asked for, the total one decides as well."""
    return _shown(spark, d, "both")


@wide_query
def view_unranked(spark, d):
    """Without a percentile every member with a ratio score is shown."""
    return _shown(spark, d, "none")


@wide_query
def hidden_matches(spark, d):
    return views.hidden_matches(_ranked(spark, d), SEARCH)


@wide_query
def export_lines(spark, d):
    rows = views.visible(_ranked(spark, d), SELECTION)
    return views.export_lines(rows, ["journal_id", "title", "publisher", "field"], {"coverage": 1})


@wide_query
def filter_options(spark, d):
    return views.filter_options(base.journal_years(spark, d))


@wide_query
def journal_history(spark, d):
    """History of the journal with most recorded citations."""
    ranked = _ranked(spark, d)
    top = base.journal_years(spark, d).groupBy("journal_id").agg(F.sum("citations").alias("n")).orderBy(F.desc("n"), "journal_id").limit(1).select("journal_id")
    return ranked.join(top, "journal_id", "left_semi").select("score_year", "journal_id", "title", F.round("score", 9).alias("score"), F.round("field_pct", 9).alias("field_pct"), F.round("pool_pct", 9).alias("pool_pct"), "reason")


# --- publication ----------------------------------------------------------------------------------------------


@wide_query
def history_shards(spark, d):
    return base.journal_years(spark, d).groupBy(publish.shard_of("journal_id").alias("shard")).agg(F.count("*").alias("n_rows"), F.count_distinct("journal_id").alias("n_journals"))


@wide_query
def rank_sidecar(spark, d):
    out = publish.rank_sidecar(_ranked(spark, d), "oa")
    return out.withColumns({c: F.round(c, 9) for c in ("score", "field_pct", "pool_pct")})


def _deliveries(spark, d):
    """(first, last) delivered counts of every journal year."""
    rows = table(spark, d, "effective_counts").select("score_year", issn_text("issn_l").alias("journal_id"), "a_raw", "a_filtered", "loaded_at").where("journal_id IS NOT NULL AND score_year IS NOT NULL")
    first = versions.latest_version(rows, ranks.YEAR_AND_ID, [F.asc_nulls_last("loaded_at"), F.desc_nulls_last("a_raw"), F.desc_nulls_last("a_filtered")])
    last = versions.latest_version(rows, ranks.YEAR_AND_ID, [F.desc_nulls_last("loaded_at"), F.desc_nulls_last("a_raw"), F.desc_nulls_last("a_filtered")])
    return first.drop("loaded_at"), last.drop("loaded_at")


@query
def frozen_or_live(spark, d):
    """Years before the last are pinned to the counts as first delivered, the last one is live."""
    first, last = _deliveries(spark, d)
    out = publish.frozen_or_live({"first": first, "last": last}, {y: "first" for y in base.score_years(spark, d)[:-1]}, "last")
    return out.groupBy("score_year", "run", "state").agg(F.count("*").alias("n_rows"), F.sum("a_raw").alias("a_raw"))


@wide_query
def validate_annual(spark, d):
    return publish.violations(base.journal_years(spark, d), publish.annual_rules(), ["score_year", "journal_id"])


@query
def conservation(spark, d):
    e = base.edges(spark, d)
    parts = {"edges": e, "recorded and self": graph.recorded_citations(e).select("score_year", F.col("recorded_raw").alias("n_raw")).unionByName(e.where("citing = cited").select("score_year", "n_raw"))}
    return publish.conservation(parts, "n_raw", "score_year")


@query
def annual_differences(spark, d):
    """Delivered counts against those that the works give: journal years of one side only, and counts that differ."""
    delivered = base.counts(spark, d).withColumnRenamed("issn_l", "journal_id")
    return publish.differences(delivered, projected_counts(spark, d).withColumnRenamed("issn_l", "journal_id"), ["a_raw", "a_filtered"])


@wide_query
def handover_violations(spark, d):
    """Rules that a published annual table must keep, each with the number of rows that break it."""
    jy = base.journal_years(spark, d)
    solved = durable(_scores(spark, d))
    frame = publish.handover_frame(jy, solved, register.grouped_members(base.matched_register(spark, d)))
    return publish.handover_violations(frame, solved, base.universes(spark, d).where("universe = 'n'").select("score_year", F.col("issn_l").alias("journal_id")))


@wide_query
def public_ratio(spark, d):
    """The published shape of the two-year ratio: every journal with items or citations, under its ISSN-L or, without one, its source."""
    out = ratio.annual_ratio(_policy_counts(spark, d, 2), "AR", 2).withColumnRenamed("citation_year", "score_year")
    jy = base.journal_years(spark, d).select("score_year", "journal_id", "title", "publisher", "is_open_access", "in_n", "in_oa")
    top = fields.top_fields(_votes(spark, d), VOTES_BY).withColumnRenamed("issn_l", "journal_id")
    entries = register.grouped_members(base.matched_register(spark, d)).select("score_year", F.col("issn_l").alias("journal_id"), F.array_join(F.transform(F.split("journal_ids", r" \| "), lambda x: register.entry_url(x)), "; ").alias("register_urls"))
    joined = out.join(jy, ranks.YEAR_AND_ID, "left").join(top, ranks.YEAR_AND_ID, "left").join(entries, ranks.YEAR_AND_ID, "left")
    coverage = F.try_divide(100.0 * F.col("d_ref"), F.col("d_raw"))
    return joined.select(
        "score_year", "journal_id", F.when(F.col("journal_id").rlike("^[0-9]{4}-[0-9]{3}[0-9X]$"), F.col("journal_id")).alias("issn_l"), "title", "publisher", "is_open_access", F.coalesce("in_n", F.lit(False)).alias("in_n"), F.coalesce("in_oa", F.lit(False)).alias("in_oa"),
        "d_raw", "d_ref", "citations_raw", "citations_ref", F.round(coverage, 9).alias("coverage"), F.round(100 - coverage, 9).alias("without_references"), F.round("score_raw", 9).alias("ratio_raw"), F.round("score_ref", 9).alias("ratio_ref"), "status",
        "field_1", "field_2", "field_3", "works_1", "works_2", "works_3", "works_other", "register_urls",
    )


@wide_query
def decision_faults(spark, d):
    """Decision tables and identities that contradict themselves or each other, counted by rule."""
    overrides, excluded = _ledger(spark, d)
    src = base.newest_sources(spark, d)
    members = table(spark, d, "reviewed_representative").where(F.lower(blank_to_null("review_status")).startswith("approved")).select(issn_text("issn_l").alias("component"), F.explode("expected_component_source_ids").alias("m")).select("component", entity_id("m", "S").alias("source_id")).where("component IS NOT NULL AND source_id IS NOT NULL")
    t = base.targets(spark, d).where("journal_id IS NOT NULL AND publication_year IS NOT NULL")
    direct = t.where(F.col("work_type").isin(ratio.POLICIES["AR"])).select("journal_id", F.explode(F.filter(F.sequence(F.col("publication_year") + 1, F.col("publication_year") + 2), lambda y: y.isin(base.citation_years(spark, d)))).alias("citation_year")).groupBy("citation_year", "journal_id").agg(F.count("*").alias("direct"))
    items = _policy_counts(spark, d, 2).where("policy = 'AR' AND d_raw > 0").select("citation_year", "journal_id", "d_raw")
    rules = {
        "work both overridden and excluded": overrides.select("work_id").intersect(excluded.select("work_id")),
        "source in several components": identity.overlapping_components(members),
        "alias of several keys": identity.alias_conflicts(register.aliases_of_sources(src)),
        "alias that leads to an alias": ratio.flat_alias_violations(_aliases(spark, d)),
        "denominators differ": items.join(direct, ["citation_year", "journal_id"], "full_outer").where("NOT (d_raw <=> direct)"),
    }
    parts = [rows.agg(F.count("*").alias("n")).select(F.lit(rule).alias("rule"), "n") for rule, rows in rules.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)
