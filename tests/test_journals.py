"""Works, identity, register, scores, ratios, fields, ranks and views on small fixtures with known results."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillmesh.operators import fields, graph, identity, publish, ranks, ratio, register, scores, settings, versions, views

# --- versions and ledgers ---


def test_latest_version_and_ties(spark, rows):
    df = spark.createDataFrame([("w", 1, "a"), ("w", 2, "b"), ("w", 2, "b"), ("w", 2, "c"), ("v", None, "x"), ("v", 1, "y"), (None, 5, "n")], "id string, t int, x string")
    order = [F.desc_nulls_last("t"), F.asc("x")]
    assert rows(versions.latest_version(df, ["id"], order)) == sorted([("w", 2, "b"), ("v", 1, "y"), (None, 5, "n")], key=repr)
    assert rows(versions.latest_with_ties(df, ["id"], [F.desc_nulls_last("t")])) == sorted([("w", 2, "b"), ("w", 2, "c"), ("v", 1, "y"), (None, 5, "n")], key=repr)


def test_patch_exclude_and_audit(spark, rows):
    works = spark.createDataFrame([("w1", "S1", "k"), ("w2", "S1", None), ("w3", "S2", "k")], "work_id string, source_id string, key string")
    ledger = spark.createDataFrame([("w1", "S1", "S9", "k"), ("w2", "S1", "S8", "k"), ("w7", "S1", "S9", None)], "work_id string, expected string, target string, expected_key string")
    out = versions.patched(works, "work_id", ledger, {"source_id": "target"}, works.where("work_id = 'w3'"))
    assert rows(out, "work_id", "source_id", "patched") == [("w1", "S9", True), ("w2", "S8", True)]
    assert rows(versions.preimage_audit(works, "work_id", ledger, {"source_id": "expected", "key": "expected_key"})) == [(3, 1, 1)]


# --- graph ---


def test_citation_edges_count_distinct_references_within_the_window(spark, rows):
    works = spark.createDataFrame(
        [("a", 2022, "SA", "A", ["b", "b", "c", "a", "old", "future", "gone", None], True), ("b", 2021, "SB", "B", [], False), ("c", 2017, "SC", "C", ["x"], True), ("old", 2016, "SC", "C", [], True), ("future", 2023, "SC", "C", None, True)],
        "work_id string, year int, source_id string, raw_issn_l string, refs array<string>, has_refs boolean",
    )
    assert rows(graph.citation_edges(works, works)) == [(2022, "SA", "A", "SB", "B", 1, 0), (2022, "SA", "A", "SC", "C", 1, 1)]


def test_window_counts_and_active_years(spark, rows):
    yearly = spark.createDataFrame([("S", "K", 2017, 3, 1), ("S", "K", 2021, 2, 2), ("S", "K", 2022, 7, 0)], "source_id string, raw_issn_l string, year int, a_raw long, a_filtered long")
    assert rows(graph.window_counts(yearly, [2022, 2023])) == [(2022, "S", "K", 5, 3), (2023, "S", "K", 9, 2)]
    got = {r.score_year: r.active_years for r in graph.active_years(yearly.unionByName(yearly.replace("S", "T")), [2022, 2023, 2026, 2028]).collect()}
    assert got == {2022: 2, 2023: 2, 2026: 2}


def test_a_work_whose_newest_record_is_paratext_keeps_the_one_before(spark, tmp_path):
    place = "struct<source: struct<id: string, issn_l: string, type: string, display_name: string>, raw_source_name: string, landing_page_url: string, provenance: string>"
    schema = f"record_id long, id string, primary_location {place}, publication_year int, type string, referenced_works_count int, referenced_works array<string>, updated_date string, is_paratext boolean, is_retracted boolean, primary_topic struct<field: struct<display_name: string>, domain: struct<display_name: string>>, doi string, title string"
    at = lambda k: (("S1", k, "journal", "x"), None, None, None)
    data = [
        (1, "W1", at("0378-5955"), 2021, "article", 1, ["W2"], "2024-01-01", None, False, None, None, None), (2, "W1", at("0378-5955"), 2021, "article", 1, ["W2"], "2024-02-01", True, False, None, None, None),
        (3, "W2", at("0378-5955"), 2021, "article", 0, None, "2024-01-01", False, False, None, None, None), (4, "W2", at(" "), 2021, "article", 0, None, "2024-03-01", False, False, None, None, None), (5, "W3", at("0378-5955"), 1990, "article", 0, None, "2024-01-01", False, False, None, None, None),
    ]
    spark.createDataFrame(data, schema).withColumn("updated_date", F.to_timestamp("updated_date")).write.parquet(f"{tmp_path}/fixture.parquet")
    from quillmesh.plans import base

    chosen = base.eligible_works(spark, str(tmp_path), [2022, 2023])
    assert sorted(r.record_id for r in chosen.collect()) == [1, 3]
    assert sorted(r.record_id for r in base.works(spark, str(tmp_path)).collect()) == [2, 4, 5]
    plan = chosen._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(publication_year" in plan.split("PushedFilters")[1]


def test_used_citations(spark, rows):
    edges = spark.createDataFrame([(1, "B", "A", 3, 2), (1, "C", "A", 4, 1), (1, "A", "B", 2, 0), (1, "A", "A", 50, 50)], "score_year int, citing string, cited string, n_raw long, n_filtered long")
    counts = spark.createDataFrame([(1, "A", 1, 1)], "score_year int, issn_l string, a_raw long, a_filtered long")
    members = spark.createDataFrame([(1, "n", "A"), (1, "n", "B"), (1, "oa", "A"), (1, "oa", "B"), (1, "oa", "C"), (1, "oa", "quiet")], "score_year int, universe string, issn_l string")
    states = graph.universe_states(counts, edges, members)
    assert (1, "oa", "quiet") not in rows(states)
    got = {(r.universe, r.issn_l): (r.used_raw, r.used_filtered) for r in graph.used_citations(edges, states).collect()}
    assert got == {("n", "A"): (3, 2), ("n", "B"): (2, 0), ("oa", "A"): (7, 3), ("oa", "B"): (2, 0), ("oa", "C"): (0, 0)}
    assert rows(graph.recorded_citations(edges)) == [(1, "A", 7, 3, 2), (1, "B", 2, 0, 1)]


def test_role_masses_conserve(spark):
    edges = spark.createDataFrame([(1, "B", "A", 3, 2), (1, "A", "A", 5, 5)], "score_year int, citing string, cited string, n_raw long, n_filtered long")
    counts = spark.createDataFrame([(1, "A", 4, None)], "score_year int, issn_l string, a_raw long, a_filtered long")
    out = graph.role_masses(counts, edges).agg(F.sum("a_raw"), F.sum("citing_n_raw"), F.sum("cited_n_raw"), F.sum("a_filtered")).first()
    assert tuple(out) == (4, 8, 8, 0)


# --- identity ---


def test_cascade_and_quarantine(spark, rows):
    src = spark.createDataFrame([("S1", None, 5), ("S2", "1234-5679", 1), ("S3", "1111-1119", 1), ("S4", "bad", 2), ("S5", "2049-3630", 3), ("S6", None, 4)], "source_id string, key string, mass long")
    overrides = spark.createDataFrame([("S1", None, "1111-1119"), ("S5", "other", "1234-5679")], "source_id string, expected_key string, target string")
    aliases = spark.createDataFrame([("1234-5679", "1111-1119")], "alias string, target string")
    corrections = spark.createDataFrame([("1111-1119", "0378-5955")], "key string, target string")
    out = identity.project_keys(src, "source_id", "key", overrides, aliases, corrections)
    assert rows(out, "source_id", "effective_key", "projected_by") == sorted([("S1", "0378-5955", "override"), ("S2", "0378-5955", "correction"), ("S3", "0378-5955", "correction"), ("S4", None, "quarantine"), ("S5", "2049-3630", "raw"), ("S6", None, "quarantine")], key=repr)
    assert rows(identity.quarantine(out, "key", ["mass"])) == [("invalid_syntax", 1, 2), ("kept", 4, 10), ("missing", 1, 4)]


def test_null_safe_mapping_keeps_nulls(spark, rows):
    e = spark.createDataFrame([("S1", None, 1), (None, None, 2), ("S1", "k", 3)], "s string, k string, n int")
    m = spark.createDataFrame([("S1", None, "x"), (None, None, "y"), ("S1", "k", "z")], "source_id string, raw_key string, effective_key string")
    assert rows(identity.null_safe_mapping(e, m, {"to": ("s", "k")}), "n", "to") == [(1, "x"), (2, "y"), (3, "z")]


@pytest.mark.parametrize(
    "members,value,how",
    [
        ([(True, "A"), (False, "B")], "A", "canonical_arm"), ([(True, None), (False, "B"), (False, "B")], "B", "unanimous_component_fallback"), ([(True, None), (False, "B"), (False, "C")], "Multiple OA fields", "component_conflict"),
        ([(True, "A"), (True, "B")], "Multiple OA fields", "canonical_arm_conflict"), ([(True, None)], "Unknown", "missing"),
    ],
)
def test_consensus(spark, members, value, how):
    df = spark.createDataFrame([(i, "K" if c else "other", "K", v) for i, (c, v) in enumerate(members)], "source_id string, raw_key string, effective_key string, oa_field string")
    r = identity.effective_sources(df, ["oa_field"]).first()
    assert (r.oa_field, r.oa_field_by) == (value, how)


def test_suppressed_arms_keep_their_rows(spark, rows):
    src = spark.createDataFrame([("S1",), ("S2",), ("S3",)], "source_id string")
    d = spark.createDataFrame([("S1", "S2"), ("S2", "S2")], "source_id string, chosen string")
    assert rows(identity.suppress_arms(src, d)) == [("S1", False), ("S2", True), ("S3", True)]


# --- register ---


def register_table(spark, data):
    return spark.createDataFrame(data, "score_year int, journal_id string, norwegian_level int, print_issn string, online_issn string, ceased_year int")


def test_roster_levels_and_ceasing(spark, rows):
    data = [(y, "7", level, None, None, 2024) for y, level in zip(range(2022, 2027), [0, 2, 1, 1, 1], strict=True)] + [(2023, "8", 1, " 20493630 ", "bad", None), (2023, "8", 2, None, "2049-3630", None), (2023, None, 1, None, None, None)]
    out = register.roster(register_table(spark, data))
    assert rows(out) == sorted([(2023, "7", 2, []), (2024, "7", 1, []), (2023, "8", 2, ["20493630"])], key=repr)


def test_matching_by_issn(spark, rows):
    members = register.roster(register_table(spark, [(1, "a", 1, None, " 20493630 ", None), (1, "b", 1, "2049-3630", "0378-5955", None), (1, "c", 1, None, None, None), (1, "d", 1, "1234-5679", None, None)]))
    aliases = spark.createDataFrame([("20493630", "K1"), ("20493630", "K1"), ("03785955", "K2")], "issn string, effective_key string")
    out = register.match_by_issn(members, aliases)
    assert rows(out, "journal_id", "n_targets", "issn_l", "candidates", "outcome") == [("a", 1, "K1", "K1", "exact_issn"), ("b", 2, None, "K1|K2", "ambiguous_exact_issn_match"), ("c", 0, None, "", "missing_register_issns"), ("d", 0, None, "", "no_exact_issn_match")]
    more = out.withColumn("journal_id", F.when(F.col("journal_id") == "a", "10").otherwise("9")).where("outcome = 'exact_issn'").unionByName(out.where("journal_id = 'a'").withColumn("journal_id", F.lit("9")))
    assert rows(register.grouped_members(more)) == [(1, "K1", "9 | 10", 2, 1)]


def test_primary_title_of_every_year_by_either_title(spark, rows, tmp_path):
    from quillmesh import plans

    register_rows = [
        (2023, "1", 1, "0378-5955", None, "Tidsskrift X", "Journal X", None),
        (2023, "2", 1, None, "03785955", "Other", "Another", None),
        (2024, "1", 1, "0378-5955", None, None, "Journal X", None),
        (2024, "2", 1, "0378-5955", None, "tidsskrift x", "JOURNAL-X", None),
        (2025, "2", 1, "0378-5955", None, "TIDSSKRIFT (X)", None, None),
        (2025, "3", 1, "2049-3630", None, "Tidsskrift X", "", None),
    ]
    spark.createDataFrame(register_rows, "score_year int, journal_id string, norwegian_level int, print_issn string, online_issn string, original_title string, international_title string, ceased_year int").write.parquet(f"{tmp_path}/norwegian_membership.parquet")
    sources = spark.read.parquet("/root/testdata/sf0.001/source_rows.parquet").limit(1)
    for name, value in {"source_id": "S1", "raw_issn_l": "0378-5955", "title": "Tidsskrift X", "snapshot_date": "2025-10-15"}.items():
        sources = sources.withColumn(name, F.lit(value))
    sources.withColumn("issns", F.array(F.lit("0378-5955"))).write.parquet(f"{tmp_path}/source_rows.parquet")
    assert rows(plans.QUERIES["register_primary_titles"](spark, str(tmp_path)), "score_year", "issn_l", "journal_id", "n_journals") == [(2023, "0378-5955", "1", 2), (2024, "0378-5955", "2", 2), (2025, "0378-5955", "2", 1)]


def test_urls_levels_titles_and_unpivot(spark, rows):
    df = spark.createDataFrame([("https://register.example/entry?id=7; http://register.example/entry?x=1&id=8;https://evil.example/entry?id=9;https://register.example/entry?id=x; https://register.example/entry?id=7", "1 | 2 | 1"), (None, "3")], "u string, l string")
    assert [(r[0], r[1]) for r in df.select(register.ids_of_urls(F.col("u")), register.level_text(F.col("l"))).collect()] == [(["7", "8"], "1, 2"), ([], None)]
    c = spark.createDataFrame([("K", "1", "Acta X."), ("K", "2", "acta-x"), ("L", "3", "Other"), ("M", "4", " ")], "issn_l string, journal_id string, title string")
    w = spark.createDataFrame([("K", "ACTA X"), ("L", "other!"), ("M", "")], "issn_l string, title string")
    assert rows(register.primary_by_title(c, w)) == [("L", "3")]
    wide = spark.createDataFrame([("1", "0", "2", None), ("2", "x", "1", "1")], "`journal_id` string, `Level 2023` string, `Level 2024` string, `Level 2025` string")
    assert rows(register.unpivot_levels(wide, ["journal_id"])) == [("1", 2023, 0), ("1", 2024, 2), ("2", 2024, 1), ("2", 2025, 1)]


# --- scores ---


def cells(spark, counts, edges, members):
    c = spark.createDataFrame(counts, "score_year int, issn_l string, a_raw long, a_filtered long")
    e = spark.createDataFrame(edges, "score_year int, citing string, cited string, n_raw long, n_filtered long")
    states = graph.universe_states(c, e, spark.createDataFrame(members, "score_year int, universe string, issn_l string"))
    return scores.cells(states, graph.state_edges(e, states), c)


def network(spark):
    counts = [(1, "A", 10, 8), (1, "B", 5, 5), (1, "C", 3, 0), (2, "A", 1, 1), (2, "B", 2, 2)]
    edges = [(1, "A", "B", 4, 4), (1, "B", "A", 2, 1), (1, "C", "C", 9, 9), (1, "B", "B", 7, 7), (2, "A", "B", 3, 3)]
    return cells(spark, counts, edges, [(y, "oa", k) for y in (1, 2) for k in "ABC"])


def test_zero_is_not_null(spark):
    got = {(r.score_year, r.treatment, r.issn_l): r for r in scores.network_scores(*network(spark)).collect()}
    assert got[1, "raw", "C"].share == 0 and got[1, "raw", "C"].per_article == 0
    assert got[1, "filtered", "C"].share == 0 and got[1, "filtered", "C"].per_article is None
    for cell in {k[:2] for k in got}:
        own = [r for k, r in got.items() if k[:2] == cell]
        assert math.isclose(sum(r.share for r in own), 100, abs_tol=1e-8)
        assert math.isclose(sum(r.article_share * (r.per_article or 0) for r in own), 1, abs_tol=1e-9)
    assert (2, "raw", "C") not in got


def test_both_solvers_agree(spark):
    # without cycles the vector settles in a few steps
    nodes, edges = cells(spark, [(1, "A", 10, 8), (1, "B", 5, 5), (1, "C", 3, 0), (2, "A", 1, 1), (2, "B", 2, 2)], [(1, "A", "B", 4, 4), (1, "A", "C", 2, 1), (1, "B", "C", 9, 9), (2, "A", "B", 3, 3)], [(y, "oa", k) for y in (1, 2) for k in "ABC"])
    a = {tuple(r[:4]): r for r in scores.solve_in_workers(nodes, edges).collect()}
    b = {tuple(r[:4]): r for r in scores.solve_in_frames(nodes, edges, tolerance=1e-9).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert math.isclose(a[k].share, b[k].share, abs_tol=1e-5) and a[k].defined == b[k].defined and math.isclose(a[k].normalised, b[k].normalised, abs_tol=1e-6)
        assert (a[k].per_article is None) == (b[k].per_article is None) and math.isclose(a[k].per_article or 0, b[k].per_article or 0, abs_tol=1e-6)


def test_fail_closed(spark):
    ok = np.array([1.0, 2.0])
    share, a, steps, residual = scores.solve_arrays(2, np.array([0, 1]), np.array([1, 0]), ok, ok)
    assert steps > 1 and residual <= 1e-12 and math.isclose(share.sum(), 100)
    with pytest.raises(ValueError, match="article mass"):
        scores.solve_arrays(2, np.array([0]), np.array([1]), np.array([1.0]), np.zeros(2))
    with pytest.raises(ValueError, match="flows"):
        scores.solve_arrays(2, np.array([], int), np.array([], int), np.array([]), ok)
    nodes, edges = cells(spark, [(1, "A", 0, 0)], [(1, "A", "B", 4, 4)], [(1, "oa", k) for k in "AB"])
    with pytest.raises(ValueError, match="article mass"):
        scores.solve_in_frames(nodes, edges)


def test_input_faults(spark):
    c = spark.createDataFrame([(1, "A", 1, 2), (1, "A", 1, 1), (1, None, 1, 1)], "score_year int, issn_l string, a_raw long, a_filtered long")
    e = spark.createDataFrame([(1, "A", "B", -1, 0), (1, "A", "B", 1, 0), (1, None, "B", 1, 2)], "score_year int, citing string, cited string, n_raw long, n_filtered long")
    states = spark.createDataFrame([(1, "n", "A")], "score_year int, universe string, issn_l string")
    found = {r.rule: r.n for r in scores.input_faults(c, e, states).collect()}
    assert found == {"count without key": 1, "negative article count": 0, "filtered articles above raw": 1, "edge without key": 1, "negative citation count": 1, "filtered citations above raw": 2, "repeated count": 1, "repeated edge": 1, "empty state": 1}
    with pytest.raises(ValueError, match="empty state"):
        publish.require_none(scores.input_faults(c, e, states))


def test_isolated_node_without_articles_changes_nothing(spark):
    base = {r.issn_l: r.share for r in scores.network_scores(*cells(spark, [(1, "A", 2, 2), (1, "B", 1, 1)], [(1, "A", "B", 2, 2), (1, "B", "A", 1, 1)], [(1, "oa", k) for k in "AB"])).where("treatment = 'raw'").collect()}
    more = {r.issn_l: r.share for r in scores.network_scores(*cells(spark, [(1, "A", 2, 2), (1, "B", 1, 1)], [(1, "A", "B", 2, 2), (1, "B", "A", 1, 1), (1, "Z", "Z", 3, 3)], [(1, "oa", k) for k in "ABZ"])).where("treatment = 'raw'").collect()}
    assert all(math.isclose(base[k], more[k], abs_tol=1e-9) for k in base) and more["Z"] == 0


# --- ratios ---

TARGETS = [("T1", "J", 2023, "article", True, False), ("T2", "J", 2022, "review", False, False), ("T3", "J", 2022, "article", True, False), ("T4", "J", 2023, "article", False, False), ("T5", "J", 2023, "article", False, False), ("T6", "J", 2023, "editorial", False, False), ("T7", "J", 2022, "letter", True, False)]


def ratio_counts(spark, targets, window=2, aliases=None, refs=None):
    t = spark.createDataFrame(targets, "work_id string, journal_id string, publication_year int, work_type string, has_refs boolean, is_retracted boolean")
    c = spark.createDataFrame([("C1", "J", 2024, refs or ["T1", "T1", "T2", "T3", "T4", "T5", "T6", "T7", None], False, True, "N-journal"), ("C2", "Q", 2024, ["T1"], False, False, "other")], "work_id string, journal_id string, publication_year int, refs array<string>, is_retracted boolean, in_n boolean, source_component string")
    a = None if aliases is None else spark.createDataFrame(aliases, "alias_id string, canonical_id string")
    items = ratio.item_components(ratio.canonical_works(t, a), [2024], window)
    cites = ratio.citation_components(t, c, window, a)
    return {r.policy: r for r in ratio.policy_counts(items, cites).collect()}, ratio.policy_counts(items, cites)


def test_ratio_types_and_self_citations(spark):
    r = ratio_counts(spark, TARGETS)[0]["AR"]
    assert (r.d_raw, r.d_ref, r.c_raw, r.c_ref, r.c_not_citable, r.c_self) == (5, 2, 7, 4, 2, 7)


def test_ratio_retraction_touches_numerators_only(spark):
    r = ratio_counts(spark, [(*t[:5], t[0] == "T2") for t in TARGETS])[0]["AR"]
    assert (r.d_raw, r.d_ref, r.c_raw_without_retracted, r.c_ref_without_retracted, r.d_retracted) == (5, 2, 6, 4, 1)


def test_ratio_windows(spark):
    more = [*TARGETS, ("T8", "J", 2019, "article", True, False), ("T9", "J", 2021, "article", False, False), ("T10", "J", 2018, "article", True, False)]
    refs = ["T1", "T8", "T9", "T10"]
    two, five = ratio_counts(spark, more, 2, refs=refs)[0]["AR"], ratio_counts(spark, more, 5, refs=refs)[0]["AR"]
    assert (two.d_raw, two.c_raw) == (5, 1) and (five.d_raw, five.d_ref, five.c_raw, five.c_ref) == (7, 3, 3, 2)


def test_ratio_aliases_collapse_references(spark, rows):
    r = ratio_counts(spark, [*TARGETS, ("T1b", "J", 2023, "article", True, False)], aliases=[("T1b", "T1")], refs=["T1", "T1b"])[0]["AR"]
    assert (r.d_raw, r.c_raw) == (5, 1)
    a = spark.createDataFrame([("x", "y"), ("y", "z")], "alias_id string, canonical_id string")
    assert rows(ratio.flat_alias_violations(a)) == [("x", "y")]


def test_ratio_grid_status(spark):
    counts = spark.createDataFrame([("P", 2024, "a", 0, 0, 5, 5, 5, 5), ("P", 2024, "b", 2, 0, 3, 3, 3, 3), ("P", 2024, "c", 2, 1, 0, 0, 0, 0), ("P", 2024, "d", 100, 92, 300, 290, 300, 290)], "policy string, citation_year int, journal_id string, d_raw long, d_ref long, c_raw long, c_ref long, c_raw_without_retracted long, c_ref_without_retracted long")
    grid = {(r.journal_id, r.numerator, r.denominator): (r.score, r.status) for r in ratio.score_grid(counts).where("retraction = 'all'").collect()}
    assert grid["a", "ref", "ref"] == (None, "no_raw_citable_items") and grid["b", "ref", "ref"] == (None, "ref_denominator_collapse") and grid["c", "raw", "ref"] == (0.0, "defined")
    assert [round(grid["d", n, d][0], 2) for n, d in (("raw", "raw"), ("ref", "raw"), ("raw", "ref"), ("ref", "ref"))] == [3.0, 2.9, 3.26, 3.15]


def test_companion_and_population(spark, rows):
    a = spark.createDataFrame([(1, "x", 5, 1.0), (1, "y", 6, None)], "y int, j string, n int, score double")
    b = spark.createDataFrame([(1, "y", 9, 2.0), (1, "z", 9, 3.0)], "y int, j string, n int, score double")
    assert rows(ratio.with_companion(a, b, ["y", "j"], "score")) == sorted([(1, "x", 5, 1.0, None, "main_only"), (1, "y", 6, None, 2.0, "both"), (1, "z", None, None, 3.0, "companion_only")], key=repr)
    assert rows(ratio.reporting_population(a, b, ["y", "j"])) == [(1, "x", "existing"), (1, "y", "existing"), (1, "z", "added")]


# --- fields ---


def test_modal_field(spark):
    votes = spark.createDataFrame([("a", "Zoology", 2), ("a", "Economics", 2), ("a", "Unknown", 9), ("b", "Unknown", 4)], "k string, field string, votes long")
    got = {r.k: r for r in fields.modal_field(votes, ["k"]).collect()}
    assert (got["a"].field, got["a"].tied_modes, got["a"].modal_share, got["a"].all_works) == ("Economics", 2, 0.5, 13)
    assert (got["b"].field, got["b"].modal_works, got["b"].modal_share, got["b"].coverage) == ("Unknown", 0, None, 0.0)


def test_shares_always_add_up(spark):
    data = [(f"{a},{b},{c},{o}", a, b, c, o) for a, b, c, o in itertools.product(range(9, 0, -1), range(5), range(4), range(3)) if a >= b >= c and (c or not o)]
    df = spark.createDataFrame(data, "k string, works_1 long, works_2 long, works_3 long, works_other long").withColumn("classified_works", F.expr("works_1 + works_2 + works_3 + works_other"))
    out = fields.field_shares(df, ["k"])
    assert out.where("abs(percent_1 + percent_2 + percent_3 + percent_other - 100) > 1e-9").count() == 0
    r = out.where("k = '1,1,1,0'").first()
    assert (r.percent_1, r.percent_2, r.percent_3, r.percent_other) == (33.4, 33.3, 33.3, 0.0)
    assert df.select(fields.largest_remainder([F.lit(1), F.lit(2)], F.lit(4)).alias("x")).first().x is None


def test_field_label(spark):
    df = spark.createDataFrame([("Law", 0.5), ("Law", None), ("Unknown", 0.2), ("", 0.1), (None, None)], "f string, s double")
    assert [r[0] for r in df.select(fields.field_label(F.col("f"), F.col("s"))).collect()] == ["Law (50.0%)", "Law", "Unknown", "Unclassified (10.0%)", "Unclassified"]


# --- ranks and views ---

JY = "score_year int, journal_id string, title string, field string, per_article_n_filtered double, in_n boolean, coverage double, active_years int, is_open_access boolean, issns string, publisher string, domain string, in_oa boolean, register_area string, register_field string, ratio5_raw double"


def annual(spark, data):
    return spark.createDataFrame([(*r, *([None] * (16 - len(r)))) for r in data], JY)


def test_ecdf_ties_take_the_highest_rank(spark):
    df = spark.createDataFrame([("g", v, i) for i, v in enumerate([0.0, 1.0, 1.0, 3.0])], "g string, v double, i int")
    assert sorted((r.i, r.pct) for r in ranks.ecdf(df, ["g"], "v", "pct").collect()) == [(0, 25.0), (1, 75.0), (2, 75.0), (3, 100.0)]


def rank_data(spark):
    return annual(spark, [
        (2024, "a", "Alpha", "X", 1.0, True, 50.0, 5), (2024, "b", "Beta", "X", 2.0, True, 50.0, 5), (2024, "c", "=gamma \"q\"", "X", 3.0, True, 50.0, 5), (2024, "d", "Delta", "Y", 2.5, True, 50.0, 5), (2024, "e", None, None, 2.5, True, 50.0, 5),
        (2024, "out", "Out", "X", 9.0, None, 50.0, 5), (2024, "low", "Low", "X", 9.0, True, 10.0, 5), (2024, "young", "Young", "X", 9.0, True, 50.0, 1), (2024, "none", "None", "X", None, True, 50.0, 5), (2024, "nocov", "Nocov", "X", 9.0, True, None, 5),
        (2023, "a", "Alpha", "X", 1.0, True, 50.0, 5),
    ])


def test_ranges_give_the_same_ranks(spark):
    df = spark.createDataFrame([(i % 2, float((i * 7919) % 997), i) for i in range(1500)] + [(None, 1.0, 9000)], "g int, v double, i int")
    plain = {r.i: (r.pct, r.pct_of) for r in ranks.ecdf(df, ["g"], "v", "pct").collect()}
    assert plain == {r.i: (r.pct, r.pct_of) for r in ranks.ecdf(df, ["g"], "v", "pct", range_values=10).collect()} and len(plain) == 1501


def test_ratio_views(spark, rows):
    """A total percentile decides under ``both``; any ratio score keeps a row in view; rows without one are not even hidden."""
    df = annual(spark, [(2024, "a", "Alpha", "X", None, True, 50.0, 5), (2024, "b", "Alpha b", "X", None, True, 50.0, 5), (2024, "c", "Alpha c", "X", None, False, 50.0, 5), (2024, "d", "Delta", "X", None, True, 50.0, 5, None, None, None, None, None, "alpha area")])
    df = df.withColumn("ratio2_filtered", F.expr("CASE journal_id WHEN 'a' THEN 1.0 WHEN 'd' THEN 2.0 END")).withColumn("ratio5_raw", F.expr("CASE WHEN journal_id IN ('b', 'c') THEN 3.0 END"))
    s = ranks.Selection(metric="ratio2", top_percent=50, percentile="both", query="alpha")
    ranked = ranks.two_stage(df, s)
    assert [r.journal_id for r in views.visible(ranked, s).collect()] == ["d"]
    assert rows(views.hidden_matches(ranked, s), "journal_id", "reasons") == [("a", "percentiles"), ("b", "percentiles"), ("c", "universe")]
    assert sorted(r.journal_id for r in views.visible(ranked, ranks.Selection(metric="ratio2", pool_only=False)).collect()) == ["a", "b", "d"]


def test_two_stage_ranking(spark):
    s = ranks.Selection(top_percent=70)
    got = {(r.score_year, r.journal_id): r for r in ranks.two_stage(rank_data(spark), s).collect()}
    now = {k[1]: r for k, r in got.items() if k[0] == 2024}
    assert [now[k].reason for k in ("out", "low", "young", "none", "nocov")] == ["not in universe", "coverage too low", "history too short", "no score", "coverage unavailable"]
    assert math.isclose(now["a"].field_pct, 100 / 3) and now["d"].field_pct == 100 and now["e"].field_group == "Unclassified"
    strict = {r.journal_id: r for r in ranks.two_stage(rank_data(spark), ranks.Selection(top_percent=50)).where("score_year = 2024").collect()}
    assert strict["a"].pool_pct is None and strict["a"].reason == "outside the top share of its field" and strict["c"].pool_pct == 100 and strict["d"].pool_pct == 75
    summary = {r.score_year: tuple(r)[1:] for r in ranks.rank_summary(ranks.two_stage(rank_data(spark), ranks.Selection(top_percent=50))).collect()}
    assert summary[2024] == (5, 4, 3, 10)


def test_three_year_mean_needs_the_current_year(spark):
    data = [("A", 2024, 90.0, 80.0), ("A", 2023, 80.0, None), ("A", 2022, 85.0, 60.0), ("B", 2024, 80.0, None), ("B", 2023, None, None), ("Z", 2023, 50.0, 50.0), ("A", 2021, 0.0, 0.0)]
    df = spark.createDataFrame(data, "journal_id string, score_year int, field_pct double, pool_pct double")
    got = {(r.journal_id, r.score_year): r for r in ranks.three_year_mean(df).collect()}
    assert (got["A", 2024].field_mean, got["A", 2024].pool_mean, got["A", 2024].n_years) == (85.0, 70.0, 3)
    assert got["B", 2024].pool_mean is None and ("Z", 2024) not in got


def test_presets_and_years(spark):
    table = spark.createDataFrame([("plain", None, None, None, None, None), ("averaged", None, 20.0, 75.0, "total", True), ("ratio", "ratio2", None, None, None, None)], "name string, metric string, min_coverage double, top_percent double, percentile string, average boolean")
    presets = ranks.presets_of(table)
    assert ranks.preset_of(ranks.Selection(query="x", page=3), presets) == "plain" and ranks.preset_of(ranks.Selection(min_years=1), presets) is None
    assert ranks.preset_of(ranks.Selection(min_coverage=20, top_percent=75, percentile="total", average=False), presets, can_average=False) == "averaged"
    assert ranks.preset_of(ranks.Selection(metric="ratio2"), presets) == "ratio"
    assert ranks.starting_year([2023, 2024, 2025], 2025) == 2024 and ranks.starting_year([2025], 2025) == 2025 and ranks.starting_year([2023, 2024], 2025, 2023) == 2023
    assert ranks.can_average({2022, 2023, 2024}, 2024) and not ranks.can_average({2023, 2024}, 2024)
    with pytest.raises(ValueError):
        ranks.starting_year([], 2025)


def test_display_filters_leave_ranks_alone_and_hidden_matches_explain(spark, rows):
    s = ranks.Selection(top_percent=50, query="ALPHA", fields=("Y",), open_only=True)
    ranked = ranks.two_stage(rank_data(spark), s)
    assert views.visible(ranked, s).count() == 0
    assert rows(views.hidden_matches(ranked.where("score_year = 2024"), s), "journal_id", "reasons") == [("a", "fields,access")]
    assert views.hidden_matches(ranked, ranks.Selection(query=" ")).count() == 0
    plain = ranks.Selection(pool_only=False, sort_key="score", descending=True)
    page = [r.journal_id for r in views.sorted_page(views.visible(ranked.where("score_year = 2024"), plain), plain).collect()]
    assert page[-1] == "none" and page[:3] == ["low", "nocov", "young"]


def test_export_guard_and_history(spark, rows):
    ranked = ranks.two_stage(rank_data(spark), ranks.Selection(top_percent=50))
    lines = {r.journal_id: r.line for r in views.export_lines(ranked.where("score_year = 2024"), ["title", "field"], {"coverage": 1}).collect()}
    assert lines["c"] == '"\'=gamma ""q""","X",50.0' and lines["e"] == ",,50.0" and lines["nocov"].endswith(",")
    assert [r.score_year for r in views.history(ranked, F.lit("a")).orderBy("score_year").collect()] == [2023, 2024]
    assert rows(views.filter_options(ranked)) == [(2023, "X", 1), (2024, "X", 8), (2024, "Y", 1)]


# --- publication ---


def test_violations_and_differences(spark, rows):
    jy = spark.createDataFrame([(1, "a", 5, 6, 1, 1, 50.0), (1, "a", None, None, 0, 0, None), (1, "b", 0, 0, 0, 0, 120.0), (None, "c", 1, 1, 1, 2, None)], "score_year int, journal_id string, works_raw int, works_filtered int, citations int, citations_filtered int, coverage double")
    found = {r.rule: r.n for r in publish.violations(jy, publish.annual_rules(), ["score_year", "journal_id"]).collect()}
    assert found == {"year or id missing": 1, "filtered above raw": 1, "citations filtered above raw": 1, "not a count": 1, "coverage out of range": 1, "coverage without works": 1, "coverage missing though works": 1, "repeated key": 1}
    with pytest.raises(ValueError, match="repeated key"):
        publish.require_none(publish.violations(jy, publish.annual_rules(), ["score_year", "journal_id"]))
    a = spark.createDataFrame([(1, "a", 1, 1.0), (1, "b", None, 2.0), (1, "c", 3, 3.0)], "score_year int, journal_id string, n int, x double")
    b = spark.createDataFrame([(1, "a", 1, 1.0 + 1e-15), (1, "b", 0, 2.1), (1, "d", 3, 3.0)], "score_year int, journal_id string, n int, x double")
    assert rows(publish.differences(a, b, ["n", "x"])) == [(1, "b", "n,x"), (1, "c", "only left"), (1, "d", "only right")]


def handover_row(**changes):
    row = {"score_year": 2024, "journal_id": "K", "window_start": 2019, "window_end": 2023, "works_raw": 10, "works_filtered": 5, "citations": 3, "citations_filtered": 2, "active_years": 4, "coverage": 50.0, "register_ids": "12 | 7", "register_level": 1}
    return row | {f"{m}_{u}_{t}": 1.0 for m in ("share", "per_article") for u in ("n", "oa") for t in ("raw", "filtered")} | changes


def test_handover_rules(spark):
    kinds = {k: "int" if isinstance(v, int) else "double" if isinstance(v, float) else "string" for k, v in handover_row().items()}
    schema = ", ".join(f"{k} {v}" for k, v in kinds.items())
    score = lambda universe, treatment, share: (2024, universe, treatment, "K", share)
    full = spark.createDataFrame([score(u, t, 100.0) for u in ("n", "oa") for t in ("raw", "filtered")], "score_year int, universe string, treatment string, issn_l string, share double")
    members = spark.createDataFrame([(2024, "K")], "score_year int, journal_id string")

    def broken(scores=full, among=members, **changes):
        frame = spark.createDataFrame([tuple(handover_row(**changes).values())], schema)
        return {r.rule for r in publish.handover_violations(frame, scores, among).where("n > 0").collect()}

    assert broken() == set()
    assert broken(window_start=2020) == {"another window"} and broken(works_filtered=11) >= {"filtered above raw"} and broken(active_years=6) == {"more active years than the window"}
    assert broken(coverage=None) == {"coverage and works disagree"} and broken(coverage=49.0) == {"coverage is not the share"} and broken(share_oa_raw=float("inf")) >= {"score not a number"}
    assert broken(share_n_raw=-1.0) == {"negative score"} and broken(share_n_raw=None) == {"per article without share"} and broken(per_article_oa_raw=None) == {"per article missing"} and broken(share_oa_raw=0.0) == {"uncited but not zero"}
    assert broken(register_ids="12 | x") == {"odd register id"} and broken(register_ids=None) == {"member without register entry"} and broken(register_level=None) == {"member without level"}
    assert broken(among=members.where("score_year = 1")) == {"register entry of no member", "level of no member", "register score of no member"}
    assert broken(scores=full.where("universe = 'n'")) == {"a state is missing"} and broken(scores=full.unionByName(full.limit(1))) == {"a state repeats a journal", "shares of a state do not add up"}
    assert broken(works_raw=0, works_filtered=0, coverage=None) == {"per article without articles"}


def test_joined_once(spark, rows):
    a, b = spark.createDataFrame([(1, "x"), (1, "y")], "k int, a string"), spark.createDataFrame([(1, "z")], "k int, b string")
    assert publish.joined_once(a, b, ["k"]).count() == 2
    with pytest.raises(ValueError, match="left side"):
        publish.joined_once(a, b, ["k"], both=True)
    with pytest.raises(ValueError, match="right side"):
        publish.joined_once(b, a, ["k"])


def test_projected_edges_conserve(spark, rows):
    edges = spark.createDataFrame([(1, "S1", "0378-5955", "S2", "2049-3630", 3, 2), (1, "S3", "0378-5955", "S2", None, 5, 4), (1, "S9", "0000-0001", "S2", "2049-3630", 7, 1)], "score_year int, citing_source_id string, raw_citing_issn_l string, cited_source_id string, raw_cited_issn_l string, n_raw long, n_filtered long")
    overrides = spark.createDataFrame([("S2", None, "2049-3630")], "source_id string, expected_key string, target string")
    aliases = spark.createDataFrame([], "alias string, target string")
    corrections = spark.createDataFrame([], "key string, target string")
    out = identity.project_edges(edges, overrides, aliases, corrections)
    assert rows(out) == sorted([(1, "0378-5955", "2049-3630", 8, 6), (1, None, "2049-3630", 7, 1)], key=repr)
    assert rows(identity.edge_conservation(out)) == [(1, 1, 8, 6, 7, 1)]


def test_frozen_and_live_years(spark, rows):
    old = spark.createDataFrame([(2023, "a"), (2024, "a")], "score_year int, journal_id string")
    new = spark.createDataFrame([(2023, "b", 1), (2024, "b", 1)], "score_year int, journal_id string, extra int")
    assert rows(publish.frozen_or_live({"old": old, "new": new}, {2023: "old"}, "new"), "score_year", "journal_id", "state") == [(2023, "a", "frozen"), (2024, "b", "live")]
    assert publish.frozen_or_live({"new": new}, {}, "new").count() == 2


def test_wide_scores(spark):
    s = spark.createDataFrame([(1, "n", "raw", "A", 60.0, 2.0), (1, "oa", "filtered", "A", 40.0, None)], "score_year int, universe string, treatment string, issn_l string, share double, per_article double")
    r = publish.wide_scores(s).first()
    assert (r.share_n_raw, r.per_article_n_raw, r.share_oa_filtered, r.per_article_oa_filtered, r.share_n_filtered) == (60.0, 2.0, 40.0, None, None)


def test_metric_columns_have_no_stand_ins(spark):
    df = spark.createDataFrame([(True, None, 1.0, 2.0, 3.0, 7, 9, 11)], "in_n boolean, in_oa boolean, ratio2_filtered double, ratio5_filtered double, per_article_n_filtered double, used_n_filtered long, citations long, works_filtered long")
    get = lambda c: df.select(c.alias("x")).first().x
    s = ranks.Selection(treatment="filtered")
    assert get(ranks.score_column(s, "ratio2")) == 1.0 and get(ranks.score_column(s, "ratio5")) == 2.0 and get(ranks.score_column(s, "per_article")) == 3.0
    assert get(ranks.score_column(s, "ratio2", "oa")) is None
    assert get(ranks.used_count_column(s, "citations")) == 7 and get(ranks.used_count_column(s, "publications")) == 11
    assert get(ranks.used_count_column(ranks.Selection(universe="n", treatment="filtered"), "citations")) != 9


def test_index_document(spark):
    df = spark.createDataFrame([(2024, "Law"), (2024, None), (2025, "Art")], "score_year int, field string")
    doc = publish.index_document(df, {2024: "old", 2025: "new", 2026: "new"}, {2024}, ["n", "oa"])
    assert doc["years"][0] == {"year": 2026, "run": "new", "state": "live", "rows": 0} and doc["years"][2]["state"] == "frozen" and doc["fields"] == ["Art", "Law"]


def test_closed_share(spark):
    every = spark.createDataFrame([(1, "n", "raw", "A", "B", 3.0), (1, "n", "raw", "A", "out", 1.0), (1, "n", "raw", "B", "A", 2.0)], "score_year int, universe string, treatment string, citing string, cited string, w double")
    s = spark.createDataFrame([(1, "n", "raw", "A", 50.0), (1, "n", "raw", "B", 50.0)], "score_year int, universe string, treatment string, issn_l string, share double")
    r = scores.closed_share(every, every.where("cited <> 'out'"), s).first()
    assert (r.closed_share, r.n_citing) == (0.875, 2)


def test_classified_and_ledgers(spark, rows):
    df = spark.createDataFrame([("a1",), ("b2",), ("zz",)], "x string")
    rules = {"first": F.col("x").startswith("a"), "second": F.col("x").startswith("b")}
    assert [r[0] for r in df.select(versions.classified(rules, F.col("x"), review=True)).collect()] == ["first", "second", None]
    with pytest.raises(Exception, match="no rule knows: zz"):
        df.select(versions.classified(rules, F.col("x"))).collect()
    one, two = spark.createDataFrame([("w", "S1"), ("v", "S2")], "k string, t string"), spark.createDataFrame([("w", "S1"), ("v", "S3"), ("u", None)], "k string, t string")
    entries, conflicts = versions.combined_ledgers(one, two, key="k")
    assert rows(entries) == [("u", None), ("w", "S1")] and rows(conflicts) == [("v", 2)]


def test_reviewed_decisions_override(spark, rows):
    matched = spark.createDataFrame([(1, i, "K" if i == "a" else None, "exact_issn" if i == "a" else "no_exact_issn_match") for i in "abcde"], "score_year int, journal_id string, issn_l string, outcome string")
    decisions = spark.createDataFrame([(1, "b", "L"), (1, "b", "L"), (1, "c", None), (1, "d", "L"), (1, "d", "M"), (2, "e", "L"), (1, "zz", "L")], "score_year int, journal_id string, issn_l string")
    got = {r.journal_id: (r.issn_l, r.outcome) for r in register.with_decisions(matched, decisions).collect()}
    assert got == {"a": ("K", "exact_issn"), "b": ("L", "reviewed_match"), "c": (None, "reviewed_no_match"), "d": (None, "conflicting_decisions"), "e": (None, "no_exact_issn_match")}


def test_identity_conflicts_and_isolated(spark, rows):
    assert rows(identity.overlapping_components(spark.createDataFrame([("K", "S1"), ("K", "S1"), ("L", "S1"), ("L", "S2")], "component string, source_id string"))) == [("S1", 2)]
    assert rows(identity.alias_conflicts(spark.createDataFrame([("i", "K"), ("i", "L"), ("j", "K"), ("j", "K")], "issn string, effective_key string"))) == [("i", 2)]
    nodes, edges = cells(spark, [(1, "A", 2, 2), (1, "B", 1, 1), (1, "Z", 3, 3)], [(1, "A", "B", 2, 2), (1, "Z", "Z", 2, 2)], [(1, "oa", k) for k in "ABZ"])
    assert {r.issn_l for r in scores.isolated(nodes, edges).collect()} == {"Z"}


def test_settings():
    s = ranks.Selection(query="x", average=True, min_years=3)
    assert settings.checked_years([2024, 2022]) == [2022, 2024]
    for odd in ([], [2022, 2022], ["2022"], [True], [2022.0]):
        with pytest.raises(ValueError):
            settings.checked_years(odd)
    assert settings.sorted_by(s, "title").descending is False and settings.sorted_by(settings.sorted_by(s, "title"), "title").descending and settings.sorted_by(s, "coverage").descending
    r = settings.with_metric(s, "ratio2", can_average=False)
    assert (r.metric, r.min_years, r.average, r.query) == ("ratio2", 0, False, "x") and settings.with_metric(r, "per_article", True).min_years == ranks.Selection.min_years
    assert settings.with_metric(s, "share", True).min_years == 3 and settings.applied(s, ranks.Selection(metric="ratio5"), True).query == "x"
    assert settings.shown_columns(ranks.Selection(percentile="both"), ["issns"]) == ["journal_id", "title", "field", "score", "field_pct", "pool_pct", "works_filtered", "active_years", "issns"]
    assert "active_years" not in settings.shown_columns(ranks.Selection(metric="ratio2"))
