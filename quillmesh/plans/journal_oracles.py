"""SQL twins of the journal queries, in the dialect of DuckDB.

``BASE`` holds the clean relations; a query takes what it needs from there.
"""

from __future__ import annotations

from quillmesh.plans.general_oracles import dashed, entity, issn


def valid(k: str) -> str:
    """Test of a key made by ``issn``."""
    weights = " + ".join(f"(ascii(substr({k}, {i}, 1)) - 48) * {9 - i}" for i in range(1, 8))
    last = f"CASE WHEN substr({k}, 8, 1) = 'X' THEN 10 ELSE ascii(substr({k}, 8, 1)) - 48 END"
    return f"coalesce(regexp_full_match({k}, '[0-9]{{7}}[0-9X]') AND ({weights} + {last}) % 11 = 0, false)"


def blank(x: str) -> str:
    return f"nullif(trim({x}), '')"


def text(x: str) -> str:
    """Dashed ISSN of a raw value."""
    return dashed(issn(x))


def status(x: str) -> str:
    k = issn(x)
    return f"CASE WHEN {k} IS NULL THEN 'missing' WHEN NOT regexp_full_match({k}, '[0-9]{{7}}[0-9X]') THEN 'invalid_syntax' WHEN NOT {valid(k)} THEN 'invalid_checksum' ELSE 'valid' END"


def bare(x: str) -> str:
    return f"replace({x}, '-', '')"


def _consensus(c: str, conflict: str, missing: str) -> str:
    own, every = f"list_distinct(list({c}) FILTER (canon AND {c} IS NOT NULL))", f"list_distinct(list({c}) FILTER ({c} IS NOT NULL))"
    n = lambda x: f"len(coalesce({x}, []))"
    return f"""CASE WHEN {n(own)} = 1 THEN ({own})[1] WHEN {n(own)} > 1 THEN {conflict} WHEN {n(every)} = 1 THEN ({every})[1] WHEN {n(every)} > 1 THEN {conflict} ELSE {missing} END AS {c},
     CASE WHEN {n(own)} = 1 THEN 'canonical_arm' WHEN {n(own)} > 1 THEN 'canonical_arm_conflict' WHEN {n(every)} = 1 THEN 'unanimous_component_fallback' WHEN {n(every)} > 1 THEN 'component_conflict' ELSE 'missing' END AS {c}_by"""


CONSENSUS = ", ".join(
    _consensus(c, f"'{conflict}'" if conflict else "NULL", "'Unknown'" if conflict else "NULL")
    for c, conflict in (("title", ""), ("publisher", ""), ("source_type", "Multiple source types"), ("oa_field", "Multiple OA fields"), ("oa_domain", "Multiple OA domains"), ("is_open_access", ""))
)


def _project(rows: str, key: str, source: str = "source_id", out: str = "k2") -> str:
    """Projection of (source, key) rows of another relation through the decision tables."""
    return f"""(SELECT r.*, coalesce(o.target, a.target, r.{key}) AS {out} FROM {rows} r LEFT JOIN overrides o ON o.source_id = r.{source} AND o.expected_key = coalesce(r.{key}, '') LEFT JOIN aliases a ON a.alias = r.{key})"""


PROJECTED_VOTES = _project("fvotes", "raw_issn_l")

BASE = f"""
WITH RECURSIVE src AS (
  SELECT {entity('source_id', 'S')} AS source_id, raw_issn_l, {text('raw_issn_l')} AS raw_key, CASE WHEN {valid(issn('raw_issn_l'))} THEN {text('raw_issn_l')} END AS effective_key,
    lower({blank('source_type')}) AS source_type, title, publisher, issns, oa_field, oa_domain, is_open_access, updated_date
  FROM source_rows WHERE snapshot_date = (SELECT max(snapshot_date) FROM source_rows) AND {blank('source_id')} IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY {entity('source_id', 'S')} ORDER BY updated_date DESC NULLS LAST, loaded_at DESC NULLS LAST) = 1
), cnt AS (
  SELECT score_year, {text('issn_l')} AS issn_l, a_raw, a_filtered FROM effective_counts WHERE {issn('issn_l')} IS NOT NULL AND score_year IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY score_year, {issn('issn_l')} ORDER BY loaded_at DESC NULLS LAST, a_raw DESC NULLS LAST, a_filtered DESC NULLS LAST) = 1
), edg AS (
  SELECT score_year, citing, cited, CAST(sum(n_raw) AS BIGINT) AS n_raw, CAST(coalesce(sum(n_filtered), 0) AS BIGINT) AS n_filtered FROM (
    SELECT DISTINCT score_year, chunk_no, {text('citing_issn_l')} AS citing, {text('cited_issn_l')} AS cited, n_raw, n_filtered, extracted_at FROM effective_edges
    WHERE {issn('citing_issn_l')} IS NOT NULL AND {issn('cited_issn_l')} IS NOT NULL) GROUP BY ALL
), wrk AS (
  SELECT record_id, {entity('id', 'W')} AS work_id, {entity('primary_location.source.id', 'S')} AS source_id, {text('primary_location.source.issn_l')} AS raw_issn_l,
    publication_year AS year, type AS work_type, coalesce(referenced_works_count, 0) > 0 AS has_refs, coalesce(referenced_works, []) AS rw, updated_date, is_paratext, is_retracted,
    coalesce(nullif(primary_topic.field.display_name, ''), 'Unknown') AS field, doi, primary_location.landing_page_url AS url
  FROM fixture WHERE {blank('id')} IS NOT NULL QUALIFY row_number() OVER (PARTITION BY {entity('id', 'W')} ORDER BY updated_date DESC NULLS LAST, record_id DESC) = 1
), years AS (SELECT DISTINCT score_year AS y FROM effective_counts WHERE score_year IS NOT NULL
), elig AS (
  SELECT record_id, {entity('id', 'W')} AS work_id, {entity('primary_location.source.id', 'S')} AS source_id, {text('primary_location.source.issn_l')} AS raw_issn_l, publication_year AS year, type AS work_type,
    coalesce(referenced_works_count, 0) > 0 AS has_refs, CASE WHEN publication_year IN (SELECT y FROM years) THEN coalesce(referenced_works, []) END AS rw, coalesce(nullif(primary_topic.field.display_name, ''), 'Unknown') AS field
  FROM fixture WHERE {blank('id')} IS NOT NULL AND publication_year BETWEEN (SELECT min(y) - 5 FROM years) AND (SELECT max(y) FROM years) AND {issn('primary_location.source.issn_l')} IS NOT NULL AND is_paratext IS NOT TRUE AND type IN
   ('article','review','letter','editorial','preprint','book-chapter','erratum','other','retraction','report','dissertation','supplementary-materials','dataset','reference-entry','book')
  QUALIFY row_number() OVER (PARTITION BY {entity('id', 'W')} ORDER BY updated_date DESC NULLS LAST, {text('primary_location.source.issn_l')},
    md5(concat_ws('|', coalesce(primary_location.source.id, '~'), coalesce(primary_location.source.issn_l, '~'), coalesce(publication_year::VARCHAR, '~'), coalesce(type, '~'), coalesce(referenced_works_count::VARCHAR, '~'),
      coalesce(array_to_string(list_transform(referenced_works, lambda r: coalesce(r, '~')), ','), '~'))), record_id) = 1
), ycnt AS (
  SELECT source_id, raw_issn_l, year, count(*) AS a_raw, count(*) FILTER (has_refs) AS a_filtered FROM elig WHERE work_type IN ('article','review') GROUP BY ALL
), wcnt AS (
  SELECT y AS score_year, source_id, raw_issn_l, CAST(sum(a_raw) AS BIGINT) AS a_raw, CAST(sum(a_filtered) AS BIGINT) AS a_filtered FROM ycnt JOIN years ON year BETWEEN y - 5 AND y - 1 GROUP BY ALL
), votes AS (SELECT raw_issn_l, field, count(*) AS votes FROM elig WHERE work_type IN ('article','review') GROUP BY ALL
), fvotes AS (SELECT source_id, raw_issn_l, field, year, count(*) AS n FROM elig WHERE work_type IN ('article','review') GROUP BY ALL
), decided AS (
  SELECT member, min(component) AS component, min(chosen) AS chosen FROM (
    SELECT {text('issn_l')} AS component, {entity('canonical_source_id', 'S')} AS chosen, {entity('m', 'S')} AS member
    FROM (SELECT *, unnest(expected_component_source_ids) AS m FROM reviewed_representative WHERE lower(trim(review_status)) LIKE 'approved%'))
  WHERE member IS NOT NULL AND chosen IS NOT NULL AND component IS NOT NULL GROUP BY member
), alias_all AS (
  SELECT DISTINCT {issn('x')} AS issn, effective_key FROM (SELECT effective_key, unnest(list_append(coalesce(issns, []), raw_issn_l)) AS x FROM src WHERE effective_key IS NOT NULL) WHERE {valid(issn('x'))}
), overrides AS (SELECT d.member AS source_id, coalesce(s.raw_key, '') AS expected_key, d.component AS target FROM decided d JOIN src s ON s.source_id = d.member
), aliases AS (
  SELECT {dashed('issn')} AS alias, min(effective_key) AS target FROM alias_all WHERE issn <> {bare('effective_key')} GROUP BY issn HAVING count(DISTINCT effective_key) = 1
), corrections AS (SELECT DISTINCT {text('issn_l')} AS key FROM reviewed_representative WHERE lower(trim(review_status)) = 'rejected' AND {issn('issn_l')} IS NOT NULL
), proj_src AS (
  SELECT s.source_id, s.raw_key, o.target AS o, a.target AS a, coalesce(o.target, a.target, s.raw_key) AS key, c.key IS NOT NULL AS corrected, s.title, s.publisher, s.source_type, s.oa_field, s.oa_domain, s.is_open_access
  FROM src s LEFT JOIN overrides o ON o.source_id = s.source_id AND o.expected_key = coalesce(s.raw_key, '') LEFT JOIN aliases a ON a.alias = s.raw_key LEFT JOIN corrections c ON c.key = coalesce(o.target, a.target, s.raw_key)
), projected AS (
  SELECT *, CASE WHEN {valid(bare('key'))} THEN key END AS effective_key,
    CASE WHEN NOT {valid(bare('key'))} THEN 'quarantine' WHEN o IS NOT NULL THEN 'override' WHEN corrected THEN 'correction' WHEN a IS NOT NULL THEN 'alias' ELSE 'raw' END AS projected_by FROM proj_src
), ros AS (
  SELECT score_year, {blank('journal_id')} AS journal_id, max(norwegian_level) AS level,
    list_sort(list_distinct(flatten([list({issn('print_issn')}) FILTER ({valid(issn('print_issn'))}), list({issn('online_issn')}) FILTER ({valid(issn('online_issn'))})]))) AS issns
  FROM norwegian_membership WHERE norwegian_level IN (1, 2) AND (ceased_year IS NULL OR ceased_year >= score_year) AND {blank('journal_id')} IS NOT NULL GROUP BY score_year, {blank('journal_id')}
), hits AS (
  SELECT DISTINCT r.score_year, r.journal_id, a.effective_key FROM (SELECT score_year, journal_id, unnest(issns) AS i FROM ros) r JOIN alias_all a ON a.issn = r.i
), mat AS (
  SELECT r.score_year, r.journal_id, r.level, coalesce(h.n, 0) AS n_targets, CASE WHEN h.n = 1 THEN h.k END AS issn_l, coalesce(h.c, '') AS candidates,
    CASE WHEN len(coalesce(r.issns, [])) = 0 THEN 'missing_register_issns' WHEN coalesce(h.n, 0) = 0 THEN 'no_exact_issn_match' WHEN h.n = 1 THEN 'exact_issn' ELSE 'ambiguous_exact_issn_match' END AS outcome
  FROM ros r LEFT JOIN (SELECT score_year, journal_id, count(*) AS n, min(effective_key) AS k, string_agg(effective_key, '|' ORDER BY effective_key) AS c FROM hits GROUP BY ALL) h ON h.score_year = r.score_year AND h.journal_id = r.journal_id
), uni AS (
  SELECT DISTINCT score_year, 'n' AS universe, issn_l FROM mat WHERE issn_l IS NOT NULL
  UNION SELECT y, 'oa', effective_key FROM src, years WHERE effective_key IS NOT NULL AND source_type = 'journal'
), active AS (
  SELECT score_year, issn_l FROM cnt WHERE a_raw > 0 UNION SELECT score_year, citing FROM edg WHERE n_raw > 0 UNION SELECT score_year, cited FROM edg WHERE n_raw > 0
), sta AS (SELECT u.* FROM uni u JOIN active a ON a.score_year = u.score_year AND a.issn_l = u.issn_l
), sedg AS (
  SELECT e.score_year, a.universe, e.citing, e.cited, e.n_raw, e.n_filtered FROM edg e JOIN sta a ON a.score_year = e.score_year AND a.issn_l = e.citing
  JOIN sta b ON b.score_year = e.score_year AND b.issn_l = e.cited AND b.universe = a.universe WHERE e.citing <> e.cited
), recorded AS (
  SELECT score_year, cited AS issn_l, CAST(sum(n_raw) AS BIGINT) AS recorded_raw, CAST(sum(n_filtered) AS BIGINT) AS recorded_filtered, count(*) AS n_citing_journals FROM edg WHERE citing <> cited GROUP BY ALL
), actyears AS (SELECT y AS score_year, raw_issn_l AS issn_l, count(DISTINCT year) AS active_years FROM ycnt JOIN years ON year BETWEEN y - 5 AND y - 1 WHERE a_raw > 0 GROUP BY ALL
), agreed AS (
  SELECT effective_key, count(*) AS n_sources, count(*) FILTER (canon) AS n_canonical, string_agg(DISTINCT source_id, ';' ORDER BY source_id) AS source_ids,
    {CONSENSUS}
  FROM (SELECT effective_key, source_id, title, publisher, source_type, CASE WHEN {blank('oa_field')} <> 'Unknown' THEN oa_field END AS oa_field, CASE WHEN {blank('oa_domain')} <> 'Unknown' THEN oa_domain END AS oa_domain,
    is_open_access::VARCHAR AS is_open_access, coalesce(raw_key = effective_key, false) AS canon FROM projected WHERE effective_key IS NOT NULL) GROUP BY effective_key
), areas AS (
  SELECT m.score_year, m.issn_l, string_agg(DISTINCT n.discipline, ' | ' ORDER BY n.discipline) AS register_area, string_agg(DISTINCT n.field, ' | ' ORDER BY n.field) AS register_field
  FROM mat m JOIN norwegian_membership n ON n.score_year = m.score_year AND {blank('n.journal_id')} = m.journal_id WHERE m.outcome = 'exact_issn' GROUP BY ALL
), listed AS (
  SELECT k, string_agg(DISTINCT x, ';' ORDER BY x) AS issns FROM (SELECT effective_key AS k, {text('x')} AS x FROM (SELECT effective_key, unnest(list_append(coalesce(issns, []), effective_key)) AS x FROM src WHERE effective_key IS NOT NULL)) WHERE x IS NOT NULL GROUP BY k
), memb AS (SELECT score_year, issn_l, bool_or(universe = 'n') AS in_n, bool_or(universe = 'oa') AS in_oa FROM uni GROUP BY ALL
), jy AS (
  SELECT c.score_year, c.issn_l AS journal_id, g.title, g.publisher, l.issns, g.oa_domain AS domain, g.oa_field AS field, g.is_open_access = 'true' AS is_open_access, register_area, register_field, coalesce(in_n, false) AS in_n, coalesce(in_oa, false) AS in_oa,
    a_raw AS works_raw, a_filtered AS works_filtered, coalesce(recorded_raw, 0) AS citations, coalesce(recorded_filtered, 0) AS citations_filtered, 100.0::DOUBLE * a_filtered / nullif(a_raw, 0) AS coverage, coalesce(active_years, 0) AS active_years
  FROM cnt c LEFT JOIN recorded r ON r.score_year = c.score_year AND r.issn_l = c.issn_l LEFT JOIN actyears y ON y.score_year = c.score_year AND y.issn_l = c.issn_l
  LEFT JOIN memb m ON m.score_year = c.score_year AND m.issn_l = c.issn_l LEFT JOIN areas a ON a.score_year = c.score_year AND a.issn_l = c.issn_l LEFT JOIN agreed g ON g.effective_key = c.issn_l LEFT JOIN listed l ON l.k = c.issn_l
), tgt AS (
  SELECT * FROM (SELECT {entity('work_id', 'W')} AS work_id, {blank('journal_id')} AS journal_id, publication_year, work_type, coalesce(observed_references, 0) > 0 AS has_refs, coalesce(is_retracted, false) AS is_retracted, deleted_at
    FROM targets WHERE {blank('work_id')} IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY {entity('work_id', 'W')} ORDER BY arrived_at DESC NULLS LAST, deleted_at ASC NULLS LAST, journal_id ASC NULLS LAST) = 1) WHERE deleted_at IS NULL
), cit AS (
  SELECT {entity('work_id', 'W')} AS work_id, {blank('journal_id')} AS journal_id, publication_year, list_filter(list_transform(coalesce("references", []), lambda x: {entity('x', 'W')}), lambda x: x IS NOT NULL) AS refs,
    coalesce(is_retracted, false) AS is_retracted, coalesce(in_n, false) AS in_n, source_component FROM citing WHERE {blank('work_id')} IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY {entity('work_id', 'W')} ORDER BY arrived_at DESC NULLS LAST, len(coalesce("references", [])) DESC) = 1
), pairs AS (SELECT DISTINCT work_id AS citing_id, unnest(refs) AS target_id FROM cit
), met AS (
  SELECT c.publication_year AS citation_year, t.journal_id, t.publication_year AS cited_year, t.work_type, t.has_refs, NOT c.is_retracted AND NOT t.is_retracted AS clean, coalesce(c.journal_id = t.journal_id, false) AS own, c.source_component
  FROM pairs p JOIN cit c ON c.work_id = p.citing_id AND c.in_n JOIN tgt t ON t.work_id = p.target_id WHERE t.journal_id IS NOT NULL
), cyears AS (SELECT DISTINCT publication_year AS y FROM citing WHERE publication_year IS NOT NULL
), windows AS (SELECT unnest([2, 5]) AS w
), items AS (
  SELECT w, y AS citation_year, journal_id, work_type, has_refs, is_retracted, count(*) AS works FROM tgt, cyears, windows WHERE journal_id IS NOT NULL AND publication_year BETWEEN y - w AND y - 1 GROUP BY ALL
), policies AS (SELECT * FROM (VALUES ('AR', ['article','review']), ('AR_DP', ['article','review','data-paper']), ('AR_DP_SP', ['article','review','data-paper','software-paper']),
   ('AR_DP_SP_CP', ['article','review','data-paper','software-paper','conference-paper'])) v(policy, kinds)
), dens AS (
  SELECT w, policy, citation_year, journal_id, sum(CASE WHEN list_contains(kinds, work_type) THEN works ELSE 0 END) AS d_raw, sum(CASE WHEN list_contains(kinds, work_type) AND has_refs THEN works ELSE 0 END) AS d_ref,
    sum(CASE WHEN NOT list_contains(kinds, work_type) THEN works ELSE 0 END) AS d_not_citable, sum(CASE WHEN list_contains(kinds, work_type) AND is_retracted THEN works ELSE 0 END) AS d_retracted FROM items, policies GROUP BY ALL
), nums AS (
  SELECT w, policy, citation_year, journal_id, count(*) AS c_raw, count(*) FILTER (NOT list_contains(kinds, work_type) OR has_refs) AS c_ref, count(*) FILTER (NOT list_contains(kinds, work_type)) AS c_not_citable, count(*) FILTER (own) AS c_self,
    count(*) FILTER (clean) AS c_raw_without_retracted, count(*) FILTER (clean AND (NOT list_contains(kinds, work_type) OR has_refs)) AS c_ref_without_retracted,
    count(*) FILTER (clean AND NOT list_contains(kinds, work_type)) AS c_not_citable_without_retracted, count(*) FILTER (clean AND own) AS c_self_without_retracted
  FROM met, policies, windows WHERE cited_year BETWEEN citation_year - w AND citation_year - 1 GROUP BY ALL
), pol AS (
  SELECT w, policy, citation_year, journal_id, CAST(coalesce(d_raw, 0) AS BIGINT) AS d_raw, CAST(coalesce(d_ref, 0) AS BIGINT) AS d_ref, CAST(coalesce(d_not_citable, 0) AS BIGINT) AS d_not_citable, CAST(coalesce(d_retracted, 0) AS BIGINT) AS d_retracted,
    coalesce(c_raw, 0) AS c_raw, coalesce(c_ref, 0) AS c_ref, coalesce(c_not_citable, 0) AS c_not_citable, coalesce(c_self, 0) AS c_self, coalesce(c_raw_without_retracted, 0) AS c_raw_without_retracted,
    coalesce(c_ref_without_retracted, 0) AS c_ref_without_retracted, coalesce(c_not_citable_without_retracted, 0) AS c_not_citable_without_retracted, coalesce(c_self_without_retracted, 0) AS c_self_without_retracted
  FROM dens FULL JOIN nums USING (w, policy, citation_year, journal_id)
), vt AS (SELECT y AS score_year, k2 AS issn_l, field, CAST(sum(n) AS BIGINT) AS votes FROM {PROJECTED_VOTES} JOIN years ON year BETWEEN y - 5 AND y - 1 WHERE {valid(bare('k2'))} GROUP BY ALL
), tot AS (SELECT score_year, issn_l, CAST(sum(votes) AS BIGINT) AS all_works, CAST(coalesce(sum(votes) FILTER (field <> 'Unknown'), 0) AS BIGINT) AS classified_works, max(votes) FILTER (field <> 'Unknown') AS top FROM vt GROUP BY ALL
), modal AS (
  SELECT t.score_year, t.issn_l, coalesce(m.mode, 'Unknown') AS field, coalesce(top, 0) AS modal_works, classified_works, all_works, top::DOUBLE / nullif(classified_works, 0) AS modal_share, classified_works::DOUBLE / nullif(all_works, 0) AS coverage,
    coalesce(m.tied, 0) AS tied_modes FROM tot t LEFT JOIN (SELECT v.score_year, v.issn_l, min(v.field) AS mode, count(*) AS tied FROM vt v JOIN tot USING (score_year, issn_l) WHERE v.field <> 'Unknown' AND v.votes = tot.top GROUP BY ALL) m ON m.issn_l = t.issn_l AND m.score_year = t.score_year
), pos AS (SELECT *, row_number() OVER (PARTITION BY score_year, issn_l ORDER BY votes DESC, field) AS pos FROM vt WHERE field <> 'Unknown'
), top3 AS (
  SELECT t.score_year, t.issn_l, t.classified_works, max(field) FILTER (pos = 1) AS field_1, max(field) FILTER (pos = 2) AS field_2, max(field) FILTER (pos = 3) AS field_3, coalesce(max(votes) FILTER (pos = 1), 0) AS works_1,
    coalesce(max(votes) FILTER (pos = 2), 0) AS works_2, coalesce(max(votes) FILTER (pos = 3), 0) AS works_3, CAST(coalesce(sum(votes) FILTER (pos > 3), 0) AS BIGINT) AS works_other
  FROM tot t LEFT JOIN pos p ON p.issn_l = t.issn_l AND p.score_year = t.score_year GROUP BY ALL
), nodes AS (
  SELECT s.score_year, s.universe, t.t AS treatment, s.issn_l, coalesce(CASE t.t WHEN 'raw' THEN c.a_raw ELSE c.a_filtered END, 0)::DOUBLE AS articles
  FROM sta s, (VALUES ('raw'), ('filtered')) t(t) LEFT JOIN cnt c ON c.score_year = s.score_year AND c.issn_l = s.issn_l
), arcs AS (
  SELECT score_year, universe, t.t AS treatment, citing, cited, (CASE t.t WHEN 'raw' THEN n_raw ELSE n_filtered END)::DOUBLE AS w FROM sedg, (VALUES ('raw'), ('filtered')) t(t) WHERE CASE t.t WHEN 'raw' THEN n_raw ELSE n_filtered END > 0
), norm AS (SELECT *, w / sum(w) OVER (PARTITION BY score_year, universe, treatment, citing) AS h FROM arcs"""

# The solve runs a fixed number of steps on numbered nodes; after 130 steps the remaining change is far below the rounding.
SOLVE = (
    BASE
    + """
), num AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY n.score_year, n.universe, n.treatment, n.issn_l) AS id, dense_rank() OVER (ORDER BY n.score_year, n.universe, n.treatment) AS cell, n.*,
    articles / sum(articles) OVER (PARTITION BY n.score_year, n.universe, n.treatment) AS a,
    NOT EXISTS (SELECT 1 FROM arcs x WHERE x.score_year = n.score_year AND x.universe = n.universe AND x.treatment = n.treatment AND x.citing = n.issn_l) AS dangling
  FROM nodes n
), arc AS MATERIALIZED (
  SELECT a.id AS src, b.id AS dst, h FROM norm x JOIN num a ON a.score_year = x.score_year AND a.universe = x.universe AND a.treatment = x.treatment AND a.issn_l = x.citing
  JOIN num b ON b.score_year = x.score_year AND b.universe = x.universe AND b.treatment = x.treatment AND b.issn_l = x.cited
), it AS (
  SELECT 0 AS step, id, cell, a AS p FROM num
  UNION ALL
  SELECT s.step + 1, n.id, n.cell, 0.85::DOUBLE * coalesce(f.x, 0) + (0.85::DOUBLE * coalesce(l.m, 0) + 0.15::DOUBLE) * n.a
  FROM num n JOIN (SELECT DISTINCT step FROM it WHERE step < 130) s ON true
  LEFT JOIN (SELECT arc.dst, sum(arc.h * it.p) AS x FROM arc JOIN it ON it.id = arc.src GROUP BY arc.dst) f ON f.dst = n.id
  LEFT JOIN (SELECT it.cell, sum(it.p) AS m FROM it JOIN num d ON d.id = it.id AND d.dangling GROUP BY it.cell) l ON l.cell = n.cell
), flow AS (SELECT n.id, coalesce(sum(arc.h * it.p), 0) AS f FROM num n LEFT JOIN arc ON arc.dst = n.id LEFT JOIN it ON it.id = arc.src AND it.step = 130 GROUP BY n.id
), solved AS (
  SELECT n.*, 100 * f / sum(f) OVER (PARTITION BY cell) AS share FROM num n JOIN flow USING (id)
), scored AS (SELECT score_year, universe, treatment, issn_l, share, a, CASE WHEN articles > 0 THEN share / 100 / a END AS per_article, share * count(*) OVER (PARTITION BY cell) / 100 AS normalised, articles > 0 AS defined FROM solved"""
)

RATIO = """
), rat AS (
  SELECT citation_year AS score_year, journal_id, max(a) FILTER (w = 2) AS ratio2_raw, max(b) FILTER (w = 2) AS ratio2_filtered, max(a) FILTER (w = 5) AS ratio5_raw, max(b) FILTER (w = 5) AS ratio5_filtered FROM (
    SELECT *, (CASE WHEN citation_year >= 2024 THEN c_raw_without_retracted ELSE c_raw END)::DOUBLE / nullif(d_raw, 0) AS a, (CASE WHEN citation_year >= 2024 THEN c_ref_without_retracted ELSE c_ref END)::DOUBLE / nullif(d_ref, 0) AS b
    FROM pol WHERE policy = 'AR') GROUP BY ALL
), val AS (SELECT score_year, journal_id, ratio2_filtered AS s, coalesce(ratio2_raw, ratio2_filtered, ratio5_raw, ratio5_filtered) IS NOT NULL AS any_ratio FROM rat"""

NETWORK = """
), val AS (SELECT score_year, issn_l AS journal_id, max(per_article) FILTER (universe = 'n' AND treatment = 'filtered') AS s, false AS any_ratio FROM scored GROUP BY ALL"""


def _ranks(history: str = "") -> str:
    """Ranks within fields and over what is retained, of the values in ``val``."""
    return f"""
), judged AS (
  SELECT j.*, CASE WHEN in_n THEN v.s END AS score, coalesce(v.any_ratio, false) AS any_ratio, coalesce(nullif(field, ''), 'Unclassified') AS grp, CASE WHEN NOT in_n THEN 'not in universe' WHEN v.s IS NULL THEN 'no score' WHEN coverage IS NULL THEN 'coverage unavailable'
    WHEN coverage <= 10 THEN 'coverage too low' {history} END AS reason0 FROM jy j LEFT JOIN val v ON v.score_year = j.score_year AND v.journal_id = j.journal_id
), within_f AS (
  SELECT score_year, journal_id, score, 100.0::DOUBLE * count(*) OVER (PARTITION BY score_year, grp ORDER BY score RANGE UNBOUNDED PRECEDING) / count(*) OVER (PARTITION BY score_year, grp) AS field_pct,
    count(*) OVER (PARTITION BY score_year, grp) AS field_count FROM judged WHERE reason0 IS NULL
), pool AS (
  SELECT score_year, journal_id, 100.0::DOUBLE * count(*) OVER (PARTITION BY score_year ORDER BY score RANGE UNBOUNDED PRECEDING) / count(*) OVER (PARTITION BY score_year) AS pool_pct FROM within_f WHERE field_pct > 25
), ranked AS (
  SELECT j.*, field_pct, pool_pct, field_count, coalesce(reason0, CASE WHEN pool_pct IS NULL THEN 'outside the top share of its field' END) AS reason
  FROM judged j LEFT JOIN within_f f ON f.score_year = j.score_year AND f.journal_id = j.journal_id LEFT JOIN pool p ON p.score_year = j.score_year AND p.journal_id = j.journal_id"""


RANKS = BASE + RATIO + _ranks()
NETWORK_RANKS = SOLVE + NETWORK + _ranks("WHEN active_years < 1 THEN 'history too short'")

_CITABLE = "work_type IN ('article','review')"


def _q(select: str, base: str = BASE) -> str:
    return f"{base}\n) {select}"


_MODES = [("all", "true"), ("without_retracted", "clean")]
_KINDS = [("N-journal", "n_journal"), ("N-nonjournal", "n_nonjournal"), ("outside-N-journal", "outside_n_journal"), ("outside-N-book-proceedings", "outside_n_book_proceedings"), ("other", "other")]
_COMPONENT_SUMS = ", ".join(
    x for mode, test in _MODES for x in [f"count(*) FILTER ({test}) AS n_{mode}", f"count(*) FILTER ({test} AND own) AS self_{mode}", *[f"count(*) FILTER ({test} AND source_component = '{label}') AS {name}_{mode}" for label, name in _KINDS]]
)
_POLICY_COLUMNS = "policy, citation_year, journal_id, d_raw, d_ref, d_not_citable, d_retracted, c_raw, c_ref, c_not_citable, c_self, c_raw_without_retracted, c_ref_without_retracted, c_not_citable_without_retracted, c_self_without_retracted"
_SEARCH = "contains(lower(concat_ws(' ', journal_id, nullif(title, ''), nullif(issns, ''), nullif(publisher, ''), nullif(domain, ''), nullif(field, ''), nullif(register_area, ''), nullif(register_field, ''))), 'journal of')"
_CSV = lambda c: f"""coalesce('"' || replace(CASE WHEN regexp_matches({c}, '^[=+@\\-\\t\\r]') THEN '''' || {c} ELSE {c} END, '"', '""') || '"', '')"""


_FIRST = f"""(SELECT score_year, {text('issn_l')} AS journal_id, a_raw, a_filtered FROM effective_counts WHERE {issn('issn_l')} IS NOT NULL AND score_year IS NOT NULL QUALIFY row_number() OVER (PARTITION BY score_year, {issn('issn_l')} ORDER BY loaded_at ASC NULLS LAST, a_raw DESC NULLS LAST, a_filtered DESC NULLS LAST) = 1)"""
_LAST = f"""(SELECT score_year, {text('issn_l')} AS journal_id, a_raw, a_filtered FROM effective_counts WHERE {issn('issn_l')} IS NOT NULL AND score_year IS NOT NULL QUALIFY row_number() OVER (PARTITION BY score_year, {issn('issn_l')} ORDER BY loaded_at DESC NULLS LAST, a_raw DESC NULLS LAST, a_filtered DESC NULLS LAST) = 1)"""
_EDGES = f"""SELECT c.year AS score_year, c.source_id AS citing_source_id, c.raw_issn_l AS raw_citing_issn_l, t.source_id AS cited_source_id, t.raw_issn_l AS raw_cited_issn_l, count(*) AS n_raw, count(*) FILTER (t.has_refs) AS n_filtered
        FROM (SELECT DISTINCT work_id, year, source_id, raw_issn_l, {entity('r', 'W')} AS ref FROM (SELECT *, unnest(rw) AS r FROM elig WHERE has_refs AND rw IS NOT NULL)) c
        JOIN elig t ON t.work_id = c.ref AND t.{_CITABLE} AND t.year BETWEEN c.year - 5 AND c.year - 1 GROUP BY ALL"""


def _handed() -> str:
    """Violations of the rules for handed over rows, each counted by a condition of its own."""
    pairs = [(f"share_{u}_{t}", f"per_article_{u}_{t}", f"works_{t}") for u in ("n", "oa") for t in ("raw", "filtered")]
    some = lambda f: " OR ".join(f"coalesce({f(*p)}, false)" for p in pairs)
    rules = {
        "year or id missing": "score_year IS NULL OR coalesce(trim(journal_id), '') = ''", "another window": "false", "not a count": "works_raw IS NULL OR works_filtered IS NULL OR least(works_raw, works_filtered, citations, citations_filtered, active_years) < 0",
        "filtered above raw": "works_filtered > works_raw OR citations_filtered > citations", "more active years than the window": "active_years > 5", "coverage and works disagree": "(works_raw > 0) <> (coverage IS NOT NULL)", "coverage is not the share": "abs(coverage - 100.0 * works_filtered / works_raw) > 1e-8",
        "score not a number": some(lambda s, p, w: f"isnan({s}) OR isinf({s}) OR isnan({p}) OR isinf({p})"), "negative score": some(lambda s, p, w: f"{s} < 0 OR {p} < 0"), "share above 100": some(lambda s, p, w: f"{s} > 100 + 1e-8"),
        "no score at all": "coalesce(" + ", ".join(x for p in pairs for x in p[:2]) + ") IS NULL", "per article without share": some(lambda s, p, w: f"{s} IS NULL AND {p} IS NOT NULL"), "per article without articles": some(lambda s, p, w: f"{w} = 0 AND {p} IS NOT NULL"),
        "per article missing": some(lambda s, p, w: f"{s} IS NOT NULL AND {w} > 0 AND {p} IS NULL"), "uncited but not zero": some(lambda s, p, w: f"{s} = 0 AND {p} <> 0"), "member without register entry": "in_n AND ids IS NULL", "register entry of no member": "NOT in_n AND ids IS NOT NULL",
        "member without level": "in_n AND level IS NULL", "level of no member": "NOT in_n AND level IS NOT NULL", "odd register id": "NOT regexp_full_match(ids, '[0-9]+( [|] [0-9]+)*')", "register score of no member": "NOT in_n AND coalesce(share_n_raw, share_n_filtered, per_article_n_raw, per_article_n_filtered) IS NOT NULL",
    }
    wide = ", ".join(f"max({m}) FILTER (universe = '{u}' AND treatment = '{t}') AS {m}_{u}_{t}" for m in ("share", "per_article") for u in ("n", "oa") for t in ("raw", "filtered"))
    frame = f"""(SELECT j.*, w.* EXCLUDE (score_year, issn_l), r.ids, r.level FROM jy j JOIN (SELECT score_year, issn_l, {wide} FROM scored GROUP BY ALL) w ON w.score_year = j.score_year AND w.issn_l = j.journal_id
      LEFT JOIN (SELECT score_year, issn_l, string_agg(journal_id, ' | ' ORDER BY journal_id) AS ids, max(level) AS level FROM mat WHERE outcome = 'exact_issn' GROUP BY ALL) r ON r.score_year = j.score_year AND r.issn_l = j.journal_id)"""
    counts = ", ".join(f"count(*) FILTER ({test})" for test in rules.values())
    names = ", ".join(f"'{r}'" for r in rules)
    return f"""SELECT unnest([{names}]) AS rule, unnest([{counts}]) AS n FROM {frame} UNION ALL SELECT 'repeated key', count(*) - count(DISTINCT (score_year, journal_id)) FROM {frame}
      UNION ALL SELECT 'shares of a state do not add up', count(*) FILTER (abs(x - 100) > 1e-8) FROM (SELECT sum(share) AS x FROM scored GROUP BY score_year, universe, treatment)
      UNION ALL SELECT 'a state is missing', count(*) FILTER (c <> 4) FROM (SELECT count(DISTINCT (universe, treatment)) AS c FROM scored GROUP BY score_year)
      UNION ALL SELECT 'a state repeats a journal', count(*) - count(DISTINCT (score_year, universe, treatment, issn_l)) FROM scored"""


ORACLES: dict[str, str] = {
    "version_dedup": _q("SELECT work_id, record_id, source_id, raw_issn_l, year, work_type, has_refs FROM wrk"),
    "latest_with_ties": _q(
        f"""SELECT snapshot_date, source_id, count(*) AS n_states FROM (SELECT DISTINCT snapshot_date, source_id, updated_date, title, publisher, oa_field, is_open_access FROM (
        SELECT {blank('snapshot_date')} AS snapshot_date, {entity('source_id', 'S')} AS source_id, updated_date, title, publisher, oa_field, is_open_access FROM source_rows WHERE {blank('source_id')} IS NOT NULL)
        QUALIFY dense_rank() OVER (PARTITION BY snapshot_date, source_id ORDER BY updated_date DESC NULLS LAST) = 1) GROUP BY ALL"""
    ),
    "works_filter_project": _q(f"SELECT work_id, raw_issn_l, year, {_CITABLE} AS is_citable, has_refs, field, len(rw) AS n_refs FROM elig"),
    "yearly_counts": _q("SELECT * FROM ycnt"),
    "window_counts": _q("SELECT * FROM wcnt"),
    "citation_edges": _q(_EDGES),
    "ledger_patch_exclude": _q(
        "SELECT w.work_id, coalesce(d.chosen, w.source_id) AS source_id, w.raw_issn_l, w.year, d.chosen IS NOT NULL AS patched FROM wrk w LEFT JOIN decided d ON d.member = w.source_id AND d.member <> d.chosen WHERE w.is_retracted IS NOT TRUE"
    ),
    "preimage_audit": _q("SELECT count(*) AS n_entries, 0::BIGINT AS n_absent, count(*) FILTER (w.raw_issn_l IS DISTINCT FROM d.component) AS n_changed FROM wrk w JOIN decided d ON d.member = w.source_id AND d.member <> d.chosen"),
    "field_votes": _q("SELECT * FROM votes"),
    "doi_and_host": _q(
        r"SELECT coalesce(nullif(lower(regexp_extract(url, '^https?://([^/:?#]+)', 1)), ''), 'none') AS host, coalesce(nullif(regexp_extract(doi, '^(10\.[0-9]{4,9})/\S+$', 1), ''), 'none') AS doi_prefix, count(*) AS n_works FROM wrk GROUP BY ALL"
    ),
    "row_fingerprints": _q(
        f"""SELECT work_id, count(*) AS n_rows, count(DISTINCT f) AS n_fingerprints FROM (SELECT {entity('id', 'W')} AS work_id, md5(concat_ws('|', coalesce(type, '~'), coalesce(publication_year::VARCHAR, '~'), coalesce(doi, '~'), coalesce(title, '~'))) AS f FROM fixture)
        GROUP BY work_id HAVING count(*) > 1"""
    ),
    "identity_projection": _q("SELECT source_id, raw_key, effective_key, projected_by FROM projected"),
    "identity_quarantine": _q(
        f"SELECT CASE WHEN {valid(bare('k2'))} THEN 'kept' ELSE {status('raw_issn_l')} END AS status, count(*) AS n_rows, count(*) AS works FROM {_project('(SELECT source_id, raw_issn_l FROM wrk WHERE source_id IS NOT NULL)', 'raw_issn_l')} GROUP BY 1"
    ),
    "projected_counts": _q(f"SELECT score_year, k2 AS issn_l, CAST(sum(a_raw) AS BIGINT) AS a_raw, CAST(sum(a_filtered) AS BIGINT) AS a_filtered FROM {_project('wcnt', 'raw_issn_l')} WHERE {valid(bare('k2'))} GROUP BY ALL"),
    "null_safe_identity": _q("SELECT coalesce(raw_issn_l, 'oa:' || source_id, 'none') AS journal_id, count(*) AS n_works FROM wrk GROUP BY 1"),
    "attribute_consensus": _q("SELECT * FROM agreed"),
    "projected_edges": _q(
        f"""SELECT score_year, citing, cited, CAST(sum(n_raw) AS BIGINT) AS n_raw, CAST(sum(n_filtered) AS BIGINT) AS n_filtered FROM (SELECT score_year, CASE WHEN {valid(bare('k1'))} THEN k1 END AS citing, CASE WHEN {valid(bare('k2'))} THEN k2 END AS cited, n_raw, n_filtered
        FROM {_project(_project('(' + _EDGES + ')', 'raw_citing_issn_l', 'citing_source_id', 'k1'), 'raw_cited_issn_l', 'cited_source_id', 'k2')}) GROUP BY ALL"""
    ),
    "projection_conservation": _q(
        f"""SELECT score_year, CAST(sum(n_raw) AS BIGINT) AS input_n_raw, CAST(sum(n_filtered) AS BIGINT) AS input_n_filtered, count(DISTINCT CASE WHEN ok THEN k1 || k2 END) AS effective_edges, CAST(coalesce(sum(n_raw) FILTER (ok), 0) AS BIGINT) AS effective_n_raw,
        CAST(coalesce(sum(n_filtered) FILTER (ok), 0) AS BIGINT) AS effective_n_filtered, CAST(coalesce(sum(n_raw) FILTER (NOT ok), 0) AS BIGINT) AS quarantined_n_raw, CAST(coalesce(sum(n_filtered) FILTER (NOT ok), 0) AS BIGINT) AS quarantined_n_filtered
        FROM (SELECT *, {valid(bare('k1'))} AND {valid(bare('k2'))} AS ok FROM {_project(_project('(' + _EDGES + ')', 'raw_citing_issn_l', 'citing_source_id', 'k1'), 'raw_cited_issn_l', 'cited_source_id', 'k2')}) GROUP BY 1"""
    ),
    "representative_arms": _q("SELECT s.source_id, s.effective_key, coalesce(d.chosen = s.source_id, true) AS shown FROM src s LEFT JOIN decided d ON d.member = s.source_id"),
    "issn_key_status": _q(f"SELECT snapshot_date, {status('raw_issn_l')} AS status, count(*) AS n_rows FROM source_rows GROUP BY ALL"),
    "source_key_variants": _q(
        f"""SELECT source_id, count(*) AS n_variants, coalesce(string_agg(raw_key, ' | ' ORDER BY raw_key), '') AS variants, count(*) FILTER (status = 'missing') AS n_missing, count(*) FILTER (status LIKE 'invalid%') AS n_invalid, bool_or(status = 'valid') AS has_valid
        FROM (SELECT DISTINCT {entity('source_id', 'S')} AS source_id, {text('raw_issn_l')} AS raw_key, {status('raw_issn_l')} AS status FROM source_rows WHERE {blank('source_id')} IS NOT NULL) GROUP BY source_id"""
    ),
    "register_roster": _q("SELECT score_year, journal_id, level, array_to_string(coalesce(issns, []), ',') AS issns FROM ros"),
    "register_match": _q("SELECT * FROM mat"),
    "register_match_summary": _q("SELECT score_year, outcome, count(*) AS n_journals FROM mat GROUP BY ALL"),
    "register_group": _q("SELECT score_year, issn_l, string_agg(journal_id, ' | ' ORDER BY coalesce(TRY_CAST(journal_id AS BIGINT), 0), journal_id) AS journal_ids, count(*) AS n_journals, max(level) AS level FROM mat WHERE outcome = 'exact_issn' GROUP BY ALL"),
    "register_entries": _q(
        f"""SELECT score_year, issn_l, count(*) AS n_entries, '[' || string_agg('{{' || concat_ws(',', '"id":' || to_json(id), '"title":' || to_json(title), '"print":' || to_json(p), '"online":' || to_json(o)) || '}}', ',' ORDER BY n, id, title NULLS FIRST, p NULLS FIRST, o NULLS FIRST) || ']' AS entries_json
        FROM (SELECT DISTINCT m.score_year, m.issn_l, coalesce(TRY_CAST(m.journal_id AS BIGINT), 0) AS n, m.journal_id AS id, {blank('r.international_title')} AS title, {text('r.print_issn')} AS p, {text('r.online_issn')} AS o
          FROM mat m JOIN norwegian_membership r ON r.score_year = m.score_year AND {blank('r.journal_id')} = m.journal_id WHERE m.outcome = 'exact_issn') GROUP BY ALL"""
    ),
    "register_primary_title": _q(
        r"""SELECT issn_l, min(journal_id) AS journal_id FROM (SELECT DISTINCT m.issn_l, m.journal_id, lower(regexp_replace(n.international_title, '[^\p{L}\p{N}]', '', 'g')) AS t FROM mat m JOIN norwegian_membership n ON trim(n.journal_id) = m.journal_id AND n.score_year = 2025
          WHERE m.score_year = 2025 AND m.issn_l IS NOT NULL) c JOIN (SELECT DISTINCT effective_key, lower(regexp_replace(title, '[^\p{L}\p{N}]', '', 'g')) AS t FROM src WHERE effective_key IS NOT NULL) s ON s.effective_key = c.issn_l AND s.t = c.t
        WHERE c.t <> '' GROUP BY issn_l HAVING count(DISTINCT journal_id) = 1"""
    ),
    "register_primary_titles": _q(
        r"""SELECT p.score_year, p.issn_l, p.journal_id, n.n_journals FROM (
          SELECT c.score_year, c.issn_l, min(c.journal_id) AS journal_id FROM (SELECT m.score_year, m.issn_l, m.journal_id, lower(regexp_replace(unnest([n.original_title, n.international_title]), '[^\p{L}\p{N}]', '', 'g')) AS t
            FROM mat m JOIN norwegian_membership n ON trim(n.journal_id) = m.journal_id AND n.score_year = m.score_year WHERE m.issn_l IS NOT NULL) c
          JOIN (SELECT DISTINCT effective_key, lower(regexp_replace(title, '[^\p{L}\p{N}]', '', 'g')) AS t FROM src WHERE effective_key IS NOT NULL) s ON s.effective_key = c.issn_l AND s.t = c.t
          WHERE c.t <> '' GROUP BY c.score_year, c.issn_l HAVING count(DISTINCT c.journal_id) = 1) p
        JOIN (SELECT score_year, issn_l, count(*) AS n_journals FROM mat WHERE issn_l IS NOT NULL GROUP BY ALL) n ON n.score_year = p.score_year AND n.issn_l = p.issn_l"""
    ),
    "register_urls": _q("SELECT score_year, issn_l, string_agg(journal_id, ', ' ORDER BY coalesce(TRY_CAST(journal_id AS BIGINT), 0), journal_id) AS ids FROM mat WHERE outcome = 'exact_issn' AND regexp_full_match(journal_id, '[0-9]+') GROUP BY ALL"),
    "register_levels": _q(f"SELECT {blank('journal_id')} AS journal_id, string_agg(DISTINCT norwegian_level::VARCHAR, ', ' ORDER BY norwegian_level::VARCHAR) FILTER (norwegian_level IN (1, 2)) AS level FROM norwegian_membership GROUP BY 1"),
    "journal_edges": _q("SELECT * FROM edg"),
    "role_masses": _q(
        """SELECT score_year, issn_l, CAST(sum(a) AS BIGINT) AS a_raw, CAST(sum(b) AS BIGINT) AS a_filtered, CAST(sum(c) AS BIGINT) AS citing_n_raw, CAST(sum(d) AS BIGINT) AS citing_n_filtered, CAST(sum(e) AS BIGINT) AS cited_n_raw, CAST(sum(f) AS BIGINT) AS cited_n_filtered FROM (
        SELECT score_year, issn_l, coalesce(a_raw, 0) AS a, coalesce(a_filtered, 0) AS b, 0 AS c, 0 AS d, 0 AS e, 0 AS f FROM cnt UNION ALL SELECT score_year, citing, 0, 0, n_raw, n_filtered, 0, 0 FROM edg UNION ALL SELECT score_year, cited, 0, 0, 0, 0, n_raw, n_filtered FROM edg) GROUP BY ALL"""
    ),
    "universe_states": _q("SELECT * FROM sta"),
    "used_citations": _q(
        "SELECT s.score_year, s.universe, s.issn_l, CAST(coalesce(sum(e.n_raw), 0) AS BIGINT) AS used_raw, CAST(coalesce(sum(e.n_filtered), 0) AS BIGINT) AS used_filtered FROM sta s LEFT JOIN sedg e ON e.score_year = s.score_year AND e.universe = s.universe AND e.cited = s.issn_l GROUP BY ALL"
    ),
    "recorded_citations": _q("SELECT * FROM recorded"),
    "active_years": _q("SELECT score_year, issn_l, active_years FROM actyears"),
    "column_normalised": _q("SELECT score_year, universe, treatment, citing, cited, round(h, 9) AS h FROM norm"),
    "network_scores": _q("SELECT score_year, universe, treatment, issn_l, round(share, 8) AS share, round(per_article, 7) AS per_article, round(normalised, 7) AS normalised, defined FROM scored", SOLVE),
    "score_input_faults": _q(
        """SELECT * FROM (VALUES ('count without key', (SELECT count(*) FROM cnt WHERE issn_l IS NULL OR score_year IS NULL)), ('negative article count', (SELECT count(*) FROM cnt WHERE a_raw < 0 OR a_filtered < 0)), ('filtered articles above raw', (SELECT count(*) FROM cnt WHERE a_filtered > a_raw)),
        ('edge without key', (SELECT count(*) FROM edg WHERE citing IS NULL OR cited IS NULL OR score_year IS NULL)), ('negative citation count', (SELECT count(*) FROM edg WHERE n_raw < 0 OR n_filtered < 0)), ('filtered citations above raw', (SELECT count(*) FROM edg WHERE n_filtered > n_raw)),
        ('repeated count', (SELECT count(*) - count(DISTINCT (score_year, issn_l)) FROM cnt)), ('repeated edge', (SELECT count(*) - count(DISTINCT (score_year, citing, cited)) FROM edg)),
        ('empty state', (SELECT count(*) FROM (SELECT DISTINCT score_year, u FROM cnt, (VALUES ('n'), ('oa')) v(u)) c WHERE (score_year, u) NOT IN (SELECT (score_year, universe) FROM sta)))) v(rule, n)"""
    ),
    "score_audit": _q(
        """SELECT s.*, n_edges, edge_weight FROM (SELECT score_year, universe, treatment, count(*) AS n_nodes, round(sum(share), 6) AS share_sum, round(sum(a * coalesce(per_article, 0)), 6) AS mean_per_article, count(*) FILTER (NOT defined) AS n_undefined, (SELECT round(max(d), 9) FROM (SELECT sum(abs(x.p - y.p)) AS d FROM it x JOIN it y ON y.id = x.id AND x.step = 130 AND y.step = 129 GROUP BY x.cell)) AS residual,
          bit_xor(CAST('0x' || substr(md5(issn_l), 1, 15) AS BIGINT)) AS state_digest FROM scored GROUP BY ALL) s LEFT JOIN (SELECT score_year, universe, treatment, count(*) AS n_edges, CAST(sum(w) AS BIGINT) AS edge_weight FROM arcs GROUP BY ALL) e USING (score_year, universe, treatment)""",
        SOLVE,
    ),
    "annual_scores_wide": _q(
        "SELECT score_year, issn_l, " + ", ".join(f"round(max({m}) FILTER (universe = '{u}' AND treatment = '{t}'), 7) AS {m}_{u}_{t}" for m in ("share", "per_article") for u in ("n", "oa") for t in ("raw", "filtered")) + " FROM scored GROUP BY ALL", SOLVE
    ),
    "annual_table": _q(
        "SELECT j.score_year, j.journal_id, j.title, j.in_n, j.in_oa, j.works_raw, j.works_filtered, j.citations, j.active_years, w.* EXCLUDE (score_year, issn_l), u.* EXCLUDE (score_year, issn_l), m.field AS modal_field, m.modal_works, m.classified_works, r.journal_ids, r.level FROM jy j JOIN (SELECT score_year, issn_l, "
        + ", ".join(f"round(max({m}) FILTER (universe = '{u}' AND treatment = '{t}'), 7) AS {m}_{u}_{t}" for m in ("share", "per_article") for u in ("n", "oa") for t in ("raw", "filtered"))
        + """ FROM scored GROUP BY ALL) w ON w.score_year = j.score_year AND w.issn_l = j.journal_id LEFT JOIN (SELECT s.score_year, s.issn_l, """
        + ", ".join(f"CAST(max(CASE WHEN s.universe = '{u}' THEN coalesce(e.{t}, 0) END) AS BIGINT) AS used_{u}_{t}" for u in ("n", "oa") for t in ("raw", "filtered"))
        + """ FROM sta s LEFT JOIN (SELECT score_year, universe, cited, sum(n_raw) AS raw, sum(n_filtered) AS filtered FROM sedg GROUP BY ALL) e ON e.score_year = s.score_year AND e.universe = s.universe AND e.cited = s.issn_l GROUP BY ALL) u
          ON u.score_year = j.score_year AND u.issn_l = j.journal_id LEFT JOIN modal m ON m.issn_l = j.journal_id AND m.score_year = j.score_year LEFT JOIN (SELECT score_year, issn_l, string_agg(journal_id, ' | ' ORDER BY coalesce(TRY_CAST(journal_id AS BIGINT), 0), journal_id) AS journal_ids,
          max(level) AS level FROM mat WHERE outcome = 'exact_issn' GROUP BY ALL) r ON r.score_year = j.score_year AND r.issn_l = j.journal_id""",
        SOLVE,
    ),
    "closed_share": _q(
        """SELECT s.score_year, s.universe, s.treatment, round(sum(share * coalesce(k.w, 0) / f.w) / sum(share), 7) AS closed_share, count(*) AS n_citing FROM scored s
        JOIN (SELECT e.score_year, a.universe, t.t AS treatment, e.citing, sum(CASE t.t WHEN 'raw' THEN n_raw ELSE n_filtered END)::DOUBLE AS w FROM edg e JOIN sta a ON a.score_year = e.score_year AND a.issn_l = e.citing, (VALUES ('raw'), ('filtered')) t(t)
          WHERE e.citing <> e.cited GROUP BY ALL HAVING w > 0) f ON f.score_year = s.score_year AND f.universe = s.universe AND f.treatment = s.treatment AND f.citing = s.issn_l
        LEFT JOIN (SELECT score_year, universe, treatment, citing, sum(w) AS w FROM arcs GROUP BY ALL) k ON k.score_year = s.score_year AND k.universe = s.universe AND k.treatment = s.treatment AND k.citing = s.issn_l GROUP BY ALL""",
        SOLVE,
    ),
    "ratio_annual": _q(
        """SELECT citation_year, journal_id, 5 AS window_years, c AS citations_raw, f AS citations_ref, d_raw, d_ref, round(c::DOUBLE / nullif(d_raw, 0), 9) AS score_raw, round(f::DOUBLE / nullif(d_ref, 0), 9) AS score_ref,
        round(f::DOUBLE / nullif(d_ref, 0) - c::DOUBLE / nullif(d_raw, 0), 9) AS score_difference, CASE WHEN d_ref > 0 THEN 'defined' WHEN d_raw > 0 THEN 'ref_denominator_collapse' ELSE 'no_raw_citable_items' END AS status,
        CASE WHEN citation_year >= 2024 THEN 'without_retracted' ELSE 'all' END AS retraction, (citation_year + 2)::VARCHAR || '-01-01' AS mature_on
        FROM (SELECT *, CASE WHEN citation_year >= 2024 THEN c_raw_without_retracted ELSE c_raw END AS c, CASE WHEN citation_year >= 2024 THEN c_ref_without_retracted ELSE c_ref END AS f FROM pol WHERE w = 5 AND policy = 'AR')"""
    ),
    "ratio_components": _q(f"SELECT citation_year, journal_id, work_type, has_refs, {_COMPONENT_SUMS} FROM met WHERE cited_year BETWEEN citation_year - 5 AND citation_year - 1 GROUP BY ALL"),
    "ratio_items": _q("SELECT citation_year, journal_id, work_type, has_refs, is_retracted, works FROM items WHERE w = 5"),
    "ratio_policies_two_years": _q(f"SELECT {_POLICY_COLUMNS} FROM pol WHERE w = 2"),
    "ratio_policies_five_years": _q(f"SELECT {_POLICY_COLUMNS} FROM pol WHERE w = 5"),
    "ratio_grid": _q(
        " UNION ALL ".join(
            f"SELECT policy, citation_year, journal_id, '{mode}' AS retraction, '{a}' AS numerator, '{b}' AS denominator, c_{a}{tail} AS citations, d_{b} AS items, round(c_{a}{tail}::DOUBLE / nullif(d_{b}, 0), 9) AS score, CASE WHEN d_{b} > 0 THEN 'defined' WHEN d_raw > 0 THEN 'ref_denominator_collapse' ELSE 'no_raw_citable_items' END AS status FROM pol WHERE w = 2"
            for mode, tail in (("all", ""), ("without_retracted", "_without_retracted")) for a in ("raw", "ref") for b in ("raw", "ref")
        )
    ),
    "ratio_alias_edges": _q(
        """SELECT target_id, count(*) AS n_citing FROM (SELECT DISTINCT coalesce(a.c, p.citing_id) AS citing_id, coalesce(b.c, p.target_id) AS target_id FROM pairs p
        LEFT JOIN (SELECT work_id, min(work_id) OVER (PARTITION BY lower(doi)) AS c FROM wrk WHERE doi IS NOT NULL) a ON a.work_id = p.citing_id LEFT JOIN (SELECT work_id, min(work_id) OVER (PARTITION BY lower(doi)) AS c FROM wrk WHERE doi IS NOT NULL) b ON b.work_id = p.target_id) GROUP BY 1"""
    ),
    "ratio_companion": _q(
        """SELECT citation_year, journal_id, a.c_raw, a.d_raw, round(a.c_raw::DOUBLE / nullif(a.d_raw, 0), 9) AS score, round(b.c_raw::DOUBLE / nullif(b.d_raw, 0), 9) AS companion_score, CASE WHEN a.w IS NULL THEN 'companion_only' WHEN b.w IS NULL THEN 'main_only' ELSE 'both' END AS row_source
        FROM (SELECT * FROM pol WHERE w = 2 AND policy = 'AR') a FULL JOIN (SELECT * FROM pol WHERE w = 5 AND policy = 'AR') b USING (citation_year, journal_id)"""
    ),
    "reporting_population": _q(
        """SELECT score_year AS citation_year, journal_id, 'existing' AS origin FROM jy WHERE score_year IN (SELECT y FROM cyears)
        UNION ALL SELECT citation_year, journal_id, 'added' FROM pol WHERE w = 2 AND policy = 'AR' AND d_raw > 0 AND (citation_year, journal_id) NOT IN (SELECT (score_year, journal_id) FROM jy)"""
    ),
    "field_modal": _q("SELECT score_year, issn_l, field, modal_works, classified_works, all_works, round(modal_share, 9) AS modal_share, round(coverage, 9) AS coverage, tied_modes FROM modal"),
    "field_top3": _q("SELECT * FROM top3"),
    "field_shares": _q(
        """SELECT score_year, issn_l, max(u) FILTER (i = 1) AS percent_1, max(u) FILTER (i = 2) AS percent_2, max(u) FILTER (i = 3) AS percent_3, max(u) FILTER (i = 4) AS percent_other FROM (
        SELECT score_year, issn_l, i, (fl + CASE WHEN row_number() OVER (PARTITION BY score_year, issn_l ORDER BY rem DESC, i) <= 1000 - sum(fl) OVER (PARTITION BY score_year, issn_l) THEN 1 ELSE 0 END) / 10.0::DOUBLE AS u FROM (
          SELECT score_year, issn_l, i, w * 1000 // classified_works AS fl, w * 1000 % classified_works AS rem FROM (SELECT score_year, issn_l, classified_works, unnest([1, 2, 3, 4]) AS i, unnest([works_1, works_2, works_3, works_other]) AS w FROM top3 WHERE classified_works > 0))) GROUP BY score_year, issn_l"""
    ),
    "field_labels": _q("SELECT score_year, issn_l, CASE WHEN modal_share BETWEEN 0 AND 1 AND field <> 'Unknown' THEN field || ' (' || printf('%.1f', 100 * round(modal_share, 6)) || '%)' ELSE field END AS label FROM modal"),
    "journal_years": _q("SELECT score_year, journal_id, title, publisher, issns, domain, field, is_open_access, register_area, register_field, in_n, in_oa, works_raw, works_filtered, citations, citations_filtered, round(coverage, 9) AS coverage, active_years FROM jy"),
    "eligibility_reasons": _q("SELECT score_year, coalesce(reason0, 'eligible') AS reason, count(*) AS n_journals FROM judged GROUP BY ALL", RANKS),
    "ecdf_percentiles": _q("SELECT score_year, journal_id, round(100.0::DOUBLE * count(*) OVER (PARTITION BY score_year ORDER BY ratio5_raw RANGE UNBOUNDED PRECEDING) / count(*) OVER (PARTITION BY score_year), 9) AS pct, count(*) OVER (PARTITION BY score_year) AS n FROM rat WHERE ratio5_raw IS NOT NULL", BASE + RATIO),
    "rank_two_stage": _q("SELECT score_year, journal_id, reason, round(field_pct, 9) AS field_pct, round(pool_pct, 9) AS pool_pct, field_count FROM ranked", RANKS),
    "rank_network": _q("SELECT score_year, journal_id, reason, round(field_pct, 9) AS field_pct, round(pool_pct, 9) AS pool_pct, field_count FROM ranked", NETWORK_RANKS),
    "rank_three_year_mean": _q(
        """SELECT a.score_year, a.journal_id, round(avg(b.field_pct), 7) AS field_mean, CASE WHEN any_value(a.pool_pct) IS NOT NULL THEN round(avg(b.pool_pct), 7) END AS pool_mean, count(b.field_pct) AS n_years
        FROM ranked a JOIN ranked b ON b.journal_id = a.journal_id AND b.score_year BETWEEN a.score_year - 2 AND a.score_year AND b.field_pct IS NOT NULL WHERE a.field_pct IS NOT NULL GROUP BY a.score_year, a.journal_id""",
        RANKS,
    ),
    "rank_summary": _q("SELECT score_year, count(field_pct) AS qualified, count(pool_pct) AS retained, count(DISTINCT grp) FILTER (field_pct IS NOT NULL) AS groups, count(*) AS n_rows FROM ranked GROUP BY 1", RANKS),
    "view_page": _q("SELECT journal_id, title, round(score, 9) AS score, round(field_pct, 9) AS field_pct FROM (SELECT * FROM ranked WHERE score_year = (SELECT max(y) FROM years) AND in_n AND any_ratio AND field_pct IS NOT NULL ORDER BY score DESC NULLS LAST, lower(coalesce(title, '')), journal_id LIMIT 25)", RANKS),
    "view_search": _q(f"SELECT score_year, journal_id, title, round(field_pct, 9) AS field_pct FROM ranked WHERE in_n AND any_ratio AND field_pct IS NOT NULL AND {_SEARCH}", RANKS),
    **{
        f"view_{name}": _q(f"SELECT score_year, count(*) AS n_journals, min(journal_id) AS first_id, max(journal_id) AS last_id FROM ranked WHERE in_n AND any_ratio AND {test} GROUP BY 1", RANKS)
        for name, test in (("total", "pool_pct IS NOT NULL"), ("both", "pool_pct IS NOT NULL"), ("unranked", "true"))
    },
    "hidden_matches": _q(f"SELECT score_year, journal_id, title, CASE WHEN NOT in_n THEN 'universe' ELSE 'percentiles' END AS reasons FROM ranked WHERE any_ratio AND {_SEARCH} AND (NOT in_n OR field_pct IS NULL)", RANKS),
    "export_lines": _q(f"SELECT score_year, journal_id, concat_ws(',', {_CSV('journal_id')}, {_CSV('title')}, {_CSV('publisher')}, {_CSV('field')}, coalesce(printf('%.1f', round(coverage, 1)), '')) AS line FROM ranked WHERE in_n AND any_ratio AND field_pct IS NOT NULL", RANKS),
    "filter_options": _q("SELECT score_year, field, count(*) AS n_journals FROM jy WHERE field <> '' GROUP BY ALL"),
    "journal_history": _q(
        "SELECT score_year, journal_id, title, round(score, 9) AS score, round(field_pct, 9) AS field_pct, round(pool_pct, 9) AS pool_pct, reason FROM ranked WHERE journal_id = (SELECT journal_id FROM jy GROUP BY 1 ORDER BY sum(citations) DESC, journal_id LIMIT 1)",
        RANKS,
    ),
    "history_shards": _q("SELECT right(journal_id, 2) AS shard, count(*) AS n_rows, count(DISTINCT journal_id) AS n_journals FROM jy GROUP BY 1"),
    "rank_sidecar": _q("SELECT score_year, 'oa' AS universe, journal_id, round(score, 9) AS score, round(field_pct, 9) AS field_pct, round(pool_pct, 9) AS pool_pct FROM ranked WHERE in_oa", RANKS),
    "frozen_or_live": _q(f"""SELECT score_year, run, state, count(*) AS n_rows, CAST(sum(a_raw) AS BIGINT) AS a_raw FROM (SELECT *, 'first' AS run, 'frozen' AS state FROM {_FIRST} WHERE score_year < (SELECT max(y) FROM years)
        UNION ALL SELECT *, 'last', 'live' FROM {_LAST} WHERE score_year = (SELECT max(y) FROM years)) GROUP BY ALL"""),
    "validate_annual": _q(
        """SELECT * FROM (VALUES ('year or id missing', (SELECT count(*) FROM jy WHERE score_year IS NULL OR journal_id IS NULL)), ('filtered above raw', (SELECT count(*) FROM jy WHERE works_filtered > works_raw)),
        ('citations filtered above raw', (SELECT count(*) FROM jy WHERE citations_filtered > citations)), ('not a count', (SELECT count(*) FROM jy WHERE works_raw IS NULL OR works_filtered IS NULL OR least(works_raw, works_filtered, citations) < 0)),
        ('coverage out of range', (SELECT count(*) FROM jy WHERE coverage < 0 OR coverage > 100)), ('coverage without works', (SELECT count(*) FROM jy WHERE coverage IS NOT NULL AND coalesce(works_raw, 0) = 0)),
        ('coverage missing though works', (SELECT count(*) FROM jy WHERE coverage IS NULL AND works_raw > 0)), ('repeated key', (SELECT coalesce(CAST(sum(c - 1) AS BIGINT), 0) FROM (SELECT count(*) AS c FROM jy GROUP BY score_year, journal_id)))) v(rule, n)"""
    ),
    "conservation": _q("SELECT score_year, stage, CAST(sum(n_raw) AS BIGINT) AS total FROM edg, (VALUES ('edges'), ('recorded and self')) s(stage) GROUP BY ALL"),
    "annual_differences": _q(
        f"""SELECT score_year, issn_l AS journal_id, CASE WHEN a.t IS NULL THEN 'only right' WHEN b.t IS NULL THEN 'only left' ELSE concat_ws(',', CASE WHEN a.a_raw IS DISTINCT FROM b.a_raw THEN 'a_raw' END, CASE WHEN a.a_filtered IS DISTINCT FROM b.a_filtered THEN 'a_filtered' END) END AS difference
        FROM (SELECT *, 1 AS t FROM cnt) a FULL JOIN (SELECT score_year, k2 AS issn_l, sum(a_raw) AS a_raw, sum(a_filtered) AS a_filtered, 1 AS t FROM {_project('wcnt', 'raw_issn_l')} WHERE {valid(bare('k2'))} GROUP BY ALL) b USING (score_year, issn_l)
        WHERE a.t IS NULL OR b.t IS NULL OR a.a_raw IS DISTINCT FROM b.a_raw OR a.a_filtered IS DISTINCT FROM b.a_filtered"""
    ),
    "journal_export_view": _q(
        "SELECT effective_key, min(source_id) AS source_id, any_value(title) AS title FROM projected WHERE raw_key = effective_key AND lower(trim(source_type)) = 'journal' GROUP BY effective_key HAVING count(*) = 1"
    ),
    "isolated_nodes": _q(
        """SELECT n.score_year, n.universe, n.treatment, n.issn_l, n.articles FROM nodes n WHERE NOT EXISTS (SELECT 1 FROM arcs x WHERE x.score_year = n.score_year AND x.universe = n.universe AND x.treatment = n.treatment AND (x.citing = n.issn_l OR x.cited = n.issn_l))"""
    ),
    "public_ratio": _q(
        """SELECT p.score_year, p.journal_id, CASE WHEN regexp_full_match(p.journal_id, '[0-9]{4}-[0-9]{3}[0-9X]') THEN p.journal_id END AS issn_l, j.title, j.publisher, j.is_open_access, coalesce(j.in_n, false) AS in_n, coalesce(j.in_oa, false) AS in_oa, p.d_raw, p.d_ref, p.c AS citations_raw, p.f AS citations_ref,
        round(100.0::DOUBLE * d_ref / nullif(d_raw, 0), 9) AS coverage, round(100 - 100.0::DOUBLE * d_ref / nullif(d_raw, 0), 9) AS without_references, round(c::DOUBLE / nullif(d_raw, 0), 9) AS ratio_raw, round(f::DOUBLE / nullif(d_ref, 0), 9) AS ratio_ref,
        CASE WHEN d_ref > 0 THEN 'defined' WHEN d_raw > 0 THEN 'ref_denominator_collapse' ELSE 'no_raw_citable_items' END AS status, field_1, field_2, field_3, works_1, works_2, works_3, works_other, r.urls AS register_urls
        FROM (SELECT citation_year AS score_year, journal_id, d_raw, d_ref, CASE WHEN citation_year >= 2024 THEN c_raw_without_retracted ELSE c_raw END AS c, CASE WHEN citation_year >= 2024 THEN c_ref_without_retracted ELSE c_ref END AS f FROM pol WHERE w = 2 AND policy = 'AR') p
        LEFT JOIN jy j ON j.score_year = p.score_year AND j.journal_id = p.journal_id LEFT JOIN top3 t ON t.score_year = p.score_year AND t.issn_l = p.journal_id
        LEFT JOIN (SELECT score_year, issn_l, string_agg('https://register.example/entry?id=' || journal_id, '; ' ORDER BY coalesce(TRY_CAST(journal_id AS BIGINT), 0), journal_id) AS urls FROM mat WHERE outcome = 'exact_issn' GROUP BY ALL) r ON r.score_year = p.score_year AND r.issn_l = p.journal_id"""
    ),
    "decision_faults": _q(
        f"""SELECT * FROM (VALUES ('work both overridden and excluded', (SELECT count(DISTINCT w.work_id) FROM wrk w JOIN decided d ON d.member = w.source_id AND d.member <> d.chosen WHERE w.is_retracted)),
        ('source in several components', (SELECT count(*) FROM (SELECT {entity('m', 'S')} AS sid FROM (SELECT {text('issn_l')} AS c, unnest(expected_component_source_ids) AS m FROM reviewed_representative WHERE lower(trim(review_status)) LIKE 'approved%') WHERE c IS NOT NULL AND {blank('m')} IS NOT NULL GROUP BY 1 HAVING count(DISTINCT c) > 1))),
        ('alias of several keys', (SELECT count(*) FROM (SELECT issn FROM alias_all GROUP BY issn HAVING count(DISTINCT effective_key) > 1))),
        ('alias that leads to an alias', (WITH al AS (SELECT DISTINCT work_id AS a, c FROM (SELECT work_id, min(work_id) OVER (PARTITION BY lower(doi)) AS c FROM wrk WHERE doi IS NOT NULL) WHERE work_id <> c) SELECT count(*) FROM al WHERE c IN (SELECT a FROM al))),
        ('denominators differ', (SELECT count(*) FROM (SELECT citation_year, journal_id, d_raw FROM pol WHERE w = 2 AND policy = 'AR' AND d_raw > 0) a FULL JOIN (SELECT y AS citation_year, journal_id, count(*) AS n FROM tgt JOIN cyears ON publication_year BETWEEN y - 2 AND y - 1 WHERE journal_id IS NOT NULL AND work_type IN ('article', 'review') GROUP BY ALL) b
          USING (citation_year, journal_id) WHERE a.d_raw IS DISTINCT FROM b.n))) v(rule, n)"""
    ),
    "handover_violations": _q(_handed(), SOLVE),
}
