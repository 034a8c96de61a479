"""SQL twins of the general problems' queries, in the dialect of DuckDB."""

from __future__ import annotations


def entity(x: str, letter: str) -> str:
    digits = f"regexp_extract({x}, '(?i){letter}[^0-9A-Za-z]*([0-9]+)', 1)"
    return f"CASE WHEN length({digits}) > 0 THEN '{letter}' || {digits} ELSE nullif(trim({x}), '') END"


def issn(x: str) -> str:
    return f"nullif(upper(regexp_replace({x}, '[^0-9A-Za-z]', '', 'g')), '')"


def dashed(k: str) -> str:
    return f"CASE WHEN length({k}) = 8 THEN substr({k}, 1, 4) || '-' || substr({k}, 5, 4) ELSE {k} END"


P2 = f"""
WITH s AS (
  SELECT snapshot_date, {entity('source_id', 'S')} AS source_id, {issn('raw_issn_l')} AS a, source_type AS b, title AS c, publisher AS e,
         array_to_string(list_sort(list_distinct(list_filter(list_transform(coalesce(issns, []), lambda x: {issn('x')}), lambda x: x IS NOT NULL))), ',') AS f,
         oa_field AS g, oa_domain AS h, is_open_access AS i, updated_date, loaded_at
  FROM source_rows WHERE nullif(trim(source_id), '') IS NOT NULL AND snapshot_date IS NOT NULL
), state AS (
  SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY snapshot_date, source_id ORDER BY updated_date DESC NULLS LAST, loaded_at DESC NULLS LAST) = 1
), dates AS (SELECT snapshot_date, lag(snapshot_date) OVER (ORDER BY snapshot_date) AS before FROM (SELECT DISTINCT snapshot_date FROM s)
), pairs AS (
  SELECT d.snapshot_date, n.source_id, 'added' AS change_type FROM dates d JOIN state n ON n.snapshot_date = d.snapshot_date
  WHERE d.before IS NOT NULL AND NOT EXISTS (SELECT 1 FROM state o WHERE o.snapshot_date = d.before AND o.source_id = n.source_id)
  UNION ALL
  SELECT d.snapshot_date, o.source_id, 'removed' FROM dates d JOIN state o ON o.snapshot_date = d.before
  WHERE NOT EXISTS (SELECT 1 FROM state n WHERE n.snapshot_date = d.snapshot_date AND n.source_id = o.source_id)
  UNION ALL
  SELECT d.snapshot_date, o.source_id, 'changed' FROM dates d JOIN state o ON o.snapshot_date = d.before
  JOIN state n ON n.snapshot_date = d.snapshot_date AND n.source_id = o.source_id
  WHERE (o.a, o.b, o.c, o.e, o.f, o.g, o.h, o.i) IS DISTINCT FROM (n.a, n.b, n.c, n.e, n.f, n.g, n.h, n.i)
)"""

P3 = f"""
WITH refs AS (
  SELECT publication_year AS period, {entity('work_id', 'W')} AS child_key, arrived_at, unnest("references") AS r FROM citing
), child AS (SELECT DISTINCT period, child_key, arrived_at, {entity('r', 'W')} AS k FROM refs WHERE nullif(trim(r), '') IS NOT NULL
), parent AS (SELECT {entity('work_id', 'W')} AS k, arrived_at, deleted_at FROM targets
), edge AS (SELECT DISTINCT score_year, {issn('citing_issn_l')} AS a, {issn('cited_issn_l')} AS b FROM effective_edges
), cnt AS (SELECT DISTINCT score_year, {issn('issn_l')} AS k FROM effective_counts
), found AS (
  SELECT DISTINCT 'citing' AS ref_table, period, child_key, k AS missing_key FROM child c
  WHERE NOT EXISTS (SELECT 1 FROM parent p WHERE p.k = c.k AND p.arrived_at <= c.arrived_at AND (p.deleted_at IS NULL OR p.deleted_at > c.arrived_at))
  UNION ALL
  SELECT 'effective_edges', score_year, {dashed('a')}, {dashed('b')} FROM edge e
  WHERE b IS NOT NULL AND NOT EXISTS (SELECT 1 FROM cnt WHERE cnt.k = e.b AND cnt.score_year = e.score_year)
)"""


def _camel(name: str) -> str:
    head, *rest = name.split("_")
    return head + "".join(x.title() for x in rest)


def _get(doc: str, name: str) -> str:
    return f"CASE WHEN coalesce(json_type({doc}, '$.{name}'), 'NULL') <> 'NULL' THEN json_extract({doc}, '$.{name}') ELSE json_extract({doc}, '$.{_camel(name)}') END"


def _elements(v: str) -> str:
    """List of JSON elements of an array, of a single value or of text that lists ids."""
    text = f"({v} ->> '$')"
    return f"""CASE json_type({v}) WHEN 'ARRAY' THEN json_extract({v}, '$[*]') WHEN 'OBJECT' THEN [{v}]
      WHEN 'VARCHAR' THEN CASE WHEN trim({text}) = '' THEN NULL ELSE list_transform(regexp_split_to_array({text}, '[;|,]'), lambda x: to_json(trim(x))) END END"""


P4 = f"""
WITH raw AS (SELECT record_id, CAST(payload AS JSON) AS j FROM raw_works WHERE json_valid(payload) AND json_type(payload) = 'OBJECT'
), part AS (
  SELECT record_id, {_get('j', 'primary_location')} AS p, {_get('j', 'locations')} AS l, {_get('j', 'referenced_works')} AS r FROM raw
), lists AS (SELECT record_id, ({_elements('p')})[1] AS p, {_elements('l')} AS l, {_elements('r')} AS r FROM part
), loc AS (SELECT record_id, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS x FROM lists
), loc2 AS (SELECT record_id, pos, x, CASE json_type(x, '$.source') WHEN 'OBJECT' THEN x ->> '$.source.id' ELSE x ->> '$.source' END AS sid, json_extract(x, '$.source.issn') AS issns
            FROM loc WHERE coalesce(json_type(x), 'NULL') <> 'NULL'
), iss AS (SELECT record_id, pos AS parent_pos, generate_subscripts(e, 1) - 1 AS pos, unnest(e) AS x FROM (SELECT record_id, pos, {_elements('issns')} AS e FROM loc2)
), ref AS (SELECT record_id, generate_subscripts(r, 1) - 1 AS pos, unnest(r) AS x FROM lists
), ref2 AS (SELECT record_id, pos, CASE json_type(x) WHEN 'OBJECT' THEN coalesce(x ->> '$.id', x ->> '$.work.id') ELSE x ->> '$' END AS k FROM ref
), floc AS (SELECT record_id, generate_subscripts(locations, 1) - 1 AS pos, unnest(locations) AS x FROM fixture
), fiss AS (SELECT record_id, pos AS parent_pos, generate_subscripts(x.source.issn, 1) - 1 AS pos, unnest(x.source.issn) AS k FROM floc
), fref AS (SELECT record_id, generate_subscripts(referenced_works, 1) - 1 AS pos, unnest(referenced_works) AS k FROM fixture
), child AS (
  SELECT record_id, 'primary_source' AS child, -1 AS parent_pos, 0 AS pos, primary_location.source.id AS k, 'S' AS kind FROM fixture
  UNION ALL SELECT record_id, 'primary_source', -1, 0, CASE json_type(p, '$.source') WHEN 'OBJECT' THEN p ->> '$.source.id' ELSE p ->> '$.source' END, 'S' FROM lists
  UNION ALL SELECT record_id, 'location', -1, pos, coalesce(x.source.id, ''), 'L' FROM floc WHERE x IS NOT NULL
  UNION ALL SELECT record_id, 'location', -1, pos, coalesce(sid, ''), 'L' FROM loc2
  UNION ALL SELECT record_id, 'location_issn', parent_pos, pos, k, 'I' FROM fiss
  UNION ALL SELECT record_id, 'location_issn', parent_pos, pos, x ->> '$', 'I' FROM iss
  UNION ALL SELECT record_id, 'reference', -1, pos, k, 'W' FROM fref
  UNION ALL SELECT record_id, 'reference', -1, pos, k, 'W' FROM ref2
), found AS (
  SELECT record_id, child, CAST(parent_pos AS INTEGER) AS parent_pos, CAST(pos AS INTEGER) AS pos,
    CASE kind WHEN 'I' THEN k WHEN 'W' THEN {entity('k', 'W')} ELSE coalesce({entity('k', 'S')}, '') END AS child_key
  FROM child WHERE nullif(trim(k), '') IS NOT NULL OR kind = 'L'
)"""

P6 = f"""
WITH e AS (SELECT 'cited' AS side, {issn('cited_issn_l')} AS k, n_raw, n_filtered FROM effective_edges
  UNION ALL SELECT 'citing', {issn('citing_issn_l')}, n_raw, n_filtered FROM effective_edges)"""


def _dist(v: str) -> str:
    return f"""d_{v} AS (SELECT side, k, count(*) AS distinct_{v}, list({v} ORDER BY f DESC, {v})[1] AS mode_{v} FROM (SELECT side, k, {v}, count(*) AS f FROM e WHERE k IS NOT NULL AND {v} IS NOT NULL GROUP BY ALL) GROUP BY side, k)"""


ORACLES: dict[str, str] = {
    "p2_found": P2 + " SELECT snapshot_date, source_id, change_type FROM pairs",
    "p2_counts": P2 + " SELECT snapshot_date, change_type, count(*) AS n_sources FROM pairs GROUP BY ALL",
    "p3_found": P3 + " SELECT ref_table, period, child_key, missing_key FROM found",
    "p3_report": P3 + " SELECT ref_table, period, count(*) AS n_references, count(DISTINCT missing_key) AS n_missing_keys, count(DISTINCT child_key) AS n_children FROM found GROUP BY ALL",
    "p4_found": P4 + " SELECT * FROM found",
    "p4_children": P4 + " SELECT child, count(*) AS n_rows, count(DISTINCT record_id) AS n_records FROM found GROUP BY child",
    "p6_found": P6 + f" SELECT side, {dashed('k')} AS issn_l FROM e GROUP BY side, k HAVING k IS NOT NULL AND count(*) * 100 >= 3 * (SELECT count(*) FROM effective_edges)",
    "p6_profile": P6
    + f""", {_dist('n_raw')}, {_dist('n_filtered')}
  SELECT t.side, {dashed('t.k')} AS issn_l, n_rows, total_n_raw, total_n_filtered, distinct_n_raw, mode_n_raw, p50_n_raw, p90_n_raw, distinct_n_filtered, mode_n_filtered, p50_n_filtered, p90_n_filtered
  FROM (SELECT side, k, count(*) AS n_rows, CAST(sum(n_raw) AS BIGINT) AS total_n_raw, CAST(sum(n_filtered) AS BIGINT) AS total_n_filtered, quantile_disc(n_raw, 0.5) AS p50_n_raw, quantile_disc(n_raw, 0.9) AS p90_n_raw,
          quantile_disc(n_filtered, 0.5) AS p50_n_filtered, quantile_disc(n_filtered, 0.9) AS p90_n_filtered FROM e WHERE k IS NOT NULL GROUP BY side, k) t
  LEFT JOIN d_n_raw a ON a.side = t.side AND a.k = t.k LEFT JOIN d_n_filtered b ON b.side = t.side AND b.k = t.k""",
}
