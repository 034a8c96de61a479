"""SQL twins of the queries of the text and matching problems that SQL can express (dialect of DuckDB)."""

from __future__ import annotations

from quillmesh.plans.general_oracles import dashed, entity, issn

_PLACEHOLDER = """('missing','na','nil','none','noname','nopublisher','notapplicable','notavailable','notgiven','notitle','notknown','notspecified','null','placeholder',
 'publishernotgiven','publisherunknown','publishernotknown','sn','tba','tbd','test','testrecord','titlenotgiven','titleunknown','undefined','unknown','unknownpublisher','unknowntitle','unspecified','untitled','xxx')"""


def _usable(x: str) -> str:
    bare = rf"lower(regexp_replace({x}, '[^\p{{L}}\p{{N}}]', '', 'g'))"
    return f"coalesce({bare} <> '' AND {bare} NOT IN {_PLACEHOLDER}, false)"


def _valid(k: str) -> str:
    weights = " + ".join(f"(ascii(substr({k}, {i}, 1)) - 48) * {9 - i}" for i in range(1, 8))
    last = f"CASE WHEN substr({k}, 8, 1) = 'X' THEN 10 ELSE ascii(substr({k}, 8, 1)) - 48 END"
    return f"coalesce(regexp_full_match({k}, '[0-9]{{7}}[0-9X]') AND ({weights} + {last}) % 11 = 0, false)"


P5 = f"""
WITH snap AS (SELECT max(snapshot_date) AS d FROM source_rows
), state AS (
  SELECT *, {entity('source_id', 'S')} AS sid, {issn('raw_issn_l')} AS k FROM source_rows, snap WHERE snapshot_date = d AND nullif(trim(source_id), '') IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY sid ORDER BY updated_date DESC NULLS LAST, loaded_at DESC NULLS LAST) = 1
), grp AS (SELECT *, {dashed(issn('issn_l'))} AS g FROM reviewed_representative
), member AS (SELECT DISTINCT g, {entity('m', 'S')} AS sid FROM (SELECT g, unnest(list_append(coalesce(expected_component_source_ids, []), source_id)) AS m FROM grp) WHERE nullif(trim(m), '') IS NOT NULL
), ok AS (
  SELECT g, m.sid, lower(trim(source_type)) = 'journal' AS journal, {_usable('publisher')} AS pub, updated_date, CAST(substr(m.sid, 2) AS BIGINT) AS num,
    CAST({_usable('title')} AS INT) + CAST({_usable('publisher')} AS INT) + CAST({_valid('k')} AS INT) + CAST({_usable('oa_field')} AS INT)
    + CAST(len(list_filter(coalesce(issns, []), lambda x: {issn('x')} IS NOT NULL)) > 0 AS INT) + CAST(is_open_access IS NOT NULL AS INT) AS n
  FROM member m JOIN state s ON s.sid = m.sid
), decided AS (
  SELECT g, arg_max({entity('canonical_source_id', 'S')}, score_year) AS c FROM grp WHERE lower(trim(review_status)) LIKE 'approved%' AND nullif(trim(canonical_source_id), '') IS NOT NULL GROUP BY g
), canon AS (
  SELECT o.g, coalesce(any_value(d.c), list(sid ORDER BY coalesce(journal, false) DESC, n DESC, updated_date DESC, num)[1]) AS c FROM ok o LEFT JOIN decided d ON d.g = o.g GROUP BY o.g
), pub AS (
  SELECT o.g, list(sid ORDER BY (sid = c) DESC, updated_date DESC, num)[1] AS p FROM ok o JOIN canon c ON c.g = o.g WHERE pub GROUP BY o.g
)
SELECT canon.g AS issn_l, canon.c AS canonical_source_id, coalesce(pub.p, '') AS publisher_source_id FROM canon LEFT JOIN pub ON pub.g = canon.g"""

ORACLES: dict[str, str] = {"p5_found": P5}
