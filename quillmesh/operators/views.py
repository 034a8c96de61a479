"""Display queries over ranked annual rows: filter, search, sort, page, explain and export.

Display filters choose what is seen; ranks are computed before and never change.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.operators.ranks import Selection

SEARCHED = ["journal_id", "title", "issns", "publisher", "domain", "field", "register_area", "register_field"]
PAGE = 25


def search_text() -> Column:
    return F.lower(F.concat_ws(" ", *[F.nullif(c, F.lit("")) for c in SEARCHED]))


def _matches(s: Selection) -> Column:
    q = s.query.strip().lower()
    return F.contains(search_text(), F.lit(q)) if q else F.lit(True)


def has_ratio(columns: list[str]) -> Column:
    """True if any ratio score of a row is a number."""
    numbers = [F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)) for c in columns if c.startswith("ratio") and c.rpartition("_")[2] in ("raw", "filtered")]
    return reduce(lambda a, b: a | b, numbers, F.lit(False))


def in_view(s: Selection, columns: list[str]) -> Column:
    """Members of the universe; under ratio metrics only those with any ratio score."""
    member = F.coalesce(f"in_{s.universe}", F.lit(False))
    return member if s.has_history_rule else member & has_ratio(columns)


def _percentile(s: Selection) -> Column | None:
    """The percentile that a shown row must have: the total one whenever it is among those shown."""
    return {"field": F.col("field_pct"), "total": F.col("pool_pct"), "both": F.col("pool_pct")}.get(s.percentile)


def visible(ranked: DataFrame, s: Selection) -> DataFrame:
    """Rows that the selection shows."""
    test = in_view(s, ranked.columns) & _matches(s)
    if s.fields:
        test = test & F.col("field").isin(*s.fields)
    if s.open_only:
        test = test & F.coalesce("is_open_access", F.lit(False))
    if s.pool_only and (p := _percentile(s)) is not None:
        test = test & p.isNotNull()
    return ranked.where(test)


def title_order() -> Column:
    """Case-blind order of titles, the same in every locale."""
    return F.lower(F.coalesce("title", F.lit("")))


def sorted_page(rows: DataFrame, s: Selection, by: list[str] | None = None) -> DataFrame:
    """One page; missing values last in both directions, ties by title, then by id.  Sort and limit plan as a top-k."""
    key = title_order() if s.sort_key == "title" else F.col(s.sort_key)
    first = F.desc_nulls_last(key) if s.descending else F.asc_nulls_last(key)
    ordered = rows.orderBy(*[F.col(c) for c in by or []], first, title_order(), "journal_id")
    return ordered.offset(PAGE * s.page).limit(PAGE)


def hidden_matches(ranked: DataFrame, s: Selection) -> DataFrame:
    """Rows that match the search but are not shown, with every reason; none without a search, and under ratio metrics none without a ratio score."""
    if not s.query.strip():
        return ranked.where(F.lit(False)).select("score_year", "journal_id", "title", F.lit("").alias("reasons"))
    seen = in_view(s, ranked.columns)
    reasons = [F.when(~seen, "universe")]
    if s.pool_only and (p := _percentile(s)) is not None:
        reasons.append(F.when(seen & p.isNull(), "percentiles"))
    if s.fields:
        reasons.append(F.when(~F.coalesce(F.col("field").isin(*s.fields), F.lit(False)), "fields"))
    if s.open_only:
        reasons.append(F.when(~F.coalesce("is_open_access", F.lit(False)), "access"))
    given = F.filter(F.array(*reasons), lambda x: x.isNotNull())
    known = F.lit(True) if s.has_history_rule else has_ratio(ranked.columns)
    return ranked.where(_matches(s) & known).withColumn("given", given).where(F.size("given") > 0).select("score_year", "journal_id", "title", F.array_join("given", ",").alias("reasons"))


def guarded_text(value: Column) -> Column:
    """CSV cell text: text that a spreadsheet would read as a formula gets a quote mark in front; quotes double."""
    safe = F.when(value.rlike(r"^[=+@\-\t\r]"), F.concat(F.lit("'"), value)).otherwise(value)
    return F.coalesce(F.concat(F.lit('"'), F.regexp_replace(safe, '"', '""'), F.lit('"')), F.lit(""))


def export_lines(rows: DataFrame, texts: list[str], numbers: dict[str, int]) -> DataFrame:
    """(score_year, journal_id, line) of a CSV export: texts quoted and guarded, numbers rounded to their decimals, missing values empty."""
    cells = [guarded_text(F.col(c)) for c in texts] + [F.when(F.col(c).isNotNull(), F.format_string(f"%.{n}f", F.round(F.col(c), n))).otherwise(F.lit("")) for c, n in numbers.items()]
    return rows.select("score_year", "journal_id", F.concat_ws(",", *cells).alias("line"))


def filter_options(rows: DataFrame) -> DataFrame:
    """Values for filter lists: every year and field with the number of journals."""
    return rows.where("field IS NOT NULL AND field <> ''").groupBy("score_year", "field").agg(F.count("*").alias("n_journals"))


def history(ranked: DataFrame, journal_id: Column) -> DataFrame:
    """All years of one journal with its annual ranks; on sharded storage the shard and the id prune the scan."""
    return ranked.where(F.col("journal_id") == journal_id).select("score_year", "journal_id", "title", "score", "field_pct", "pool_pct", "reason")
