"""The annual register: members, exact matching by ISSN, grouping and display entries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.functions.ids import blank_to_null, issn_text, valid_issn


def roster(register: DataFrame) -> DataFrame:
    """Members by score year: level 1 or 2 and not ceased before that year; a journal entered twice counts once, with its highest level."""
    alive = F.col("norwegian_level").isin(1, 2) & (F.col("ceased_year").isNull() | (F.col("ceased_year") >= F.col("score_year")))
    rows = register.where(alive & blank_to_null("journal_id").isNotNull()).select("score_year", blank_to_null("journal_id").alias("journal_id"), "norwegian_level", "print_issn", "online_issn")
    return rows.groupBy("score_year", "journal_id").agg(
        F.max("norwegian_level").alias("level"),
        F.array_sort(F.array_compact(F.array_union(F.collect_set(valid_issn("print_issn")), F.collect_set(valid_issn("online_issn"))))).alias("issns"),
    )


def unpivot_levels(wide: DataFrame, ids: list[str], prefix: str = "Level ") -> DataFrame:
    """Long form (ids..., score_year, level) of a register with one level column per year; empty levels drop."""
    years = [c for c in wide.columns if c.startswith(prefix)]
    long = wide.unpivot(ids, years, "year_column", "level_text")
    return long.select(*ids, F.expr(f"try_cast(substr(year_column, {len(prefix) + 1}) as int)").alias("score_year"), F.col("level_text").try_cast("int").alias("level")).where("level IS NOT NULL")


# Outcomes of matching by ISSN.
NO_ISSN, NO_MATCH, MATCH, SEVERAL = "missing_register_issns", "no_exact_issn_match", "exact_issn", "ambiguous_exact_issn_match"
REVIEWED, REVIEWED_NONE, CONFLICTING = "reviewed_match", "reviewed_no_match", "conflicting_decisions"


def with_decisions(matched: DataFrame, decisions: DataFrame) -> DataFrame:
    """Matches with reviewed decisions in place of what the ISSNs say: (score_year, journal_id, issn_l), null for a reviewed non-match.

    A decision for an entry that is not there changes nothing; two different decisions for one entry are an error of the
    decision table and leave the entry in the queue.
    """
    ids = ["score_year", "journal_id"]
    each = decisions.groupBy(*ids).agg(F.count_distinct(F.coalesce("issn_l", F.lit(""))).alias("__n"), F.max("issn_l").alias("__key"))
    out = matched.join(each, ids, "left")
    one, torn = F.coalesce(F.col("__n") == 1, F.lit(False)), F.coalesce(F.col("__n") > 1, F.lit(False))
    outcome = F.when(torn, CONFLICTING).when(one & F.col("__key").isNull(), REVIEWED_NONE).when(one, REVIEWED).otherwise(F.col("outcome"))
    return out.withColumns({"issn_l": F.when(torn, F.lit(None)).when(one, F.col("__key")).otherwise(F.col("issn_l")), "outcome": outcome}).drop("__n", "__key")


def match_by_issn(members: DataFrame, aliases: DataFrame) -> DataFrame:
    """(score_year, journal_id, level, n_targets, issn_l, outcome): exactly one effective key is a match, none or several go to the queue.

    ``aliases`` is (issn, effective_key), every ISSN a source is known by.
    """
    ids = ["score_year", "journal_id"]
    wanted = members.select(*ids, F.explode("issns").alias("issn"))
    hits = wanted.join(aliases.distinct(), "issn").select(*ids, "effective_key").distinct()
    per = hits.groupBy(*ids).agg(F.count("*").alias("n_targets"), F.min("effective_key").alias("only"), F.array_join(F.array_sort(F.collect_set("effective_key")), "|").alias("candidates"))
    out = members.join(per, ids, "left").withColumn("n_targets", F.coalesce("n_targets", F.lit(0)))
    outcome = F.when(F.size("issns") == 0, NO_ISSN).when(F.col("n_targets") == 0, NO_MATCH).when(F.col("n_targets") == 1, MATCH).otherwise(SEVERAL)
    return out.select(*ids, "level", "n_targets", F.when(F.col("n_targets") == 1, F.col("only")).alias("issn_l"), F.coalesce("candidates", F.lit("")).alias("candidates"), outcome.alias("outcome"))


def grouped_members(matched: DataFrame) -> DataFrame:
    """Per year and key: register ids in numerical order, how many, and the highest level."""
    number = F.coalesce(F.col("journal_id").try_cast("bigint"), F.lit(0))
    rows = matched.where(F.col("outcome") == MATCH).groupBy("score_year", "issn_l").agg(F.array_sort(F.collect_set(F.struct(number.alias("n"), "journal_id"))).alias("ids"), F.max("level").alias("level"))
    return rows.select("score_year", "issn_l", F.array_join(F.transform("ids", lambda x: x["journal_id"]), " | ").alias("journal_ids"), F.size("ids").cast("long").alias("n_journals"), "level")


REGISTER_URL = "https://register.example/entry?id="


def entry_url(journal_id: Column | str) -> Column:
    return F.concat(F.lit(REGISTER_URL), journal_id)


def ids_of_urls(urls: Column) -> Column:
    """Numeric ids of a semicolon-separated list of register URLs, without repeats; foreign hosts and odd ids drop."""
    each = F.transform(F.split(F.coalesce(urls, F.lit("")), ";"), lambda u: F.regexp_extract(F.trim(u), r"^https?://register\.example/entry\?(?:[^#]*&)?id=([0-9]+)(?:[&#]|$)", 1))
    return F.array_distinct(F.filter(each, lambda x: x != ""))


def level_text(levels: Column) -> Column:
    """The level in delimited text: one of 1 and 2, both as ``1, 2`` in order of appearance, or null."""
    found = F.array_distinct(F.filter(F.transform(F.split(levels, r"[|;,]"), lambda x: F.trim(x)), lambda x: x.isin("1", "2")))
    return F.when(F.size(found) > 0, F.array_join(found, ", "))


def display_entries(members: DataFrame, titles: DataFrame) -> DataFrame:
    """Register entries of a journal as JSON text, ordered by id, for each year and key.

    ``titles`` is (score_year, journal_id, title, print_issn, online_issn); each entry keeps its ISSNs as dashed text.
    """
    each = titles.join(members.where(F.col("outcome") == MATCH).select("score_year", "journal_id", "issn_l"), ["score_year", "journal_id"])
    entry = F.struct(F.coalesce(F.col("journal_id").try_cast("bigint"), F.lit(0)).alias("n"), F.struct(F.col("journal_id").alias("id"), "title", issn_text("print_issn").alias("print"), issn_text("online_issn").alias("online")).alias("e"))
    rows = each.groupBy("score_year", "issn_l").agg(F.array_sort(F.collect_set(entry)).alias("x"))
    return rows.select("score_year", "issn_l", F.size("x").cast("long").alias("n_entries"), F.to_json(F.transform("x", lambda r: r["e"])).alias("entries_json"))


def areas(matched: DataFrame, register: DataFrame) -> DataFrame:
    """(score_year, issn_l, register_area, register_field): disciplines and fields of the register entries of a journal, in order."""
    said = register.select("score_year", blank_to_null("journal_id").alias("journal_id"), "discipline", "field")
    met = matched.where(F.col("outcome") == MATCH).select("score_year", "journal_id", "issn_l").join(said, ["score_year", "journal_id"])
    joined = lambda c: F.nullif(F.array_join(F.array_sort(F.collect_set(c)), " | "), F.lit(""))
    return met.groupBy("score_year", "issn_l").agg(joined("discipline").alias("register_area"), joined("field").alias("register_field"))


def title_key(title: Column | str) -> Column:
    """Letters and digits of a title in lower case, compatibility forms (full-width letters, ligatures) as plain ones."""
    text = F.col(title) if isinstance(title, str) else title
    return F.lower(F.regexp_replace(plain_forms(text), r"[^\p{L}\p{N}]", ""))


def plain_forms(text: Column) -> Column:
    """Full-width Latin letters and digits, typographic ligatures and the long s as plain letters, from the code charts."""
    wide = "".join(chr(0xFEE0 + c) for c in range(0x21, 0x7F))
    out = F.translate(text, wide + "\u017f\u3000", "".join(map(chr, range(0x21, 0x7F))) + "s ")
    for code, letters in zip(range(0xFB00, 0xFB07), ("ff", "fi", "fl", "ffi", "ffl", "st", "st"), strict=True):
        out = F.replace(out, F.lit(chr(code)), F.lit(letters))
    return out


def primary_by_title(candidates: DataFrame, wanted: DataFrame, years: bool = False) -> DataFrame:
    """The register id whose title is the journal's, where exactly one is; ``candidates`` (issn_l, journal_id, title), ``wanted`` (issn_l, title).

    An id may come with several titles, one row each.  With ``years``, candidates also have score_year, and every year is decided by itself.
    """
    by = ["score_year", "issn_l"] if years else ["issn_l"]
    a = candidates.select(*by, "journal_id", title_key("title").alias("t")).where("t <> ''").distinct()
    b = wanted.select("issn_l", title_key("title").alias("t")).where("t <> ''").distinct()
    return a.join(b, ["issn_l", "t"]).groupBy(*by).agg(F.count_distinct("journal_id").alias("n"), F.min("journal_id").alias("journal_id")).where("n = 1").select(*by, "journal_id")


def aliases_of_sources(sources: DataFrame) -> DataFrame:
    """(issn, effective_key): every valid ISSN a source lists, and its own key."""
    listed = F.array_append(F.coalesce("issns", F.array().cast("array<string>")), F.col("raw_issn_l"))
    return sources.where("effective_key IS NOT NULL").select("effective_key", F.explode(listed).alias("x")).select(valid_issn("x").alias("issn"), "effective_key").where("issn IS NOT NULL").distinct()

