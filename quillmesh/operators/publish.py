"""Annual tables: assembly, shards, sidecars, frozen and live years, validation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.operators.ranks import YEAR_AND_ID


def wide_scores(scores: DataFrame) -> DataFrame:
    """One row per year and key with ``share_<universe>_<treatment>`` and ``per_article_<universe>_<treatment>``; the cells are known, so no value scan is needed."""
    cells = [f"{u}_{t}" for u in ("n", "oa") for t in ("raw", "filtered")]
    named = scores.withColumn("cell", F.concat_ws("_", "universe", "treatment"))
    wide = named.groupBy("score_year", "issn_l").pivot("cell", cells).agg(F.first("share").alias("share"), F.first("per_article").alias("per_article"))
    return wide.select("score_year", "issn_l", *[F.col(f"{c}_{m}").alias(f"{m}_{c}") for m in ("share", "per_article") for c in cells])


def annual_table(journal_years: DataFrame, scores: DataFrame, used: DataFrame, modal: DataFrame, register: DataFrame) -> DataFrame:
    """The wide annual table: every journal with at least one defined score, its counts, scores, field, used citations and register ids.

    Used citations are null outside a universe and 0 for members without any; scores keep null for undefined.
    """
    wide = wide_scores(scores)
    some = None
    for c in wide.columns[2:]:
        some = F.col(c).isNotNull() if some is None else some | F.col(c).isNotNull()
    per = used.groupBy("score_year", "issn_l").agg(*[F.max(F.when(F.col("universe") == u, F.col(f"used_{t}"))).alias(f"used_{u}_{t}") for u in ("n", "oa") for t in ("raw", "filtered")])
    out = journal_years.join(wide.where(some).withColumnRenamed("issn_l", "journal_id"), YEAR_AND_ID)
    out = out.join(per.withColumnRenamed("issn_l", "journal_id"), YEAR_AND_ID, "left")
    out = out.join(modal.select("score_year", F.col("issn_l").alias("journal_id"), F.col("field").alias("modal_field"), "modal_works", "classified_works"), YEAR_AND_ID, "left")
    return out.join(register.select("score_year", F.col("issn_l").alias("journal_id"), "journal_ids", "level"), YEAR_AND_ID, "left")


def joined_once(left: DataFrame, right: DataFrame, keys: list[str], how: str = "left", both: bool = False) -> DataFrame:
    """A join whose right side has every key once (with ``both``, the left side as well); anything else is an error and no result.

    The check is a grouping that combines map-side, of which only whether it is empty reaches the driver.
    """
    for name, side in (("right", right), *((("left", left),) if both else ())):
        if not side.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").isEmpty():
            raise ValueError(f"the {name} side repeats a key of {', '.join(keys)}")
    return left.join(right, keys, how)


def index_document(rows: DataFrame, runs: dict[int, str], frozen: set[int], universes: list[str]) -> dict:
    """What a reader needs to find the tables: a few counts for each year and how it was chosen."""
    counted = {r.score_year: r.n for r in rows.groupBy("score_year").agg(F.count("*").alias("n")).collect()}
    years = [{"year": y, "run": runs[y], "state": "frozen" if y in frozen else "live", "rows": counted.get(y, 0)} for y in sorted(runs, reverse=True)]
    return {"years": years, "universes": universes, "fields": sorted(r.field for r in rows.where("field IS NOT NULL").select("field").distinct().collect())}


def shard_of(journal_id: Column | str) -> Column:
    """History shard: the last two characters of the id."""
    return F.right(F.col(journal_id) if isinstance(journal_id, str) else journal_id, F.lit(2))


def rank_sidecar(ranked: DataFrame, universe: str) -> DataFrame:
    """Narrow rows of a universe's members for quick rank look-up."""
    return ranked.where(F.coalesce(f"in_{universe}", F.lit(False))).select("score_year", F.lit(universe).alias("universe"), "journal_id", "score", "field_pct", "pool_pct")


def frozen_or_live(runs: dict[str, DataFrame], frozen: dict[int, str], live: str) -> DataFrame:
    """Rows of every year from the run it is pinned to, else from the live run."""
    parts = []
    for name, run in runs.items():
        pinned = [y for y, r in frozen.items() if r == name]
        keep = F.col("score_year").isin(*pinned) if pinned else F.lit(False)
        if name == live:
            keep = keep | ~F.col("score_year").isin(*frozen) if frozen else F.lit(True)
        parts.append(run.where(keep).withColumns({"run": F.lit(name), "state": F.when(F.col("score_year").isin(*frozen), "frozen").otherwise("live") if frozen else F.lit("live")}))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def violations(rows: DataFrame, rules: dict[str, Column], unique: list[str] | None = None) -> DataFrame:
    """(rule, n): rows that break each rule, all in one pass; duplicates of ``unique`` are counted as a rule of their own."""
    one = rows.agg(*[F.count_if(F.coalesce(v, F.lit(False))).alias(k) for k, v in rules.items()])
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), F.col(k).alias("n")) for k in rules]))
    out = one.select(pairs.alias("x")).select("x.rule", "x.n")
    if unique:
        repeats = rows.groupBy(*unique).agg(F.count("*").alias("c")).agg(F.coalesce(F.sum(F.col("c") - 1), F.lit(0)).alias("n"))
        out = out.unionByName(repeats.select(F.lit("repeated key").alias("rule"), "n"))
    return out


def require_none(found: DataFrame) -> None:
    """Raise if any rule is broken; only the rules reach the driver."""
    broken = [(r.rule, r.n) for r in found.where("n > 0").collect()]
    if broken:
        raise ValueError("broken rules: " + ", ".join(f"{r} ({n})" for r, n in broken))


def _not_whole(name: str) -> Column:
    """True for a missing, negative or fractional count."""
    return F.col(name).isNull() | (F.col(name) < 0) | (F.col(name) != F.floor(name))


def _not_finite(name: str) -> Column:
    return F.isnan(name) | (F.abs(name) == float("inf"))


def annual_rules() -> dict[str, Column]:
    """What must never hold in an annual table: zero stands for a known nothing, null for unknown."""
    return {
        "year or id missing": F.col("score_year").isNull() | F.col("journal_id").isNull() | (F.trim("journal_id") == ""),
        "filtered above raw": F.col("works_filtered") > F.col("works_raw"),
        "citations filtered above raw": F.col("citations_filtered") > F.col("citations"),
        "not a count": _not_whole("works_raw") | _not_whole("works_filtered") | _not_whole("citations"),
        "coverage out of range": (F.col("coverage") < 0) | (F.col("coverage") > 100) | _not_finite("coverage"),
        "coverage without works": F.col("coverage").isNotNull() & (F.coalesce("works_raw", F.lit(0)) == 0),
        "coverage missing though works": F.col("coverage").isNull() & (F.col("works_raw") > 0),
    }


#: Cells of the wide scores.
CELLS = [(u, t) for u in ("n", "oa") for t in ("raw", "filtered")]
#: Largest deviation of a sum or percentage from what it must be.
CLOSE = 1e-8


def handover_frame(journal_years: DataFrame, scores: DataFrame, register: DataFrame, window: int = 5) -> DataFrame:
    """The rows that are handed over: journal years with a score, their window, counts, scores and register entries."""
    wide = wide_scores(scores).withColumnRenamed("issn_l", "journal_id")
    entries = register.select("score_year", F.col("issn_l").alias("journal_id"), F.col("journal_ids").alias("register_ids"), F.col("level").alias("register_level"))
    out = journal_years.drop("in_n", "in_oa").join(wide, YEAR_AND_ID).join(entries, YEAR_AND_ID, "left")
    return out.withColumns({"window_start": F.col("score_year") - window, "window_end": F.col("score_year") - 1})


def handover_rules(window: int = 5) -> dict[str, Column]:
    """What a row must not be; ``member`` is the register membership of another source."""
    scores = [f"{m}_{u}_{t}" for m in ("share", "per_article") for u, t in CELLS]
    some = lambda tests: reduce(lambda a, b: a | b, [F.coalesce(t, F.lit(False)) for t in tests])
    rules = {
        "year or id missing": F.col("score_year").isNull() | F.col("journal_id").isNull() | (F.trim("journal_id") == ""),
        "another window": ~((F.col("window_start") == F.col("score_year") - window) & (F.col("window_end") == F.col("score_year") - 1)),
        "not a count": some([_not_whole(c) for c in ("works_raw", "works_filtered", "citations", "citations_filtered", "active_years")]),
        "filtered above raw": (F.col("works_filtered") > F.col("works_raw")) | (F.col("citations_filtered") > F.col("citations")),
        "more active years than the window": F.col("active_years") > window,
        "coverage and works disagree": (F.col("works_raw") > 0) != F.col("coverage").isNotNull(),
        "coverage is not the share": F.abs(F.col("coverage") - 100 * F.col("works_filtered") / F.col("works_raw")) > CLOSE,
        "score not a number": some([_not_finite(c) for c in scores]),
        "negative score": some([F.col(c) < 0 for c in scores]),
        "share above 100": some([F.col(f"share_{u}_{t}") > 100 + CLOSE for u, t in CELLS]),
        "no score at all": ~some([F.col(c).isNotNull() for c in scores]),
        "per article without share": some([F.col(f"share_{u}_{t}").isNull() & F.col(f"per_article_{u}_{t}").isNotNull() for u, t in CELLS]),
        "per article without articles": some([(F.col(f"works_{t}") == 0) & F.col(f"per_article_{u}_{t}").isNotNull() for u, t in CELLS]),
        "per article missing": some([F.col(f"share_{u}_{t}").isNotNull() & (F.col(f"works_{t}") > 0) & F.col(f"per_article_{u}_{t}").isNull() for u, t in CELLS]),
        "uncited but not zero": some([(F.col(f"share_{u}_{t}") == 0) & (F.col(f"per_article_{u}_{t}") != 0) for u, t in CELLS]),
        "member without register entry": F.col("member") & F.col("register_ids").isNull(),
        "register entry of no member": ~F.col("member") & F.col("register_ids").isNotNull(),
        "member without level": F.col("member") & F.col("register_level").isNull(),
        "level of no member": ~F.col("member") & F.col("register_level").isNotNull(),
        "odd register id": ~F.forall(F.split("register_ids", r" \| "), lambda x: x.rlike("^[0-9]+$")),
        "register score of no member": ~F.col("member") & some([F.col(f"{m}_n_{t}").isNotNull() for m in ("share", "per_article") for t in ("raw", "filtered")]),
    }
    return rules


def handover_violations(frame: DataFrame, scores: DataFrame, members: DataFrame) -> DataFrame:
    """(rule, n) over the rows handed over, their keys and the full states behind them; every n must be 0.

    ``members`` is (score_year, journal_id) of the register; ``scores`` the scores of all states in long form.
    """
    known = members.select(*YEAR_AND_ID).distinct().withColumn("member", F.lit(True))
    judged = frame.join(known, YEAR_AND_ID, "left").withColumn("member", F.coalesce("member", F.lit(False)))
    rows = violations(judged, handover_rules(), YEAR_AND_ID)
    sums = scores.groupBy("score_year", "universe", "treatment").agg(F.sum("share").alias("total"))
    off = sums.agg(F.count_if(F.abs(F.col("total") - 100) > CLOSE).alias("n")).select(F.lit("shares of a state do not add up").alias("rule"), "n")
    cells = sums.groupBy("score_year").agg(F.count("*").alias("cells")).agg(F.count_if(F.col("cells") != len(CELLS)).alias("n")).select(F.lit("a state is missing").alias("rule"), "n")
    twice = scores.groupBy("score_year", "universe", "treatment", "issn_l").agg(F.count("*").alias("c")).agg(F.count_if(F.col("c") > 1).alias("n")).select(F.lit("a state repeats a journal").alias("rule"), "n")
    return rows.unionByName(off).unionByName(cells).unionByName(twice)


def conservation(parts: dict[str, DataFrame], measure: str, by: str) -> DataFrame:
    """(by, stage, total) of a measure at every stage, for comparing stages."""
    arms = [df.groupBy(by).agg(F.coalesce(F.sum(measure), F.lit(0)).alias("total")).withColumn("stage", F.lit(name)) for name, df in parts.items()]
    return reduce(lambda a, b: a.unionByName(b), arms).select(by, "stage", "total")


def differences(left: DataFrame, right: DataFrame, columns: list[str], tolerance: float = 1e-12) -> DataFrame:
    """Keys in which two annual tables differ: missing sides, unequal values, doubles beyond a relative tolerance."""
    doubles = {n for n, t in left.dtypes if t in ("double", "float")}
    l, r = left.select(*YEAR_AND_ID, *[F.col(c).alias(f"l_{c}") for c in columns], F.lit(True).alias("__l")), right.select(*YEAR_AND_ID, *[F.col(c).alias(f"r_{c}") for c in columns], F.lit(True).alias("__r"))
    joined = l.join(r, YEAR_AND_ID, "full_outer")

    def unequal(c: str) -> Column:
        a, b = F.col(f"l_{c}"), F.col(f"r_{c}")
        far = F.abs(a - b) > tolerance * F.greatest(F.abs(a), F.abs(b)) if c in doubles else ~a.eqNullSafe(b)
        return F.when(F.coalesce(far, ~a.eqNullSafe(b)), c)

    what = F.when(F.col("__l").isNull(), "only right").when(F.col("__r").isNull(), "only left").otherwise(F.array_join(F.array(*[unequal(c) for c in columns]), ","))
    return joined.select(*YEAR_AND_ID, what.alias("difference")).where("difference <> ''")
