"""The best representative of each group of duplicate records, built from consistent bundles.

Fields that depend on each other form a *bundle* (a title with its type, an
ISSN with the list it belongs to, ...), and a survivor takes a whole bundle from
one record, never half of it.  The record that stands for the group is a bundle
as well.  Every bundle of every record is a candidate with a trust, and
functional dependencies restrict which candidates may be combined:

* *representative -> publisher, title, issn*: a representative with a usable
  bundle of its own determines where that bundle comes from;
* *field -> domain*: a field belongs to one domain, that of the table at large.

Branch and bound finds the combination of highest total trust: bundles are
decided in order of weight, the bound is the trust still open, and a branch
ends where a dependency is broken or the bound cannot win.  A better
representative outweighs everything else; publisher, title and ISSN are trusted
by recency, the other bundles by the merit of their record.

Groups may be of any size: before they meet, candidates are reduced by a
map-side combinable maximum to the best one for each combination of the
attributes that dependencies look at, which is all that branch and bound can
tell apart: a representative for each set of bundles it has of its own, one
field for each field.  The domains of fields join the reduced candidates.

Defined results: missing values and placeholders are no candidates; a bundle
without candidates, or whose candidates all break a dependency, stays null;
repeated rows count once; a record without a time is the oldest; ties go to
the smaller id; an approved representative stands even if it is absent;
groups without a member present give no row; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.functions.ids import blank_to_null, entity_id, issn_key, issn_key_is_valid, issn_set, issn_text
from quillmesh.operators.snapshots import canonical_hash

# Texts that stand in place of a value, as letters and digits in lower case.
PLACEHOLDERS = [
    "missing", "na", "nil", "none", "noname", "nopublisher", "notapplicable", "notavailable", "notgiven", "notitle", "notknown", "notspecified", "null",
    "placeholder", "publishernotgiven", "publisherunknown", "publishernotknown", "sn", "tba", "tbd", "test", "testrecord", "titlenotgiven", "titleunknown", "undefined", "unknown",
    "unknownpublisher", "unknowntitle", "unspecified", "untitled", "xxx",
]


def usable(value: Column) -> Column:
    """True unless the text is missing or a placeholder."""
    bare = F.lower(F.regexp_replace(value, r"[^\p{L}\p{N}]", ""))
    return F.coalesce((bare != "") & ~bare.isin(PLACEHOLDERS), F.lit(False))


@dataclass(frozen=True)
class Candidate:
    """A bundle of one record: what it is worth, what dependencies see of it, and the values themselves."""

    source: str
    trust: float
    seen: Mapping[str, str]
    values: str


#: determinant attribute, dependent attribute, and the dependent value that belongs to each determinant value
Dependency = tuple[str, str, Mapping[str, str]]


def breaks(seen: Mapping[str, str], dependencies: Sequence[Dependency]) -> bool:
    """True if the attributes chosen so far contradict a dependency."""
    for left, right, facts in dependencies:
        if left in seen and right in seen and facts.get(seen[left], seen[right]) != seen[right]:
            return True
    return False


def best_combination(bundles: Mapping[str, Sequence[Candidate]], dependencies: Sequence[Dependency]) -> dict[str, Candidate | None]:
    """The feasible choice of at most one candidate for each bundle with the highest total trust; earlier candidates win ties."""
    names = sorted(bundles, key=lambda b: (-max((c.trust for c in bundles[b]), default=0.0), b))
    options = {b: sorted(bundles[b], key=lambda c: -c.trust) for b in names}
    most_left = [0.0] * (len(names) + 1)
    for k in range(len(names) - 1, -1, -1):
        most_left[k] = most_left[k + 1] + (options[names[k]][0].trust if options[names[k]] else 0.0)
    best_trust, best = -1.0, {}

    def branch(k: int, trust: float, seen: dict[str, str], chosen: dict[str, Candidate | None]) -> None:
        nonlocal best_trust, best
        if trust + most_left[k] <= best_trust:
            return
        if k == len(names):
            best_trust, best = trust, dict(chosen)
            return
        for c in [*options[names[k]], None]:
            further = seen | dict(c.seen) if c else seen
            if c is None or not breaks(further, dependencies):
                branch(k + 1, trust + (c.trust if c else 0.0), further, chosen | {names[k]: c})

    branch(0, 0.0, {}, {})
    return best


#: Weight of a step between two representatives: more than all other bundles together.
STEP = 10.0

#: Bundles that a representative determines if it has them itself; they are trusted by recency.
DETERMINED = ["publisher", "title", "issn"]


def group_bundles(rows: Sequence[Mapping], approved: str | None) -> tuple[dict[str, list[Candidate]], list[Dependency]]:
    """Candidates with their trust, and the dependencies, of one group.

    ``rows`` have bundle, source_id, own (the record's bundles of DETERMINED), merit, updated, number, values, seen, domain.
    """
    by_merit = sorted(rows, key=lambda r: tuple(r["merit"]), reverse=True)
    by_time = sorted(rows, key=lambda r: (r["updated"] is not None, r["updated"] or datetime.min, -r["number"]), reverse=True)
    # A standing record and its own bundles arrive in one row; they part here.
    standing = [r for r in by_merit if r["bundle"] == "representative"]
    ids = list(dict.fromkeys([*([approved] if approved else []), *(r["source_id"] for r in standing)]))
    bundles = {"representative": [Candidate(i, STEP * (len(ids) - k), {"representative": i}, "") for k, i in enumerate(ids)]}
    dependencies: list[Dependency] = []
    for name in DETERMINED:
        owners = {r["source_id"]: r["own"][name] for r in standing if r["own"].get(name) is not None}
        dependencies.append(("representative", name, {i: i for i in owners}))
        found: dict[str, str] = {}
        for r in by_time:
            if r["bundle"] == name:
                found.setdefault(r["source_id"], r["values"])
            elif r["bundle"] == "representative" and r["source_id"] in owners:
                found.setdefault(r["source_id"], owners[r["source_id"]])
        bundles[name] = [Candidate(i, 1 / (1 + k), {name: i}, v) for k, (i, v) in enumerate(found.items())]
    domains: dict[str, str] = {}
    for r in by_merit:
        if r["bundle"] in ("field", "domain", "access"):
            have = bundles.setdefault(r["bundle"], [])
            have.append(Candidate(r["source_id"], 1 / (1 + len(have)), dict(r["seen"]), r["values"]))
            if r["domain"] is not None:
                domains[r["seen"]["oa_field"]] = r["domain"]
    return bundles, [*dependencies, ("oa_field", "oa_domain", domains)]


def resolve_groups(groups: DataFrame) -> DataFrame:
    """(group, bundle, source_id, values) of each group's best combination; ``groups`` is (group, approved, candidates)."""

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out: list[tuple] = []
            for key, approved, rows in zip(*(b.column(i).to_pylist() for i in range(3)), strict=True):
                for r in rows:
                    r["own"], r["seen"] = dict(r["own"] or ()), dict(r["seen"] or ())
                    r["merit"] = list(r["merit"].values())
                    r["merit"][3:4] = [r["merit"][3] is not None, r["merit"][3] or datetime.min]
                chosen = best_combination(*group_bundles(rows, approved))
                out += [(key, name, c.source, c.values) for name, c in chosen.items() if c]
            columns = list(zip(*out, strict=True)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], names=["group", "bundle", "source_id", "values"])

    return groups.mapInArrow(choose, "group string, bundle string, source_id string, values string")


# --- journals -----------------------------------------------------------------------------------------------

BUNDLES = ["representative", *DETERMINED, "field", "domain", "access"]


def newest_states(sources: DataFrame) -> DataFrame:
    """One row per source of the newest snapshot: its newest version, as snapshot changes see it."""
    day = blank_to_null("snapshot_date")
    newest = sources.agg(F.max(day)).first()[0]
    columns = ["source_type", "title", "publisher", "raw_issn_l", "issns", "oa_field", "oa_domain", "is_open_access", "updated_date"]
    compared = [issn_key("raw_issn_l") if c == "raw_issn_l" else F.array_join(issn_set("issns"), ",") if c == "issns" else F.col(c) for c in columns[:-1]]
    rows = sources.where(day == newest).select(entity_id("source_id", "S").alias("source_id"), *columns, F.struct("updated_date", "loaded_at", canonical_hash(compared).alias("hash")).alias("version"))
    return rows.where("source_id IS NOT NULL").groupBy("source_id").agg(F.max_by(F.struct(*columns), "version").alias("s")).select("source_id", "s.*")


def components(reviewed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(group, source_id) of every member and (group, approved) of every approved decision, the latest year first."""
    keyed = reviewed.withColumn("group", issn_text("issn_l")).where("group IS NOT NULL")
    members = keyed.select("group", F.explode(F.array_append(F.coalesce("expected_component_source_ids", F.array().cast("array<string>")), F.col("source_id"))).alias("raw"))
    members = members.select("group", entity_id("raw", "S").alias("source_id")).where("source_id IS NOT NULL").distinct()
    approved = keyed.where(F.lower(blank_to_null("review_status")).startswith("approved")).select("group", F.coalesce("score_year", F.lit(0)).alias("year"), entity_id("canonical_source_id", "S").alias("id"))
    decided = approved.where("id IS NOT NULL").groupBy("group").agg(F.max_by("id", F.struct(F.col("year"), -id_number(F.col("id")))).alias("approved"))
    return members, decided


def id_number(source_id: Column) -> Column:
    """The number in an id, for ordering; 0 where there is none."""
    return F.coalesce(F.substring(source_id, 2, 38).try_cast("decimal(38,0)"), F.lit(0).cast("decimal(38,0)"))


def survivors(reviewed: DataFrame, sources: DataFrame) -> DataFrame:
    """One row per component with a member in the newest snapshot: its ids and, bundle by bundle, the surviving values."""
    members, decided = components(reviewed)
    checks = {
        "title": usable(F.col("title")),
        "publisher": usable(F.col("publisher")),
        "raw_issn_l": issn_key_is_valid(issn_key("raw_issn_l")),
        "issns": F.size(issn_set("issns")) > 0,
        "oa_field": usable(F.col("oa_field")),
        "is_open_access": F.col("is_open_access").isNotNull(),
    }
    states = newest_states(sources).withColumns({f"ok_{k}": v for k, v in checks.items()})
    present = members.join(states, "source_id").join(decided, "group", "left")
    number = id_number(F.col("source_id"))
    merit = F.struct(
        F.coalesce(F.col("source_id") == F.col("approved"), F.lit(False)).alias("approved"),
        F.coalesce(F.lower(blank_to_null("source_type")) == "journal", F.lit(False)).alias("journal"),
        sum((F.col(f"ok_{k}").cast("int") for k in checks), F.lit(0)).alias("usable"),
        F.col("updated_date").alias("updated"),
        (-number).alias("smaller"),
    )
    text = lambda *names: F.to_json(F.struct(*names))
    nothing = F.create_map().cast("map<string,string>")
    say = lambda name: F.create_map(F.lit(name), F.col(name))
    values = {"publisher": text("publisher"), "title": text("title", "source_type"), "issn": text("raw_issn_l", "issns"), "field": text("oa_field"), "domain": text("oa_domain"), "access": text("is_open_access")}
    good = {"publisher": F.col("ok_publisher"), "title": F.col("ok_title"), "issn": F.col("ok_raw_issn_l"), "field": F.col("ok_oa_field"), "domain": usable(F.col("oa_domain")), "access": F.col("ok_is_open_access")}
    seen = {"field": say("oa_field"), "domain": say("oa_domain")}
    own = F.map_filter(F.create_map(*[x for n in DETERMINED for x in (F.lit(n), F.when(good[n], values[n]))]), lambda _, v: v.isNotNull())
    flags = F.concat_ws("", *[good[n].cast("int").cast("string") for n in DETERMINED])

    def option(name: str) -> Column:
        stands = name == "representative"
        sign = flags if stands else F.to_json(seen[name]) if name in seen else F.lit("")
        # What wins among candidates that look alike: the merit of the record, or its time.
        rank = F.struct(F.lit(None).cast("timestamp").alias("at"), merit.alias("merit")) if name not in DETERMINED else F.struct(F.col("updated_date").alias("at"), F.struct(F.lit(False).alias("approved"), F.lit(False).alias("journal"), F.lit(0).alias("usable"), F.lit(None).cast("timestamp").alias("updated"), (-number).alias("smaller")).alias("merit"))
        return F.struct(
            F.lit(name).alias("bundle"), (F.lit(True) if stands else good[name]).alias("ok"), sign.alias("sign"), rank.alias("rank"), (F.lit(None).cast("string") if stands else values[name]).alias("values"),
            (own if stands else nothing).alias("own"), seen.get(name, nothing).alias("seen"),
        )

    candidates = present.select("group", "source_id", "approved", merit.alias("merit"), F.col("updated_date").alias("updated"), number.alias("number"), F.explode(F.array(*[option(n) for n in BUNDLES])).alias("b")).where("b.ok")
    kept = F.struct("source_id", "merit", "updated", "number", F.col("b.values").alias("values"), F.col("b.own").alias("own"), F.col("b.seen").alias("seen"))
    best = candidates.groupBy("group", F.col("b.bundle").alias("bundle"), F.col("b.sign").alias("sign")).agg(F.max_by(kept, F.col("b.rank")).alias("c"), F.max("approved").alias("approved"))

    # The dependency field -> domain as the whole table has it.
    pairs = sources.where(usable(F.col("oa_field")) & usable(F.col("oa_domain"))).groupBy("oa_field", "oa_domain").agg(F.count("*").alias("n"))
    facts = pairs.groupBy("oa_field").agg(F.max_by("oa_domain", F.struct("n", "oa_domain")).alias("domain"))
    told = best.withColumn("oa_field", F.when(F.col("bundle") == "field", F.element_at("c.seen", F.lit("oa_field")))).join(facts, "oa_field", "left")
    groups = told.groupBy("group").agg(F.max("approved").alias("approved"), F.collect_list(F.struct("bundle", "c.*", "domain")).alias("candidates"))
    resolved = resolve_groups(groups)

    source_of = lambda b: F.max(F.when(F.col("bundle") == b, F.col("source_id")))
    return resolved.groupBy(F.col("group").alias("issn_l")).agg(
        source_of("representative").alias("canonical_source_id"),
        *[source_of(b).alias(f"{b}_source_id") for b in BUNDLES[1:]],
        *[F.max(F.when(F.col("bundle") == b, F.get_json_object("values", f"$.{f}"))).alias(f) for b, f in [("title", "title"), ("title", "source_type"), ("publisher", "publisher"), ("issn", "raw_issn_l"), ("field", "oa_field"), ("domain", "oa_domain"), ("access", "is_open_access")]],
    )
