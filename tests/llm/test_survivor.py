"""Survivors from consistent bundles."""

import itertools
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from quillmesh.llm import queries, survivor
from quillmesh.llm.survivor import Candidate, best_combination, breaks

from ..oracle import compare


def test_branch_and_bound_against_all_combinations():
    rnd = random.Random(4)
    facts = [("field", "domain", {"f1": "d1", "f2": "d2"}), ("kind", "field", {"k1": "f1"})]
    for _ in range(300):
        bundles = {}
        for name, attribute, values in (("a", "field", ["f1", "f2", "f3"]), ("b", "domain", ["d1", "d2"]), ("c", "kind", ["k1", "k2"]), ("d", None, [None])):
            bundles[name] = [Candidate(f"S{i}", round(rnd.random() * 3, 2), {attribute: rnd.choice(values)} if attribute else {}, "") for i in range(rnd.randint(0, 4))]
        best = 0.0
        for combo in itertools.product(*[[*c, None] for c in bundles.values()]):
            seen = {k: v for c in combo if c for k, v in c.seen.items()}
            if not breaks(seen, facts):
                best = max(best, sum(c.trust for c in combo if c))
        chosen = best_combination(bundles, facts)
        assert not breaks({k: v for c in chosen.values() if c for k, v in c.seen.items()}, facts)
        assert abs(sum(c.trust for c in chosen.values() if c) - best) < 1e-9


def test_placeholders(spark):
    data = ["Press", "n/a", " N/A ", "?", "-", "", None, "s.n.", "UNKNOWN PUBLISHER", "[publisher not given]", "(untitled)", "NULL", "not available", "None", "Unknown", "Nova", "出版"]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in data], "x string").select(survivor.usable(F.col("x"))).collect()]
    assert [d for d, ok in zip(data, got, strict=True) if ok] == ["Press", "Nova", "出版"]


REVIEWED = "score_year int, source_id string, canonical_source_id string, issn_l string, expected_component_source_ids array<string>, review_status string, evidence string"
SOURCES = "source_id string, raw_issn_l string, source_type string, title string, publisher string, issns array<string>, oa_field string, oa_domain string, is_open_access boolean, updated_date timestamp, snapshot_date string, loaded_at timestamp, bundle string"
T = lambda d: datetime(2025, 1, d)


def source(i, day=1, kind="journal", title="T", publisher="P", issn="0378-5955", field="Law", domain="Social", oa=True, snap="2025-10-15", issns=("0378-5955",)):
    return (i, issn, kind, title, publisher, list(issns) if issns is not None else None, field, domain, oa, T(day), snap, T(1), "clash")


def survivors(spark, reviewed, sources):
    out = survivor.survivors(spark.createDataFrame(reviewed, REVIEWED), spark.createDataFrame(sources, SOURCES))
    return {r.issn_l: r for r in out.collect()}


def review(members, canonical=None, status=None, key="0378-5955", year=2025):
    return (year, members[0], canonical, key, members, status, None)


def test_order_of_representatives(spark):
    one = lambda sources, **k: survivors(spark, [review(["S1", "s2 ", "sources/S3"], **k)], sources)["0378-5955"]
    assert one([source("S1", kind="other"), source("S2", kind=" JOURNAL", title="(untitled)")]).canonical_source_id == "S2"
    assert one([source("S1", publisher="n/a"), source("S2")]).canonical_source_id == "S2"
    assert one([source("S1"), source("S2", day=2)]).canonical_source_id == "S2"
    assert one([source("S3"), source("S2")]).canonical_source_id == "S2"
    assert one([source("S1"), source("S2")], canonical="S9", status=" Approved_for_score_year").canonical_source_id == "S9"
    assert one([source("S1"), source("S2", day=2)], canonical="S1", status="rejected").canonical_source_id == "S2"


def test_publisher_and_presence(spark):
    r = survivors(spark, [review(["S1", "S2", "S3"])], [source("S1", publisher="?", day=9), source("S2", publisher="A", day=2, kind=None), source("S3", publisher="B", day=3, kind=None), source("S1", day=1, publisher="old")])["0378-5955"]
    assert (r.canonical_source_id, r.publisher_source_id, r.publisher) == ("S1", "S3", "B")
    r = survivors(spark, [review(["S1"])], [source("S1", publisher=None)])["0378-5955"]
    assert r.publisher_source_id is None and r.publisher is None
    assert survivors(spark, [review(["S1"])], [source("S1", snap="2025-07-15"), source("S7")]) == {}
    assert survivors(spark, [], [source("S1")]) == {} and survivors(spark, [review(["S1"])], []) == {}


def test_field_and_domain_stay_consistent(spark):
    table = [source(f"S{i}", field="Law", domain="Social") for i in range(10, 15)] + [source("S1", day=3, field="Law", domain="Physical"), source("S2", day=2, field="Unknown", domain="Social", kind="other")]
    r = survivors(spark, [review(["S1", "S2"])], table)["0378-5955"]
    assert (r.canonical_source_id, r.oa_field, r.oa_domain) in {("S1", "Law", "Social"), ("S1", None, "Physical")}
    assert r.oa_field == "Law" and r.field_source_id == "S1" and r.domain_source_id == "S2"


def test_a_dependency_changes_the_publisher():
    """Without the dependency the newer publisher would win; with it the representative's own does, and an absent one leaves the newer."""
    merit = lambda k: [False, True, k, True, T(1), -k]
    row = lambda bundle, i, day, own=(), values="", k=1: {"bundle": bundle, "source_id": i, "own": dict(own), "merit": merit(k), "updated": T(day), "number": int(i[1:]), "values": values, "seen": {}, "domain": None}
    rows = [row("representative", "S1", 1, {"publisher": "old"}, k=6), row("representative", "S2", 9, k=5), row("publisher", "S3", 9, values="new")]
    bundles, dependencies = survivor.group_bundles(rows, None)
    free, bound = best_combination(bundles, []), best_combination(bundles, dependencies)
    assert (free["representative"].source, free["publisher"].source) == ("S1", "S3")
    assert (bound["representative"].source, bound["publisher"].source, bound["publisher"].values) == ("S1", "S1", "old")
    chosen = best_combination(*survivor.group_bundles(rows, "S9"))
    assert (chosen["representative"].source, chosen["publisher"].source) == ("S9", "S3")


def test_many_copies_in_one_component(spark):
    ids = [f"S{i}" for i in range(1, 400)]
    r = survivors(spark, [review(ids)] * 3, [source(i, publisher="n/a" if int(i[1:]) % 2 else "P") for i in ids] * 2)["0378-5955"]
    assert (r.canonical_source_id, r.publisher_source_id) == ("S2", "S2")


def test_records_without_a_time_are_the_oldest(spark, tmp_path):
    def undated(*a, **k):
        s = list(source(*a, **k))
        s[9] = None
        return tuple(s)

    r = survivors(spark, [review(["S1", "S2", "S3"])], [undated("S1", publisher="?"), undated("S2", publisher="A", kind=None), source("S3", publisher="B", kind=None)])["0378-5955"]
    assert (r.canonical_source_id, r.publisher_source_id, r.publisher) == ("S1", "S3", "B")
    r = survivors(spark, [review(["S3", "S2"])], [undated("S3", publisher="A"), undated("S2", publisher="B")])["0378-5955"]
    assert (r.canonical_source_id, r.publisher_source_id) == ("S2", "S2")
    reviewed = [review(["S1", "S2", "S3"]), review(["S4", "S5"], key="2049-3630")]
    sources = [undated("S1", publisher="?"), undated("S2", kind=None), source("S3", kind=None), undated("S4"), undated("S5")]
    spark.createDataFrame(reviewed, REVIEWED).write.parquet(f"{tmp_path}/reviewed_representative.parquet")
    spark.createDataFrame(sources, SOURCES).write.parquet(f"{tmp_path}/source_rows.parquet")
    assert {tuple(r) for r in queries.p5_found(spark, str(tmp_path)).collect()} == {("0378-5955", "S1", "S3"), ("2049-3630", "S4", "S4")}


@pytest.mark.parametrize("folder", ["sf0.001", "sf0.01"])
def test_query_equals_its_sql(spark, folder):
    compare(spark, f"/root/testdata/{folder}", queries.p5_found, queries.ORACLES["p5_found"])
