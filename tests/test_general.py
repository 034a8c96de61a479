"""Snapshot changes, orphan references, nested records and heavy keys on small fixtures and against brute force."""

import itertools
import json
import random
from collections import Counter, defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from quillmesh.functions import ids
from quillmesh.operators import heavy_keys, nested, orphans, snapshots

# --- ids ---


def test_ids_and_issns(spark):
    cases = [" S12", "sources/s0012", "https://x.example/W77", "w 5", "", None, "nothing"]
    got = [tuple(r) for r in spark.createDataFrame([(c,) for c in cases], "x string").select(ids.entity_id("x", "S"), ids.entity_id("x", "W")).collect()]
    assert got == [("S12", "S12"), ("S0012", "sources/s0012"), ("https://x.example/W77", "W77"), ("w 5", "W5"), (None, None), (None, None), ("nothing", "nothing")]
    cases = [("0378-5955", "0378-5955", "valid"), (" 03785955 ", "0378-5955", "valid"), ("2434‐561x", "2434-561X", "valid"), ("0378-5954", "0378-5954", "invalid_checksum"), ("0378-595", "0378595", "invalid_syntax"), ("03785X55", "0378-5X55", "invalid_syntax"), (" - ", None, "missing"), (None, None, "missing")]
    got = spark.createDataFrame([(c[0],) for c in cases], "x string").select("x", ids.issn_text("x").alias("t"), ids.issn_status("x").alias("s"), ids.valid_issn("x").alias("v")).collect()
    assert [(r.x, r.t, r.s) for r in got] == cases
    assert [r.v is not None for r in got] == [c[2] == "valid" for c in cases]


def test_issn_set_is_a_set(spark):
    df = spark.createDataFrame([(["1111-1111", " 11111111", None, ""],), ([],), (None,)], "x array<string>")
    assert [r[0] for r in df.select(ids.issn_set("x")).collect()] == [["11111111"], [], []]


# --- snapshot changes ---

SOURCE = "source_id string, title string, issns array<string>, updated timestamp, loaded timestamp, day string"


def states(spark, data):
    df = spark.createDataFrame(data, SOURCE)
    return snapshots.snapshot_states(df, ids.entity_id("source_id", "S"), ids.blank_to_null("day"), [F.col("updated"), F.col("loaded")], [F.col("title"), F.array_join(ids.issn_set("issns"), ",")])


def test_snapshot_changes(spark, rows, at):
    t = at("01-01")
    data = [
        ("S1", "a", ["1234-5679"], t, t, "d1"), ("s1 ", "a", ["12345679", None], t, t, "d2"), ("S1", "a", None, t, t, "d3"),  # written otherwise, then emptied
        ("S2", "b", None, t, t, "d1"), ("S2", "b", None, t, t, "d1"), ("S2", "", [], at("01-02"), t, "d2"), ("S2", "old", [], t, t, "d2"), ("S2", None, [], t, t, "d3"),  # repeats, an outdated version, empty and null title
        ("S3", "c", None, t, t, "d2"), (None, "junk", None, t, t, "d2"), (" ", "junk", None, t, t, "d3"), ("S4", "d", None, None, None, "d3"), ("S9", "x", None, t, t, None),
    ]
    got = rows(snapshots.snapshot_changes(states(spark, data)))
    assert got == sorted([("d2", "S2", "changed"), ("d2", "S3", "added"), ("d3", "S1", "changed"), ("d3", "S2", "changed"), ("d3", "S3", "removed"), ("d3", "S4", "added")], key=repr)


def test_snapshot_changes_of_little(spark, rows):
    assert rows(snapshots.snapshot_changes(states(spark, []))) == []
    assert rows(snapshots.snapshot_changes(states(spark, [("S1", "a", None, None, None, "d1")]))) == []


def test_canonical_hash_keeps_nulls_and_borders(spark):
    df = spark.createDataFrame([("a", "bc"), ("ab", "c"), (None, "c"), ("", "c"), ("~", "c"), ("x" * 100_000, None)], "a string, b string")
    assert df.select(snapshots.canonical_hash([F.col("a"), F.col("b")])).distinct().count() == 6


# --- orphan references ---


def orphan_rows(spark, children, parents):
    c = spark.createDataFrame(children, "ref_table string, period int, child_key string, ref_key string, scope int, asked_at timestamp")
    p = spark.createDataFrame(parents, "ref_table string, ref_key string, scope int, valid_from timestamp, valid_to timestamp")
    return orphans.orphan_references(c, p)


def test_orphans_by_brute_force(spark, rows):
    rnd = random.Random(3)
    day = lambda: datetime(2025, 1, 1) + timedelta(days=rnd.randint(0, 20))
    parents = [("t", f"k{rnd.randint(0, 12)}", None, (a := day()), rnd.choice([None, a + timedelta(days=rnd.randint(0, 9))])) for _ in range(30)] + [("u", f"k{i}", y, None, None) for i in range(4) for y in (1, 2)]
    children = [("t", rnd.randint(1, 2), f"c{rnd.randint(0, 40)}", rnd.choice([None, f"k{rnd.randint(0, 15)}"]), None, rnd.choice([None, day(), day()])) for _ in range(400)]
    children += [("t", 1, f"h{i}", "k0", None, day()) for i in range(300)] + [("u", y, f"c{i}", f"k{i % 7}", y, None) for i in range(60) for y in (1, 2, 3)]
    want = set()
    for table, period, child, key, scope, asked in children:
        held = any(p[0] == table and p[1] == key and p[2] == scope and ((p[3] is None and p[4] is None) or (asked is not None and p[3] <= asked and (p[4] is None or p[4] > asked))) for p in parents)
        if key is not None and not held:
            want.add((table, period, child, key))
    found = orphan_rows(spark, children, parents)
    assert rows(found) == sorted(want, key=repr)
    report = {(r.ref_table, r.period): (r.n_references, r.n_missing_keys, r.n_children) for r in orphans.orphan_report(found).collect()}
    for key in {(t, p) for t, p, _, _ in want}:
        own = [w for w in want if w[:2] == key]
        assert report[key] == (len(own), len({w[3] for w in own}), len({w[2] for w in own}))


def test_any_number_of_intervals_of_one_key(spark, rows):
    day = lambda n: datetime(2000, 1, 1) + timedelta(days=n)
    parents = [("t", "k", None, day(4 * i), day(4 * i + 2)) for i in range(1000)] + [("t", "k", None, day(5000), None), ("t", "k", None, None, day(9000))]
    children = [("t", 1, f"c{n}", "k", None, day(n)) for n in range(0, 5010)] + [("t", 1, "untimed", "k", None, None)]
    found = orphan_rows(spark, children, parents)
    expected = [("t", 1, f"c{n}", "k") for n in range(5000) if n >= 4000 or n % 4 > 1] + [("t", 1, "untimed", "k")]
    assert rows(found) == sorted(expected, key=repr)
    assert "collect_set" not in found._jdf.queryExecution().toString()


def test_orphans_of_empty_tables(spark, rows):
    assert rows(orphan_rows(spark, [], [])) == []
    assert rows(orphan_rows(spark, [("t", None, "c", "k", None, None)], [])) == [("t", None, "c", "k")]


# --- nested records ---


def flat(spark, payloads):
    raw = spark.createDataFrame([(i, p) for i, p in enumerate(payloads)], "record_id long, payload string")
    return sorted(tuple(r) for r in nested.flatten(nested.parsed_records(raw)).collect())


def test_payload_shapes(spark):
    loc = {"source": {"id": "s5", "issn": "1111-1111; 2222-2222"}}
    payloads = [
        {"primary_location": {"source": "sources/S1"}, "locations": [None, loc, {"source": None}], "referenced_works": ["W1", "", None, "works/w2"]},
        {"primaryLocation": [{"source": {"id": "S2"}}], "Locations": loc, "referencedWorks": "W3; W4|W5"},
        {"primary-location": None, "locations": None, "REFERENCED_WORKS": [{"id": "W6"}, {"work": {"id": "W7", "pos": 1}}, {"id": None}]},
        {"primary_location": {"source": {"id": " "}}, "locations": [{"source": {"id": None, "issn": ["", "3333-3333 ", None]}}], "referenced_works": "W8"},
    ]
    got = flat(spark, [json.dumps(p) for p in payloads])
    assert got == sorted([
        (0, "primary_source", -1, 0, "S1"), (0, "location", -1, 1, "S5"), (0, "location", -1, 2, ""), (0, "location_issn", 1, 0, "1111-1111"), (0, "location_issn", 1, 1, "2222-2222"), (0, "reference", -1, 0, "W1"), (0, "reference", -1, 3, "W2"),
        (1, "primary_source", -1, 0, "S2"), (1, "location", -1, 0, "S5"), (1, "location_issn", 0, 0, "1111-1111"), (1, "location_issn", 0, 1, "2222-2222"), (1, "reference", -1, 0, "W3"), (1, "reference", -1, 1, "W4"), (1, "reference", -1, 2, "W5"),
        (2, "reference", -1, 0, "W6"), (2, "reference", -1, 1, "W7"), (3, "location", -1, 0, ""), (3, "location_issn", 0, 1, "3333-3333 "), (3, "reference", -1, 0, "W8"),
    ])


def test_unreadable_payloads_give_no_rows(spark):
    whole = json.dumps({"referenced_works": ["W1"] * 3})
    assert flat(spark, [None, "", " ", "<error/>", "[]", "3", '"x"', whole[:-1], whole[: len(whole) // 2]]) == []
    assert len(flat(spark, ["\n " + whole])) == 3


def test_typed_records_with_nulls_everywhere(spark, rows):
    schema = "record_id long, primary_location struct<source:struct<id:string,issn_l:string>,extra:string>, locations array<struct<source:struct<id:string,issn_l:string,issn:array<string>>,version:string>>, referenced_works array<string>, pos int, child string"
    data = [(1, None, None, None, 1, "x"), (2, (None, "e"), [], [], 2, "y"), (3, (("S1", None), None), [None, (None, "v"), ((None, None, None), None), (("S2", None, [None, "a", "a"]), None)], [None, " ", "W1", "W1"], 3, None), (None, None, None, ["W9" * 1], 4, None)]
    got = rows(nested.flatten(nested.typed_records(spark.createDataFrame(data, schema))))
    assert got == sorted([
        (3, "primary_source", -1, 0, "S1"), (3, "location", -1, 1, ""), (3, "location", -1, 2, ""), (3, "location", -1, 3, "S2"), (3, "location_issn", 3, 1, "a"), (3, "location_issn", 3, 2, "a"), (3, "reference", -1, 2, "W1"), (3, "reference", -1, 3, "W1"), (None, "reference", -1, 0, "W9"),
    ], key=repr)


def test_flattening_handles_sliced_buffers():
    import pyarrow as pa

    whole = pa.RecordBatch.from_pylist(
        [{"record_id": i, "primary_source": None if i % 2 else f"S{i}", "locations": [{"id": f"S{k}", "issn": ["x"] * k} for k in range(i % 3)] if i % 5 else None, "refs": [f"W{k}" for k in range(i % 4)]} for i in range(40)],
        schema=pa.schema([("record_id", pa.int64()), ("primary_source", pa.string()), ("locations", pa.list_(pa.struct([("id", pa.string()), ("issn", pa.list_(pa.string()))]))), ("refs", pa.list_(pa.string()))]),
    )
    rows = lambda batches: sorted(str(r) for b in nested.flatten_batches(iter(batches)) for r in b.to_pylist())
    assert rows([whole]) == rows([whole.slice(0, 7), whole.slice(7, 20), whole.slice(27)])


# --- heavy keys ---


def test_profile_by_brute_force(spark):
    rnd = random.Random(5)
    data = [(rnd.choice(["a"] * 30 + ["b", "c", None]), rnd.choice([None, 1, 2, 3, 9]), rnd.choice([None, 0, 5])) for _ in range(900)] + [("nulls", None, None)] * 3
    df = spark.createDataFrame(data, "key string, n long, m long")
    got = {r.key: r for r in heavy_keys.key_profile(df, ["key"], ["n", "m"], (0.5, 0.9)).collect()}
    by = defaultdict(list)
    for k, n, m in data:
        by[k].append((n, m))
    assert set(got) == set(by)
    for k, pairs in by.items():
        r = got[k]
        assert r.n_rows == len(pairs)
        for name, values in (("n", [n for n, _ in pairs if n is not None]), ("m", [m for _, m in pairs if m is not None])):
            if not values:
                assert r[f"total_{name}"] is None and r[f"distinct_{name}"] is None and r[f"p50_{name}"] is None
                continue
            assert r[f"total_{name}"] == sum(values) and r[f"distinct_{name}"] == len(set(values))
            counts = Counter(values)
            assert r[f"mode_{name}"] == min(counts, key=lambda v: (-counts[v], v))
            assert r[f"p50_{name}"] == sorted(values)[-(-len(values) // 2) - 1] and r[f"p90_{name}"] == sorted(values)[-(-len(values) * 9 // 10) - 1]


@pytest.mark.parametrize("n,heavy", [(3, {"h"}), (2, set())])
def test_heavy_keys_border(spark, n, heavy):
    data = [("s", "h")] * n + [("s", None)] * 40 + [("s", f"k{i}") for i in range(100 - 40 - n)]
    df = spark.createDataFrame(data, "side string, key string").withColumn("v", F.lit(1))
    totals = heavy_keys.key_totals(heavy_keys.value_frequencies(df, ["side", "key"], ["v"]), ["side", "key"], ["v"])
    assert {r.key for r in heavy_keys.heavy_keys(totals, "side", 3).collect()} == heavy


def test_two_sided_and_empty(spark):
    df = spark.createDataFrame([("a", "b", 1)], "x string, y string, n int")
    assert sorted(tuple(r) for r in heavy_keys.two_sided(df, {"l": F.col("x"), "r": F.col("y")}, ["n"]).collect()) == [("l", "a", 1), ("r", "b", 1)]
    none = df.where("n > 5")
    assert heavy_keys.key_profile(none, ["x"], ["n"]).count() == 0
    assert list(itertools.chain(heavy_keys.key_profile(df, ["x"], ["n"]).columns)) == ["x", "n_rows", "total_n", "distinct_n", "mode_n", "p50_n"]
