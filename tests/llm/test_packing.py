"""Containers hold whole items, never more than their capacity, and little room is left."""

from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quillmesh.llm import packing


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200))
def test_one_shard(sizes):
    number = packing.harmonic_fill(np.array(sizes, np.int64), 64)
    used = Counter()
    for n, s in zip(number, sizes, strict=True):
        assert n >= 0
        used[int(n)] += s
    assert all(u <= 64 for u in used.values())
    assert len(used) <= 1.7 * -(-sum(sizes) // 64) + 2


def test_harmonic_counts_open_each_container():
    number = packing.harmonic_fill(np.array([30] * 10), 64)
    assert sorted(Counter(number.tolist()).values()) == [2] * 5


@pytest.mark.parametrize("way,least", [(packing.pack, 0.75), (packing.pack_tight, 0.97)])
def test_pack(spark, way, least):
    data = [(i, (i * 37) % 90 + 1) for i in range(3000)] + [(9001, 250), (9002, 200), (9003, 0), (9004, None), (None, 5), (1, 38), (1, 38)]
    df = spark.createDataFrame(data, "doc_id long, n int")
    packed = way(df, "doc_id", "n", 100, shard_pieces=500)
    rows = packed.collect()
    used, parts = Counter(), defaultdict(list)
    for r in rows:
        used[r.container_id] += r["size"]
        parts[r.item_id].append((r.part, r["size"]))
    assert max(used.values()) <= 100 and sum(used.values()) == sum(n or 0 for _, n in data)
    assert sorted(parts[9001]) == [(0, 100), (1, 100), (2, 50)] and sorted(parts[9002]) == [(0, 100), (1, 100)] and 9003 not in parts and 9004 not in parts
    assert len(parts[1]) == 3 and parts[None] == [(0, 5)]
    assert sum(used.values()) / (100 * len(used)) > least
    reports = {r.step: r for r in packing.fill_report(packed, 100).collect()}
    assert set(reports) == {"all", *{r.step for r in rows}} and reports["all"].fullest <= 100 and reports["all"].n_tokens == sum(used.values())
    assert reports["all"].n_containers == len(used) == sum(r.n_containers for s, r in reports.items() if s != "all") and reports["all"].n_containers >= reports["all"].least_containers


def test_every_harmonic_container_holds_the_count_of_its_class(spark):
    df = spark.createDataFrame([(i, (i * 37) % 90 + 1) for i in range(3000)], "doc_id long, n int")
    held, tail = defaultdict(list), 0
    for r in packing.pack(df, "doc_id", "n", 100, shard_pieces=100).collect():
        tail += r.step == "tail"
        if r.step == "harmonic":
            held[r.container_id].append(100 // r["size"])
    assert all(len(set(k)) == 1 and len(k) == k[0] for k in held.values())
    assert 0 < tail < 1200 and {k[0] for k in held.values()} >= {1, 2, 3, 4, 5}


@pytest.mark.parametrize("data", [[], [(1, 0), (2, None)]])
def test_nothing_to_pack(spark, data):
    for way in (packing.pack, packing.pack_tight):
        assert way(spark.createDataFrame(data, "doc_id long, n int"), "doc_id", "n", 10).count() == 0


def test_one_size_and_one_id(spark):
    df = spark.createDataFrame([(7, 51)] * 40, "doc_id long, n int")
    rows = packing.pack(df, "doc_id", "n", 100).collect()
    assert len(rows) == 40 and len({r.container_id for r in rows}) == 40
