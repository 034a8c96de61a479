"""Manifests, text files, receipts, published layouts and streams."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmesh.operators.versions import latest_version
from quillmesh.sources import files
from quillmesh.streaming import incremental


def test_manifest_is_checked_before_reading(spark, tmp_path):
    for i in range(2):
        spark.range(5).withColumn("n", F.lit(i)).coalesce(1).write.parquet(str(tmp_path / f"d={i}"))
    parts = sorted(tmp_path.rglob("*.parquet"))
    files.write_manifest(parts, tmp_path, tmp_path / "m.json")
    listed = files.manifest_files(tmp_path / "m.json", tmp_path)
    rows = files.read_listed(spark, listed)
    assert rows.columns == ["id", "n", "source_file", "source_row"] and rows.count() == 10
    wanted = rows.where("source_row = 3")
    assert sorted(r.id for r in files.rows_at(rows, wanted).collect()) == [3, 3]
    good = json.loads((tmp_path / "m.json").read_text())
    for spoil in ({"path": "../x", "bytes": 1}, {"path": str(parts[0]), "bytes": 1}, {**good["files"][0], "bytes": 1}, good["files"][1], {"path": "none.parquet", "bytes": 3}):
        (tmp_path / "bad.json").write_text(json.dumps({"files": [good["files"][1], spoil]}))
        with pytest.raises(ValueError):
            files.manifest_files(tmp_path / "bad.json", tmp_path)
    (tmp_path / "bad.json").write_text(json.dumps({**good, "total_bytes": 1}))
    with pytest.raises(ValueError, match="total"):
        files.manifest_files(tmp_path / "bad.json", tmp_path)


def test_alternative_columns(spark):
    df = spark.createDataFrame([(None, "x"), ("a", "y")], "issn string, host string")
    out = files.pick_columns(df, {"issns": ["issns", "issn"], "publisher": ["publisher", "host"], "open": ["is_oa"]})
    assert [tuple(r) for r in out.collect()] == [(None, "x", None), ("a", "y", None)]


def test_register_file(spark, tmp_path):
    head = ";".join([*files.REGISTER_COLUMNS, "Level 2024", "Level 2025"])
    (tmp_path / "r.csv").write_text(f"﻿{head}\n7;\"Acta; X\";Acta;0378-5955;;A;B;0;;1;\n8;Y;;;;;;;2024;;2\n", encoding="utf-8")
    out = files.read_register(spark, str(tmp_path / "r.csv"))
    assert sorted((r.journal_id, r["Original Title"], r.score_year, r.level) for r in out.collect()) == [("7", "Acta; X", 2024, 1), ("8", "Y", 2025, 2)]
    (tmp_path / "bad.csv").write_text("journal_id;Level 2024\n1;1\n")
    with pytest.raises(ValueError, match="lacks"):
        files.read_register(spark, str(tmp_path / "bad.csv"))


SCHEMA = T.StructType([T.StructField("id", T.StringType()), T.StructField("n", T.LongType()), T.StructField("x", T.DoubleType()), T.StructField("b", T.BooleanType())])


def test_csv_round_trip_keeps_every_cell(spark, tmp_path):
    data = [("0007", 1, 0.1 + 0.2, True), ('a "q", \n b', None, 1e-300, False), ("NA", 0, None, None), ("null", -5, -0.0, True), (None, 2, 3.0, None), ("", 3, 1.0, False)]
    df = spark.createDataFrame(data, SCHEMA)
    assert files.write_single_csv(df, str(tmp_path / "a.csv")) == 6
    assert (tmp_path / "a.csv").read_bytes().startswith(b"\xef\xbb\xbf")
    back = files.read_single_csv(spark, str(tmp_path / "a.csv"), SCHEMA)
    files.assert_same_rows(df, back)
    with pytest.raises(ValueError):
        files.assert_same_rows(df, back.where("n > 0"))


def test_typed_csv_reads_only_the_empty_cell_as_null(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id,n,x,b\nNA,1,2.5,true\nnull,,,\n")
    got = [tuple(r) for r in files.read_typed_csv(spark, str(tmp_path / "t.csv"), SCHEMA).collect()]
    assert got == [("NA", 1, 2.5, True), ("null", None, None, None)]


def test_stage_reuses_and_refuses(spark, tmp_path):
    built = []

    def build():
        built.append(1)
        return spark.range(4)

    path = str(tmp_path / "stage")
    assert files.stage(spark, path, {"sql": 1}, build).count() == 4 and files.stage(spark, path, {"sql": 1}, build).count() == 4 and len(built) == 1
    with pytest.raises(RuntimeError, match="another contract"):
        files.stage(spark, path, {"sql": 2}, build)
    spark.range(1).write.parquet(str(tmp_path / "orphan"))
    with pytest.raises(RuntimeError, match="no receipt"):
        files.stage(spark, str(tmp_path / "orphan"), {}, build)


def test_layouts_prune(spark, tmp_path):
    jy = files.synthetic_journals(spark, 300, [2024, 2025])
    assert jy.exceptAll(files.synthetic_journals(spark, 300, [2024, 2025]).repartition(7)).isEmpty()
    assert jy.where("works_filtered > works_raw OR works_raw < 1").isEmpty()
    files.write_annual(jy, str(tmp_path / "annual"))
    assert spark.read.parquet(str(tmp_path / "annual")).where("score_year = 2025").count() == 300
    files.write_shards(jy, str(tmp_path / "shards"))
    one = files.read_history(spark, str(tmp_path / "shards"), "0000142")
    assert sorted(r.score_year for r in one.collect()) == [2024, 2025]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(shard" in plan and "EqualTo(journal_id,0000142)" in plan


def test_dictionary_and_publishing(spark, tmp_path):
    with pytest.raises(ValueError, match="no description for: id"):
        files.described(spark.range(1), {})
    assert files.described(spark.range(1), {"id": "number"}).schema["id"].metadata == {"comment": "number"}
    place = tmp_path / "site"
    files.publish(lambda p: spark.range(1).write.parquet(p), place)
    files.publish(lambda p: spark.range(3).write.parquet(p), place)
    assert spark.read.parquet(str(place)).count() == 3 and not (tmp_path / "site.old").exists()
    with pytest.raises(Exception):
        files.publish(lambda p: (_ for _ in ()).throw(OSError("no room")), place)
    assert spark.read.parquet(str(place)).count() == 3


STREAM = "edge string, at timestamp, cited string, n long"


def test_streams(spark, tmp_path):
    t = lambda h, m=0: datetime(2025, 1, 1, h, m)
    folder = str(tmp_path / "in")
    for batch in ([("e1", t(0), "A", 1), ("e1", t(0), "A", 1), ("e2", t(0, 30), "A", 2)], [("e1", t(0, 5), "A", 1), ("e3", t(5), "B", 4)], [("e4", t(9), "B", 9)]):
        spark.createDataFrame(batch, STREAM).coalesce(1).write.mode("append").parquet(folder)
    once = incremental.without_repeats(incremental.deliveries(spark, folder, STREAM, 1), "at", ["edge"], "1 day")
    q = once.writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "c1")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(r.edge for r in spark.table("once").collect()) == ["e1", "e2", "e3", "e4"]
    q = incremental.keep_latest(incremental.deliveries(spark, folder, STREAM), ["edge"], "at", str(tmp_path / "latest"), str(tmp_path / "c2"))
    q.awaitTermination(120)
    batch = latest_version(spark.read.parquet(folder), ["edge"], [F.desc("at")])
    assert incremental.read_latest(spark, str(tmp_path / "latest")).select(batch.columns).exceptAll(batch).isEmpty()
    totals = incremental.windowed_totals(incremental.deliveries(spark, folder, STREAM, 1), "at", "1 hour", ["cited"], ["n"], "1 hour")
    q = totals.writeStream.outputMode("append").format("memory").queryName("totals").option("checkpointLocation", str(tmp_path / "c3")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert ("A", 5, 4) in {(r.cited, r.total_n, r.n_rows) for r in spark.table("totals").collect()}


def test_newest_versions_over_several_batches(spark, tmp_path):
    """One file a batch: only touched parts are rewritten, earlier rows stay, a missing list is an error."""
    import os

    inbox, latest = str(tmp_path / "in"), str(tmp_path / "latest")
    schema = "k int, at int, x string"
    rounds = [[(k, 1, "first") for k in range(40)], [(3, 2, "second"), (3, 0, "late"), (41, 1, "new")], [(3, 1, "older"), (7, 5, "third")], [(8, 9, "fourth")]]
    for n, data in enumerate(rounds):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(inbox)
        incremental.keep_latest(incremental.deliveries(spark, inbox, schema), ["k"], "at", latest, str(tmp_path / "c")).awaitTermination(120)
        want = {k: x for k, (_, x) in ((k, max((a, x) for kk, a, x in sum(rounds[: n + 1], []) if kk == k)) for k in {r[0] for r in sum(rounds[: n + 1], [])})}
        assert {r.k: r.x for r in incremental.read_latest(spark, latest).collect()} == want
    os.remove(f"{latest}/v=3.json")
    spark.createDataFrame([(1, 1, "x")], schema).coalesce(1).write.mode("append").parquet(inbox)
    with pytest.raises(Exception, match="missing"):
        incremental.keep_latest(incremental.deliveries(spark, inbox, schema), ["k"], "at", latest, str(tmp_path / "c")).awaitTermination(120)


def test_bound_read_refuses_a_wrong_total(spark, tmp_path):
    spark.range(6).coalesce(1).write.parquet(str(tmp_path / "x"))
    parts = [str(p) for p in (tmp_path / "x").glob("*.parquet")]
    assert files.bound_read(spark, parts, 6).count() == 6
    with pytest.raises(ValueError, match="manifest"):
        files.bound_read(spark, parts, 7)
    stamps = files.file_stamps(spark, parts)
    files.still_bound(spark, stamps)
    with pytest.raises(RuntimeError, match="changed"):
        files.still_bound(spark, {k: (n + 1, t) for k, (n, t) in stamps.items()})


def test_stage_checks_bytes_and_rows(spark, tmp_path):
    import json
    import shutil

    path, other = str(tmp_path / "t"), str(tmp_path / "o")
    make = lambda: spark.range(5).selectExpr("id", "id % 2 = 0 AS even", "map('k', id) AS m")
    files.stage(spark, path, {"v": 1}, make)
    assert files.stage(spark, path, {"v": 1}, None, verify=True).count() == 5
    receipt = json.loads((tmp_path / "t.receipt.json").read_text())
    assert receipt["rows"] == 5 and receipt["bytes"] > 0
    (tmp_path / "t.receipt.json").write_text(json.dumps(receipt | {"digest": 1}))
    (tmp_path / ".t.receipt.json.crc").unlink(missing_ok=True)
    files.stage(spark, path, {"v": 1}, None)
    with pytest.raises(RuntimeError, match="other rows"):
        files.stage(spark, path, {"v": 1}, None, verify=True)
    files.stage(spark, other, {"v": 1}, lambda: spark.range(9))
    shutil.rmtree(path)
    shutil.copytree(other, path)
    with pytest.raises(RuntimeError, match="another size"):
        files.stage(spark, path, {"v": 1}, None)


def test_pinned_documents_and_register_headers(spark, tmp_path):
    import hashlib

    doc = tmp_path / "d.json"
    doc.write_text('{"a": [1]}', encoding="utf-8")
    assert files.read_pinned_json(spark, str(doc), hashlib.sha256(doc.read_bytes()).hexdigest()) == {"a": [1]}
    with pytest.raises(RuntimeError, match="pinned"):
        files.read_pinned_json(spark, str(doc), "0")
    head = ";".join([*files.REGISTER_COLUMNS, "Level 2024"])
    for text, message in ((f"{head};Level 2024\n", "repeats"), (f"{head}\n ;a;b;c;d;e;f;g;h;1\n", "without id")):
        register = tmp_path / "r.csv"
        register.write_text(text, encoding="utf-8-sig")
        with pytest.raises(ValueError, match=message):
            files.read_register(spark, str(register))
