"""Pinned inputs and files with a fixed contract."""

from __future__ import annotations

import csv
import hashlib
import json
import os
from collections.abc import Iterable, Mapping, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quillmesh.operators.register import unpivot_levels

# --- manifests ------------------------------------------------------------------------------------------------


def manifest_files(manifest: str | os.PathLike, root: str | os.PathLike) -> list[str]:
    """Paths that a manifest lists (``{"files": [{"path", "bytes"}], "total_bytes"}``), checked before anything is read.

    Only listed files count; a path that leaves the root, is listed twice, is missing or has another size is an error.
    """
    listed = json.loads(Path(manifest).read_text(encoding="utf-8"))
    base, seen, total, out = Path(root).resolve(), set(), 0, []
    for entry in listed["files"]:
        path = (base / entry["path"]).resolve()
        if Path(entry["path"]).is_absolute() or not path.is_relative_to(base):
            raise ValueError(f"path leaves the snapshot: {entry['path']}")
        if path in seen:
            raise ValueError(f"path is listed twice: {entry['path']}")
        if not path.is_file() or path.stat().st_size != entry["bytes"]:
            raise ValueError(f"file is missing or has another size: {entry['path']}")
        seen.add(path)
        total += entry["bytes"]
        out.append(str(path))
    if "total_bytes" in listed and listed["total_bytes"] != total:
        raise ValueError(f"total size is {total}, the manifest says {listed['total_bytes']}")
    return out


def bound_read(spark: SparkSession, files: Sequence[str], rows: int | None = None, schema=None) -> DataFrame:
    """Rows of listed files that did not change while they were counted; a file of another size or time, or another row total, is an error.

    Nothing is copied: the count reads footers only, and :func:`still_bound` repeats the look at the files after whatever was made of the rows.
    """
    before = file_stamps(spark, files)
    found = read_listed(spark, files, schema)
    n = found.count()
    still_bound(spark, before)
    if rows is not None and n != rows:
        raise ValueError(f"{n} rows, the manifest says {rows}")
    return found


def file_stamps(spark: SparkSession, files: Sequence[str]) -> dict[str, tuple[int, int]]:
    """Size and time of every file, on whatever file system it is."""
    out = {}
    for f in files:
        fs, hadoop = _filesystem(spark, f)
        status = fs.getFileStatus(hadoop(f))
        out[f] = (status.getLen(), status.getModificationTime())
    return out


def still_bound(spark: SparkSession, stamps: Mapping[str, tuple[int, int]]) -> None:
    if file_stamps(spark, list(stamps)) != dict(stamps):
        raise RuntimeError("an input file changed while it was read")


def write_manifest(files: Iterable[str | os.PathLike], root: str | os.PathLike, manifest: str | os.PathLike) -> None:
    """Manifest of files under a root."""
    entries = [{"path": str(Path(f).resolve().relative_to(Path(root).resolve())), "bytes": Path(f).stat().st_size} for f in sorted(map(str, files))]
    Path(manifest).write_text(json.dumps({"files": entries, "total_bytes": sum(e["bytes"] for e in entries)}, indent=1), encoding="utf-8")


def read_listed(spark: SparkSession, files: Sequence[str], schema: T.StructType | str | None = None) -> DataFrame:
    """Rows of listed Parquet files with ``source_file`` and ``source_row``; folder names are no columns, missing columns are null."""
    reader = spark.read.option("mergeSchema", schema is None).option("recursiveFileLookup", True)
    rows = (reader.schema(schema) if schema is not None else reader).parquet(*files)
    return rows.select("*", F.col("_metadata.file_path").alias("source_file"), F.col("_metadata.row_index").alias("source_row"))


def rows_at(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows at listed positions (source_file, source_row); the reader skips row groups, the join keeps the rest out."""
    return rows.join(wanted.select("source_file", "source_row").distinct(), ["source_file", "source_row"], "left_semi")


def pick_columns(rows: DataFrame, alternatives: Mapping[str, Sequence[str]]) -> DataFrame:
    """Columns under fixed names from whichever of their alternative names exist; absent ones are null."""
    have = set(rows.columns)
    return rows.select(*[F.coalesce(*[F.col(c) for c in names if c in have], F.lit(None)).alias(name) for name, names in alternatives.items()])


# --- register and hand-over text files ------------------------------------------------------------------------

# Column names of the register file.
REGISTER_COLUMNS = ["journal_id", "Original Title", "International Title", "Print ISSN", "Online ISSN", "NPI Academic Discipline", "NPI Scientific Field", "Series", "Ceased"]


def read_register(spark: SparkSession, path: str) -> DataFrame:
    """Long register (one row per journal and year) of a semicolon-separated file with one ``Level <year>`` column a year."""
    names = next(csv.reader([spark.read.text(path).first()[0].lstrip("\ufeff")], delimiter=";"))
    if len({n.strip() for n in names}) != len(names):
        raise ValueError("register repeats a column name")
    wide = spark.read.csv(path, sep=";", header=True, encoding="UTF-8", mode="FAILFAST", multiLine=True, escape='"')
    wide = wide.toDF(*[c.lstrip("﻿").strip() for c in wide.columns])
    missing = [c for c in REGISTER_COLUMNS if c not in wide.columns]
    if missing or not any(c.startswith("Level ") for c in wide.columns):
        raise ValueError(f"register lacks columns: {missing or ['Level <year>']}")
    if not wide.where("coalesce(trim(journal_id), '') = ''").isEmpty():
        raise ValueError("register has an entry without id")
    return unpivot_levels(wide, REGISTER_COLUMNS)


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed rows of a header CSV in which only the empty cell is null; texts such as NA stay texts."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    raw = spark.read.csv(path, header=True, schema=texts, nullValue="", emptyValue="\0", mode="FAILFAST", enforceSchema=False, escape='"', multiLine=True)
    return raw.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])


def write_single_csv(rows: DataFrame, path: str, null: str = "\\N") -> int:
    """One UTF-8 file with byte order mark for a bounded export; rows stream through the driver partition by partition."""
    columns, n = rows.columns, 0
    partial = f"{path}.partial"
    with open(partial, "w", encoding="utf-8-sig", newline="") as out:
        writer = csv.writer(out, lineterminator="\n", quoting=csv.QUOTE_STRINGS)
        writer.writerow(columns)
        for row in rows.toLocalIterator(prefetchPartitions=True):
            writer.writerow([null if v is None else str(v).lower() if isinstance(v, bool) else repr(v) if isinstance(v, float) else v for v in row])
            n += 1
    os.replace(partial, path)
    return n


def read_single_csv(spark: SparkSession, path: str, schema: T.StructType, null: str = "\\N") -> DataFrame:
    """Rows of a file made by :func:`write_single_csv`, under the same types."""
    texts = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    raw = spark.read.csv(path, header=True, schema=texts, nullValue=null, emptyValue="", mode="FAILFAST", escape='"', multiLine=True)
    return raw.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema])


def assert_same_rows(left: DataFrame, right: DataFrame) -> None:
    """Every row in both, with the same number of repeats."""
    if not left.exceptAll(right).isEmpty() or not right.exceptAll(left).isEmpty():
        raise ValueError("rows differ after the round trip")


# --- stages with receipts -------------------------------------------------------------------------------------


def contract_hash(contract: Mapping) -> str:
    return hashlib.sha256(json.dumps(contract, sort_keys=True, default=str).encode()).hexdigest()


def table_digest(rows: DataFrame) -> dict[str, int]:
    """Rows and a digest of their content that needs no order and combines map-side; repeated rows count."""
    text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sorted(rows.columns)]))
    one = rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.shiftright(F.xxhash64(text), 20)), F.lit(0)).alias("digest")).first()
    return {"rows": one["rows"], "digest": one["digest"]}


def stored_bytes(spark: SparkSession, path: str) -> int:
    fs, hadoop = _filesystem(spark, path)
    return fs.getContentSummary(hadoop(path)).getLength()


def stage(spark: SparkSession, path: str, contract: Mapping, build, verify: bool = False) -> DataFrame:
    """The table at ``path``, built by ``build()`` only if there is no complete one under the same contract.

    The table is written beside its place and moved; the receipt comes last, so a table without one is incomplete and
    refused.  Another contract, or another number of bytes than the receipt has, is an error, never silently
    overwritten; ``verify`` reads the rows again and compares their digest as well.
    """
    fs, hadoop = _filesystem(spark, path)
    target, partial, receipt = hadoop(path), hadoop(f"{path}.partial"), hadoop(f"{path}.receipt.json")
    digest = contract_hash(contract)
    if fs.exists(receipt):
        held = json.loads(spark.read.text(f"{path}.receipt.json", wholetext=True).first()[0])
        if held["contract"] != digest:
            raise RuntimeError(f"{path} was made under another contract")
        if held["bytes"] != stored_bytes(spark, path):
            raise RuntimeError(f"{path} has another size than its receipt")
        found = spark.read.parquet(path)
        if verify and table_digest(found) != {k: held[k] for k in ("rows", "digest")}:
            raise RuntimeError(f"{path} has other rows than its receipt")
        return found
    if fs.exists(target):
        raise RuntimeError(f"{path} has no receipt: incomplete")
    fs.delete(partial, True)
    build().write.option("compression", "zstd").parquet(f"{path}.partial")
    fs.rename(partial, target)
    made = {"contract": digest, "bytes": stored_bytes(spark, path), **table_digest(spark.read.parquet(path))}
    out = fs.create(receipt, False)
    out.write(bytearray(json.dumps(made).encode()))
    out.close()
    return spark.read.parquet(path)


def read_pinned_json(spark: SparkSession, path: str, sha256: str | None = None) -> dict:
    """A configuration or decision document; with ``sha256`` any other content is an error."""
    text = spark.read.format("binaryFile").load(path).first()["content"]
    if sha256 is not None and hashlib.sha256(text).hexdigest() != sha256:
        raise RuntimeError(f"{path} is not the pinned document")
    return json.loads(bytes(text).decode("utf-8-sig"))


def _filesystem(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    make = lambda p: jvm.org.apache.hadoop.fs.Path(p)
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


# --- published layouts ----------------------------------------------------------------------------------------


def write_annual(rows: DataFrame, path: str) -> None:
    """One folder per score year; a filter on the year prunes the rest.

    A year is cut into ranges of ids, each a file of its own in order, so no task writes a whole year.
    """
    rows.repartitionByRange("score_year", "journal_id").sortWithinPartitions("score_year", "journal_id").write.mode("overwrite").partitionBy("score_year").parquet(path)


def write_shards(rows: DataFrame, path: str) -> None:
    """History by the last two characters of the id; each shard is written by one task, sorted by id."""
    sharded = rows.withColumn("shard", F.right("journal_id", F.lit(2)))
    sharded.repartition("shard").sortWithinPartitions("journal_id", "score_year").write.mode("overwrite").partitionBy("shard").parquet(path)


def read_history(spark: SparkSession, path: str, journal_id: str) -> DataFrame:
    """All years of one journal; shard pruning and a pushed-down filter leave one file."""
    return spark.read.parquet(path).where((F.col("shard") == journal_id[-2:]) & (F.col("journal_id") == journal_id)).drop("shard")


def described(rows: DataFrame, dictionary: Mapping[str, str]) -> DataFrame:
    """Rows whose columns carry their description; a column without one is an error."""
    unknown = [c for c in rows.columns if c not in dictionary]
    if unknown:
        raise ValueError(f"no description for: {', '.join(unknown)}")
    return rows.select(*[F.col(c).alias(c, metadata={"comment": dictionary[c]}) for c in rows.columns])


def publish(build, place: str | os.PathLike) -> None:
    """Build a folder aside and swap it in; a failure leaves what was there."""
    place = Path(place)
    aside, old = place.with_name(place.name + ".new"), place.with_name(place.name + ".old")
    build(str(aside))
    if place.exists():
        place.rename(old)
    try:
        aside.rename(place)
    except OSError:
        if old.exists():
            old.rename(place)
        raise
    if old.exists():
        import shutil

        shutil.rmtree(old)


def synthetic_journals(spark: SparkSession, n: int, years: Sequence[int], seed: int = 7) -> DataFrame:
    """Seeded journal years for tests and trials, the same for a seed whatever the partitioning."""
    u = lambda salt: (F.pmod(F.xxhash64("i", "score_year", F.lit(seed), F.lit(salt)), F.lit(1_000_003)) / 1_000_003)
    base = spark.range(n).select(F.col("id").alias("i"), F.explode(F.array(*[F.lit(y) for y in years])).alias("score_year"))
    works = F.floor(1 + 400 * u("w") * u("x"))
    return base.select("score_year", F.format_string("%07d", "i").alias("journal_id"), works.alias("works_raw"), F.floor(works * u("f")).alias("works_filtered"), F.floor(works * 6 * u("c")).alias("citations"), (u("n") < 0.3).alias("in_n"), F.lit(True).alias("in_oa"))
