"""Deeply nested records as flat child tables.

The flattening works on Arrow buffers: list offsets give the parent of
every element (``list_parent_indices``), element values are taken from the
flattened child array, keys are propagated by a vectorised ``take`` and
positions are index arithmetic.  No row is ever turned into a Python object.

JSON payloads are brought into the same typed nested form in the JVM first:
key spelling (case, underscores) is ignored, a single value stands for a list
of one, text that lists several ids is a list, objects that wrap an id give
the id.  Payloads that do not parse as a JSON object give no rows.

Defined results: positions count from 0 and include null and blank elements;
null arrays and empty arrays give no rows; a null record id is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillmesh.functions.ids import blank_to_null, entity_id

NESTED_TYPE = "record_id long, primary_source string, locations array<struct<id:string,issn:array<string>>>, refs array<string>"
CHILD_TYPE = "record_id long, child string, parent_pos int, pos int, child_key string"
_CHILD_ARROW = pa.schema([("record_id", pa.int64()), ("child", pa.string()), ("parent_pos", pa.int32()), ("pos", pa.int32()), ("child_key", pa.string())])


def element_positions(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(parent index, position in the parent) of every element of a list array."""
    parents = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.searchsorted(parents, parents, side="left")
    return parents, np.arange(len(parents)) - starts


def _rows(ids: pa.Array, child: str, parent_pos, pos, keys: pa.Array, keep: pa.Array) -> pa.RecordBatch:
    n = len(keys)
    columns = [ids, pa.DictionaryArray.from_arrays(pa.array(np.zeros(n, "int32")), [child]).cast(pa.string()), pa.array(parent_pos, pa.int32()), pa.array(pos, pa.int32()), keys.cast(pa.string())]
    return pa.RecordBatch.from_arrays([c.filter(keep) for c in columns], schema=_CHILD_ARROW)


def flatten_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Child rows of batches of :data:`NESTED_TYPE`, child table after child table."""
    for b in batches:
        ids, primary, locations, refs = (b.column(i) for i in range(4))
        n = len(ids)
        yield _rows(ids, "primary_source", np.full(n, -1), np.zeros(n), primary, primary.is_valid())

        at, pos = element_positions(locations)
        places = pc.list_flatten(locations)
        owners = ids.take(pa.array(at))
        present = places.is_valid()
        place_ids = pc.struct_field(places, [0])
        yield _rows(owners, "location", np.full(len(at), -1), pos, pc.fill_null(place_ids, ""), present)

        issns = pc.struct_field(places, [1])
        inner_at, inner_pos = element_positions(issns)
        values = pc.list_flatten(issns)
        yield _rows(owners.take(pa.array(inner_at)), "location_issn", pos[inner_at], inner_pos, values, values.is_valid())

        at, pos = element_positions(refs)
        values = pc.list_flatten(refs)
        yield _rows(ids.take(pa.array(at)), "reference", np.full(len(at), -1), pos, values, values.is_valid())


def flatten(nested: DataFrame) -> DataFrame:
    """(record_id, child, parent_pos, pos, child_key) of nested rows; narrow, no shuffle."""
    return nested.mapInArrow(flatten_batches, CHILD_TYPE)


def typed_records(works: DataFrame) -> DataFrame:
    """Nested form of rows that already have typed nested columns."""
    place = lambda x: F.when(x.isNotNull(), F.struct(entity_id(x["source"]["id"], "S").alias("id"), F.transform(x["source"]["issn"], _issn_as_written).alias("issn")))
    return works.select(
        F.col("record_id").cast("long").alias("record_id"),
        entity_id(F.col("primary_location.source.id"), "S").alias("primary_source"),
        F.transform("locations", place).alias("locations"),
        F.transform("referenced_works", lambda x: entity_id(x, "W")).alias("refs"),
    )


def _issn_as_written(x: Column) -> Column:
    return F.when(blank_to_null(x).isNotNull(), x)


def _member(entries: Column, *names: str) -> Column:
    """First non-null value among the entries of a JSON object whose key reads as one of ``names``."""
    wanted = [n.replace("_", "") for n in names]
    hit = F.filter(entries, lambda e: F.regexp_replace(F.lower(e["key"]), "[^a-z0-9]", "").isin(wanted) & e["value"].isNotNull())
    return F.try_element_at(hit, F.lit(1))["value"]


def _object(text: Column) -> Column:
    """Entries (key, JSON text) of a JSON object; null for anything else."""
    return F.map_entries(F.when(text.rlike(r"^\s*\{"), F.from_json(text, "map<string,string>", {"allowNonNumericNumbers": "true"})))


def _list(text: Column, split_text: bool) -> Column:
    """Elements as JSON text: a JSON array, a single object, a single value or text that lists several."""
    array = F.from_json(text, "array<string>")
    single = F.array(text)
    listed = F.transform(F.split(text, r"[;|,]"), lambda x: F.trim(x)) if split_text else single
    plain = F.when(text.rlike(r"[;|,]"), listed).when(text.rlike(r"\S\s+\S"), F.split(F.trim(text), r"\s+")).otherwise(single) if split_text else single
    return F.when(text.rlike(r"^\s*\["), array).when(text.rlike(r"^\s*\{"), single).when(F.trim(text) != "", plain)


def _id_of(text: Column, *wrappers: str) -> Column:
    """The id in a plain value, in an object with an id or in an object that wraps such an object."""
    outer = _object(text)
    inner_text = _member(outer, *wrappers)
    inner = F.when(inner_text.rlike(r"^\s*\{"), _member(_object(inner_text), "id")).otherwise(inner_text)
    return F.when(text.rlike(r"^\s*\{"), F.coalesce(_member(outer, "id"), inner)).otherwise(text)


def parsed_records(raw: DataFrame, record_id: str = "record_id", payload: str = "payload") -> DataFrame:
    """Nested form of JSON payloads; unreadable ones are left out."""
    text = F.col(payload)
    readable = raw.where(text.rlike(r"^\s*\{") & F.try_parse_json(text).isNotNull())
    entries = readable.select(F.col(record_id).cast("long").alias("record_id"), _object(text).alias("e"))
    parts = entries.select(
        "record_id",
        F.try_element_at(_list(_member(F.col("e"), "primary_location"), False), F.lit(1)).alias("primary_location"),
        _list(_member(F.col("e"), "locations"), False).alias("locations"),
        _list(_member(F.col("e"), "referenced_works"), True).alias("refs"),
    )

    def source_of(place: Column) -> Column:
        return F.when(place.rlike(r"^\s*\{"), _member(_object(place), "source")).otherwise(place)

    def location(place: Column) -> Column:
        source = source_of(place)
        issns = F.when(source.rlike(r"^\s*\{"), F.transform(_list(_member(_object(source), "issn", "issns"), True), _issn_as_written))
        return F.when(place.isNotNull(), F.struct(entity_id(_id_of(source, "source"), "S").alias("id"), issns.alias("issn")))

    return parts.select(
        "record_id",
        entity_id(_id_of(source_of(F.col("primary_location")), "source"), "S").alias("primary_source"),
        F.transform("locations", location).alias("locations"),
        F.transform("refs", lambda x: entity_id(_id_of(x, "work", "source"), "W")).alias("refs"),
    )
