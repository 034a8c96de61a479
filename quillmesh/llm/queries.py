"""Queries of the text and matching problems."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillmesh.llm.oracles import ORACLES  # noqa: F401
from quillmesh.llm import entity_match, packing, subjects, survivor, tokens
from quillmesh.sources.stages import durable
from quillmesh.sources.tables import table

#: Capacity of a container in tokens.
CONTAINER_TOKENS = 2048


def p1_matches(spark: SparkSession, d: str) -> DataFrame:
    return entity_match.match_register(table(spark, d, "norwegian_membership"), table(spark, d, "source_rows"))


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return p1_matches(spark, d).select("journal_id", "source_id").distinct()


def p1_review(spark: SparkSession, d: str) -> DataFrame:
    """Journals that the strongest rule that says anything leaves undecided: several candidates, or any that only a worn ISSN and a similar title speak for."""
    return entity_match.match_with_queue(table(spark, d, "norwegian_membership"), table(spark, d, "source_rows"))[1]


def p5_survivors(spark: SparkSession, d: str) -> DataFrame:
    return survivor.survivors(table(spark, d, "reviewed_representative"), table(spark, d, "source_rows"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return p5_survivors(spark, d).select("issn_l", "canonical_source_id", F.coalesce("publisher_source_id", F.lit("")).alias("publisher_source_id"))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_corpus(table(spark, d, "documents"))


def _token_sizes(spark: SparkSession, d: str) -> DataFrame:
    return tokens.encode_corpus(table(spark, d, "documents"), sizes_only=True)


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    packed = packing.pack(_token_sizes(spark, d), "doc_id", "size", CONTAINER_TOKENS)
    return packed.withColumnsRenamed({"item_id": "doc_id", "size": "n_tokens"})


def p8_tight(spark: SparkSession, d: str) -> DataFrame:
    packed = packing.pack_tight(_token_sizes(spark, d), "doc_id", "size", CONTAINER_TOKENS)
    return packed.withColumnsRenamed({"item_id": "doc_id", "size": "n_tokens"})


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    """How full the containers of each step of both ways of packing are."""
    sizes = durable(_token_sizes(spark, d))
    reports = [packing.fill_report(way(sizes, "doc_id", "size", CONTAINER_TOKENS), CONTAINER_TOKENS) for way in (packing.pack, packing.pack_tight)]
    return reports[0].unionByName(reports[1].where("step <> 'all'"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    return subjects.assign_subjects(table(spark, d, "documents"), table(spark, d, "doc_labels"), table(spark, d, "subject_areas"))


def p9_composition(spark: SparkSession, d: str) -> DataFrame:
    return subjects.corpus_by_subject(p9_found(spark, d), table(spark, d, "doc_labels"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (p1_found, p1_matches, p1_review, p5_found, p5_survivors, p7_ids, p8_containers, p8_tight, p8_fill, p9_found, p9_composition)}
