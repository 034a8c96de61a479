"""Every registered core query against its SQL twin on the smallest folder."""

import pytest

from quillmesh import plans

from .conftest import DATA
from .oracle import compare


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_query_equals_its_sql(spark, name):
    compare(spark, f"{DATA}/sf0.001", plans.QUERIES[name], plans.ORACLES[name])


def test_every_core_query_has_sql():
    assert set(plans.QUERIES) == set(plans.ORACLES)


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(plans.QUERIES) <= set(entry.queries())


def test_register_entries_are_json(spark):
    import json

    from quillmesh.operators import register
    from quillmesh.plans import base

    m = base.matched_register(spark, f"{DATA}/sf0.001")
    titles = m.select("score_year", "journal_id").selectExpr("score_year", "journal_id", "'T' as title", "'12345679' as print_issn", "cast(null as string) as online_issn")
    for r in register.display_entries(m, titles).collect():
        entries = json.loads(r.entries_json)
        assert len(entries) == r.n_entries and entries[0]["print"] == "1234-5679" and "online" not in entries[0]
