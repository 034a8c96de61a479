"""Registered queries and their SQL twins."""

from quillmesh.plans import general_oracles, general_problems, journal_oracles, journal_queries

QUERIES = {**general_problems.QUERIES, **journal_queries.QUERIES}
ORACLES = {**general_oracles.ORACLES, **journal_oracles.ORACLES}
FLAGSHIP = "network_scores"
