"""Named end-to-end queries (one per inventory row) and their oracles."""

from kiln.plans.registry import ORACLE, QUERIES, query  # noqa: F401
from kiln.plans import retail, profiling, projections, basket, sequence, vectors, sources, modelling  # noqa: F401,E402


def all_queries():
    return dict(QUERIES)


def all_oracles():
    return dict(ORACLE)
