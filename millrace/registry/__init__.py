"""All registered queries."""

from millrace.registry import core, features, ingest, models, retail, statistics, texts  # noqa: F401


def all_queries():
    return dict(core.QUERIES)


def all_oracles():
    return dict(core.ORACLES)
