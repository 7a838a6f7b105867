"""The registered queries over the given tables, with their SQL equivalents."""

from workload import events, interest, labels, loads

_PARTS = (labels, interest, events, loads)


def all_queries():
    return {name: run for part in _PARTS for name, run in part.QUERIES.items()}


def all_sql():
    return {name: text for part in _PARTS for name, text in part.SQL.items()}
