"""The registered queries: each library operator on the given tables, with its SQL."""

from paceline.queries import choices, contexts, edges, forecasts, groups, histories, ingest, timing, trees

MODULES = (histories, groups, timing, contexts, ingest, choices, forecasts, edges, trees)


def all_queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def all_sql() -> dict:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
