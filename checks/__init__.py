"""Every operator as a query over the test tables, with the SQL that must agree with it."""

from checks import columns, events, history, insights, normal, pipelines, quality, storage

MODULES = (columns, normal, history, insights, quality, events, pipelines, storage)


def all_queries() -> dict:
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def all_sql() -> dict:
    return {name: sql for module in MODULES for name, sql in module.SQL.items()}
