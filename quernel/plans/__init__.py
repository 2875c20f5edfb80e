"""Registered queries on the given tables, and the SQL that checks them."""

from quernel.plans import colours, files, groups, logs, models, orders, paths, series, streams, text, upkeep

MODULES = [orders, text, groups, logs, series, paths, colours, streams, models, files, upkeep]


def all_queries():
    return {name: query for module in MODULES for name, query in module.QUERIES.items()}


def all_oracles():
    return {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
