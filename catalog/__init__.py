"""Registered queries: each operator over the given tables, with its SQL."""

from . import labels, pages, reports, scalars, storage, tables

QUERIES = {}
for _module in (reports, scalars, tables, labels, pages, storage):
    QUERIES.update(_module.QUERIES)
