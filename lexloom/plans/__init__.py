"""Registered queries, each next to the SQL that checks it."""

from __future__ import annotations

from lexloom.plans import corpus, items, labelling, replies, tokens, vectors

MODULES = (corpus, labelling, vectors, replies, items, tokens)

QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
