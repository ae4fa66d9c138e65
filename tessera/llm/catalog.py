"""Queries and SQL of this subpackage's operators."""

from __future__ import annotations

from importlib import import_module

MODULES = ["toxicity", "minhash", "spans", "decontam", "mixing", "quality", "chat", "knn", "langid", "interp",
           "phrases", "negatives", "warc"]

QUERIES: dict = {}
ORACLE_SQL: dict = {}
for _name in MODULES:
    _module = import_module(f"tessera.llm.{_name}")
    QUERIES.update(_module.QUERIES)
    ORACLE_SQL.update(_module.ORACLE_SQL)
