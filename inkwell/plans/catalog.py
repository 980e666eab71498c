"""All registered queries of the engine with their DuckDB equivalents."""

from __future__ import annotations

from inkwell.plans import checks, curation, evaluation, generation, splits, validation

MODULES = (splits, validation, evaluation, curation, generation, checks)


def queries():
    return {name: f for m in MODULES for name, f in m.registry.queries.items()}


def oracle_sql():
    return {name: s for m in MODULES for name, s in m.registry.sql.items()}


def flagship(spark, sf_dir):
    """Writer-disjoint splits with their samples."""
    return splits.split_writer_held_out(spark, sf_dir)
