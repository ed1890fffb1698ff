"""Driver query registry: ``name -> (callable(spark, sf_dir), oracle SQL or None)``.

Each family module exposes ``QUERIES``; :func:`registry` merges them.
Oracle SQL runs in DuckDB against views named after the tables.
"""

from __future__ import annotations

import importlib

FAMILIES = ["clustering", "cleaning", "profiling", "splitting", "evaluation",
            "encoding", "text", "vectors", "models", "sources"]


def registry() -> dict[str, tuple]:
    out: dict[str, tuple] = {}
    for fam in FAMILIES:
        mod = importlib.import_module(f"spindle.queries.{fam}")
        for name, spec in mod.QUERIES.items():
            if name in out:
                raise ValueError(f"duplicate query {name}")
            out[name] = spec
    return out
