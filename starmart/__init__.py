"""starmart: a star-schema sales warehouse built on Spark DataFrames.

Layers: ``sources`` (read + stage raw tables, calendar), ``operators``
(SCD merges, point-in-time lookups, fact loads, quality checks, global
ranks), ``plans`` (marts and analytic queries), ``streaming`` (an
incremental feed), and ``runs`` / ``catalog`` (audited runs published as
snapshots).
"""

__all__ = ["config", "session"]
