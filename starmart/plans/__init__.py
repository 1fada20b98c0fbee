"""Plans: marts and analytic queries over warehouse tables.

Every function takes ``t``, a mapping from table name to DataFrame (a
published ``catalog.Warehouse`` or an in-memory load), and returns a
DataFrame. Nothing here writes.
"""
