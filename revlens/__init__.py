"""revlens: review analytics as Spark DataFrame operators.

Modules: ``sources`` (tables, derived tables, files), ``functions`` (column
expressions), ``operators`` (aggregate, lod, stats, clean, profile, text,
graph, brush, ml, hints), ``streaming`` and ``plans`` (registered queries with
their DuckDB oracle SQL).
"""

__version__ = "0.1.0"
