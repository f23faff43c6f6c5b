"""finlake: financial-statement, price and news analytics as Spark jobs.

Subpackages: ``sources`` (readers), ``sinks`` (writers and the load ledger),
``functions`` (column expressions and fixed values), ``operators`` (as-of
join, skew-safe series, modes, scaling), ``plans`` (ingest, dashboard KPIs,
news, sentiment, features, forecasts, monitoring), ``streaming``
(incremental ingest trigger).
"""

__version__ = "0.1.0"
