"""ledgerlens: star-schema sales and payment analytics as Spark DataFrame jobs.

Subpackages:
  sources    -- raw parquet tables and the mapped star / sales schemas
  functions  -- Column recipes with SQL Server semantics (dates, text, numbers)
  operators  -- reusable DataFrame operators (binning, pivots, windows,
                cohorts, RFM, distributed ranking, exact top-k, NOT IN)
  plans      -- the named reports (``plans.registry.QUERIES``) and their
                DuckDB oracle statements
"""

__version__ = "0.1.0"
