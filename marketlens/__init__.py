"""marketlens — marketplace analytics expressed as Spark DataFrame plans.

Layout:
  sources/    readers: driver parquet tables, stand-in marketplace tables, CSV loader
  functions/  column-expression helpers (time arithmetic, exact ratios, text cleaning)
  operators/  reusable DataFrame operators (keep-first dedup, key repair, quality
              rules, row expansion, text features, model training / scoring)
  plans/      the thirteen named business queries, one function each
  runner      batch run of named queries with per-query fault isolation
"""

__all__ = ["__version__"]
__version__ = "0.1.0"
