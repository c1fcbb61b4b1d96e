"""Sources: the nine marketplace tables, from reference-format CSV files or as
stand-ins derived from the driver's parquet tables."""

from marketlens.sources.marketplace import Marketplace, register_views  # noqa: F401
