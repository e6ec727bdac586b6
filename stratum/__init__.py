"""stratum: a medallion lakehouse (Bronze / Silver / Gold) on plain PySpark."""

__version__ = "0.1.0"
