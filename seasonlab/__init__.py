"""Season tables, lineups and path drill-downs as PySpark DataFrame operators."""

__version__ = "0.1.0"
