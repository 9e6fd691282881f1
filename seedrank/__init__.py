"""seedrank: seed-set recommendation over large item tables, as Spark DataFrame jobs."""

__version__ = "0.1.0"
