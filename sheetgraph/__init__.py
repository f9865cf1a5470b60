"""sheetgraph: a Spark-first engine for connectivity graphs of engineering sheets."""

__version__ = "0.1.0"
