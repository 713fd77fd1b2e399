"""tallywright: text, profiling, ranking, clustering and model jobs as Spark DataFrame plans."""

__version__ = "0.1.0"
