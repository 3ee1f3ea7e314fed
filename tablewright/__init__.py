"""tablewright: profile folders of delimited files and load them as keyed
tables, as Spark DataFrame jobs."""

__version__ = "0.1.0"
