"""gleanworks: record collection, entity resolution and table upkeep on Spark DataFrames."""

__version__ = "0.1.0"
