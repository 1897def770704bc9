"""salesengine — a Spark-native cleaning job and report library for sales
transactions. See README.md for the module map."""

__version__ = "0.1.0"
