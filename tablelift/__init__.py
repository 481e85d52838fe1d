"""tablelift: a Spark-native table export engine."""

__version__ = "0.2.0"
