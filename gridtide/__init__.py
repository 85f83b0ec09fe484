"""Keep a time-stamped measurement table current and trustworthy, as Spark jobs."""

__version__ = "0.1.0"
