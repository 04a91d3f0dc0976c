"""Analytics of counts over ordered scales, written as Spark DataFrame jobs."""

__version__ = "0.1.0"
