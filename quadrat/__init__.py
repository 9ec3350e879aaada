"""quadrat: research-data preparation and applied econometrics as Spark DataFrame jobs."""

__version__ = "0.1.0"
