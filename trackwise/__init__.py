"""Trip and vehicle features from GPS points, as Spark DataFrame jobs."""

__version__ = "0.1.0"
