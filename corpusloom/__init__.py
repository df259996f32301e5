"""corpusloom: Spark-first operators for versioned document collections."""

__version__ = "0.1.0"
