"""millrace: instruction-data curation and request-log analytics as Spark jobs."""

__version__ = "0.1.0"
