"""curatrix: dataset curation on Spark, written as DataFrame plans."""

__version__ = "0.1.0"
