"""Transit feed lakehouse on Spark: feeds in, typed and versioned tables out."""

__version__ = "0.1.0"
