"""docquery: searching, editing and casting collections of documents held as Spark tables."""

__version__ = "0.1.0"
