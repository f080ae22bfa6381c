"""quillstream: a PySpark-native analytics engine for text corpora, vectors and conversation streams."""

__version__ = "0.1.0"
