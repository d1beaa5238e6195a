"""Data work on feeds of files, expressed as Spark DataFrame operators."""

__version__ = "0.1.0"
