"""ragtide: hybrid retrieval and QA evaluation as Spark DataFrame operators."""

__version__ = "0.1.0"
