"""glossmill: Spark-first preparation of sign-language corpora and of text for training."""

__version__ = "0.1.0"
