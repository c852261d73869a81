"""Curate multimodal training corpora and search them by vector, on Spark."""

__version__ = "0.1.0"
