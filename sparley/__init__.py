"""Spark-native analytics for transcripts; corpus operators are in sparley.llm."""

from .plans.audit import audit
from .plans.build import build, verify
from .plans.validation import validate
from .sources.datasets import LATEST, download, load_dyads, load_speeches, resolve, summary

__all__ = ["LATEST", "audit", "build", "download", "load_dyads", "load_speeches", "resolve", "summary", "validate", "verify"]
