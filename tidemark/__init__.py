"""Slowly changing dimension loads on Spark."""

from tidemark.plans import BaseDirs, LoadResult, load_batch, run_load
from tidemark.spec import TableSpec

__all__ = ["BaseDirs", "LoadResult", "TableSpec", "load_batch", "run_load"]
