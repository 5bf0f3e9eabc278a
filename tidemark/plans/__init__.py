from tidemark.plans.load import BaseDirs, LoadResult, load_batch, run_load

__all__ = ["BaseDirs", "LoadResult", "load_batch", "run_load"]
