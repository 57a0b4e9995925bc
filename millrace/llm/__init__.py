"""Operators for training data of language models, and their queries over the given tables."""

import sys

from pyspark import cloudpickle

from millrace.llm import queries  # noqa: F401  (importing registers the queries)
from millrace.llm.registry import ORACLES, QUERIES

# Functions of this subpackage travel to the executors whole, so these need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["ORACLES", "QUERIES"]
