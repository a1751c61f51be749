"""Operators that prepare text corpora for training language models."""

import sys

from pyspark import cloudpickle

# Functions for tasks travel with their code, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
