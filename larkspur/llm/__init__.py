"""Operators of a training-data pipeline: scoring, tokenizing, language, web archives, mixing, search and dedup.

Nothing else in the library imports this subpackage.  Every operator takes DataFrames and returns a DataFrame, and reads
only the columns it names; ``queries.py`` holds one thin query per operator.
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python tasks travel with their code, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
