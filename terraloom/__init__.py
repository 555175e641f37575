"""Territorial statistics on Spark: sources, cleaning, consolidation, graph and models.

Every operator takes DataFrames and returns a DataFrame; actions are confined to
sinks, fixpoints and model fitting, and each of those says so in its docstring.
"""

import sys

from pyspark import cloudpickle

# Functions that run inside tasks travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
