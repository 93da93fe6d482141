"""Operators for training-data pipelines, one module each.

Nothing else in the library imports this package.  ``queries`` registers one
query per operator; ``corpus_pipeline.py`` at the repository top chains five
of them.
"""

import sys

from pyspark import cloudpickle

# Functions of this package that run in tasks travel with them, so executors
# need no copy of the library.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
