"""Operators that prepare text collections for model training.

The functions that run in tasks travel with the job, so that executors need
numpy and Arrow but not this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
