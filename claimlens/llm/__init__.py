"""Operators for preparing language-model training data.

Functions of this package that run inside tasks are sent to the executors with the job,
so the executors need the libraries named in the README but not this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
