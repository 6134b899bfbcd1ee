"""Operators for preparing language-model training data, as Spark jobs.

Nothing else in the library imports this subpackage. Its functions are shipped
to executors by value, so a cluster needs no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
