"""Operators for preparing language-model training data, each over whole tables.

``QUERIES`` and ``CHECKS`` hold the registered queries and, where SQL can say
the same, their checks. Functions that run inside workers are pickled by value,
so workers need not find this package on their own path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
