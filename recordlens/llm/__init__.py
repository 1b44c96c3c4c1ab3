"""Operators for preparing training text at scale.

Nothing outside this package imports it. Functions that run in tasks are sent by
value, so that the executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
