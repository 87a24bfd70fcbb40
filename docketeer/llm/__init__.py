"""Operators for preparing training text; nothing else in the library imports them.

Tasks get the functions of these modules by value, as executors need not have the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
