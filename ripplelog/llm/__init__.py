"""Operators for preparing training text, and the queries that apply them to the test tables.

Python code that runs inside tasks travels with the task, so executors need no copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
