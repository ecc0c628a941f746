"""Operators of a training-data pipeline over document and embedding tables.

Each module holds one operator with its own general interface; ``queries`` registers one
query per operator over the given tables. Nothing else in the library imports this
subpackage. Code that runs in Python workers is shipped by value, so executors need
not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
