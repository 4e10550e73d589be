"""Operations for training-data pipelines: one module per operator, queries in ``queries``.

Functions of this package reach the Python workers by value, so executors need no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
