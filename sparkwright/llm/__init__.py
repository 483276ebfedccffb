"""Operators for preparing training text, one module each, and their registered queries (``queries``).

Nothing else in the library imports this subpackage. Functions that run inside tasks are pickled by
value, so executors need numpy and pyarrow but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
