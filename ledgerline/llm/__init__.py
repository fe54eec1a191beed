"""Training-data operators. Nothing else in the library imports this subpackage.

Its functions and classes travel to the Python workers by value, so executors need numpy, pyarrow, xxhash and zstandard,
but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
