"""Operators of a large-scale training-data pipeline; nothing else in the library imports them.

The functions that run inside tasks are shipped with the job (pickled by
value), so executors need only numpy, pyarrow and zstandard installed, not
this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
