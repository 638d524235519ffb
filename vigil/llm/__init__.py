"""Operators of a training-data pipeline, each a ``DataFrame -> DataFrame`` function.

Nothing else in the library imports this subpackage. Its worker functions are
pickled by value, so executors need only the public libraries they use, not an
installed copy of the package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
