"""newsloom: media-monitoring analytics as PySpark DataFrame operators."""

import sys

from pyspark import cloudpickle

# Python helpers travel inside the tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
