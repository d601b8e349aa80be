"""Road-camera traffic analytics expressed as Spark DataFrame and Structured Streaming jobs."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers carry their code along, so workers need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
