"""Real-time warehouse analytics on Spark DataFrames and Structured Streaming."""

import sys

from pyspark import cloudpickle

# Functions sent to executors take their code along: the package is needed on the driver only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
