"""Analytics on topic records, price ticks and event rows, written on the PySpark DataFrame API.

Every operator takes DataFrames and returns a DataFrame, so it works on a batch and, where
Structured Streaming allows, on a stream.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# The few Arrow-batched functions travel inside the tasks, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
