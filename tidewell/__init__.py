"""Tidewell: a PySpark-native warehouse of traffic and trade streams.

Every operator is a plain function from DataFrame to DataFrame.  The same
functions serve batch tables and, unless they are listed in
``tidewell.streaming``, Structured Streaming sources.
"""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel with their code: no machine needs this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__version__ = "0.1.0"
