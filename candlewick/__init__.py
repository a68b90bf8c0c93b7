"""candlewick — a Spark-native OHLC price-mart engine.

Daily open/high/low/close bars go through the usual medallion layers:
raw CSV -> silver bars -> cleaned/enriched prices -> star schema
(asset dimension, calendar dimension, price fact) -> serving queries,
quality checks and statistics.  Every operator takes and returns a
DataFrame and is expressed with built-in Spark expressions, so Catalyst
plans the whole chain and the work is spread over the cluster.
"""

__version__ = "0.1.0"

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors by value, so a session
# whose executors cannot import the package still runs them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
