"""Sky-frame analytics on Spark DataFrames: sky masks, sun discs and sun tracks for many cameras and days."""

import sys

from pyspark import cloudpickle

# the few Arrow helpers travel with their jobs, so executors need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])
