"""PySpark-native network-flow analytics."""

import sys

from pyspark import cloudpickle

# Functions sent to Python workers carry their code along, so nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
