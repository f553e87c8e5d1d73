"""sparkloom: a PySpark-native engine for auditable corpus processing."""

import sys

from pyspark import cloudpickle

# Python functions travel to the executors by value, so a cluster needs no
# installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
