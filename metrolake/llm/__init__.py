"""Training-data operators. Executors need no copy of this package: its functions travel by value."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
