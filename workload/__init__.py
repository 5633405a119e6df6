"""The library's operators as queries over the test tables, each with its SQL counterpart."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
