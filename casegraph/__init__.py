"""Case cohorts, case graphs and similar-case retrieval as Spark DataFrame operators."""

import sys

from pyspark import cloudpickle

# The few Python functions that run in tasks travel with their code, so workers need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
