"""DataFrame-to-DataFrame operators for document-layout, sequence and text analytics on Spark."""

import sys

from pyspark import cloudpickle

# Functions sent to executors carry their code, so workers need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
