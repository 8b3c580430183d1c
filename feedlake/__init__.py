"""feedlake: feeds of articles to clean tables, chunks, vectors and answers, on Spark."""

import sys

from pyspark import cloudpickle

# Functions of this package that run in Python workers are sent there with the
# task, so the package need not be installed on executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
