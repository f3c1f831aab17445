"""Release analytics on Spark: declarative operators over DataFrames."""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions that run on executors travel with the job, so workers need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
