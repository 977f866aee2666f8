"""Zone-occupancy analytics on PySpark: DataFrame in, DataFrame out."""

import sys

from pyspark import cloudpickle

# Functions run in tasks travel with the job: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
