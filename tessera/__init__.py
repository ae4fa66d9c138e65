"""tessera: Spark-native text-dataset preparation, decoding and scoring.

Every operator is a plain ``DataFrame -> DataFrame`` (or ``Column -> Column``)
function built from the DataFrame API, SQL functions and higher-order
functions, so Catalyst plans it and Tungsten executes it.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.2.0"

# Functions that run inside Python workers travel with the job, so executors
# need no copy of this package on their import path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
