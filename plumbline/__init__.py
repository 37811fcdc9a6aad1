"""Document and statistics analytics on Spark."""

import sys

from pyspark import cloudpickle

# Functions of this package that run on executors travel with their code, so that the package has to be
# importable on the driver only.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
