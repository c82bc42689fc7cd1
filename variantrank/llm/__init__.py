"""Training-data operators. Nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with the job, so that nothing has to be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
