"""Operators of a training-data pipeline, each by the method its module names."""

import sys

from pyspark import cloudpickle

# what tasks run is sent with the job, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
