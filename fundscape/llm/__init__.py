"""Operators for preparing training corpora; nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# Functions that run on executors travel with the job, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
