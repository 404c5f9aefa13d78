"""Skill-demand and teaching-supply analytics as PySpark table operators."""

import sys

from pyspark import cloudpickle

# Python functions travel to the workers by value, so the package need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
