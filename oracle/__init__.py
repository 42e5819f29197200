"""Fixture images over the driver's tables and the DuckDB text of every query."""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
