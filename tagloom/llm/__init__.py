"""Operators for training text: language, duplicates, licences, mixing, packing, search, url rules."""

from pyspark import cloudpickle

import tagloom

# Functions that run in tasks carry this package's code with them: executors need no copy of it.
cloudpickle.register_pickle_by_value(tagloom)
