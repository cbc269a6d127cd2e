"""Operators for preparing training text at scale (language, quality, tokens, duplicates, mixing)."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions that run in executors travel with the job: executors need no copy of this package.
register_pickle_by_value(sys.modules[__name__])
