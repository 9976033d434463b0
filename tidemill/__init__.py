"""Batch and streaming data work on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from tidemill.session import apply_settings, build_session, shared_folder

# Functions sent to Python workers carry this package's code with them, so that
# executors do not need it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["apply_settings", "build_session", "shared_folder"]
