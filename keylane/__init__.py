"""Keyed event processing on Spark DataFrames and Structured Streaming."""

import sys

from pyspark import cloudpickle

from keylane.options import PipelineOptions

__all__ = ["PipelineOptions"]

# functions and classes of this package travel to the executors with the job
cloudpickle.register_pickle_by_value(sys.modules[__name__])
