"""Interaction analytics as Spark jobs: sampling, temporal features, retrieval, evaluation."""

import sys

from pyspark import cloudpickle

# Functions used inside tasks travel with the job, so executors need no install.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
