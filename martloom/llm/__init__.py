"""Operators of a training-data pipeline: filters, models, fingerprints, joins and mixing over document tables.

Functions of this package travel to the executors with the jobs that use them, so nothing need be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
