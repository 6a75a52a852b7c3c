"""Enrichment of social-media content as Spark jobs over tables."""

import sys

from pyspark import cloudpickle

# tasks get the functions they run with the plan, so executors need no installed copy
cloudpickle.register_pickle_by_value(sys.modules[__name__])
