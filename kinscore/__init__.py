"""kinscore: look-alike scoring of sellers as Spark DataFrame jobs.

Feature dataset (``plans.dataset``), scoring and list selection (``plans.recommend``) and
the end-to-end job with its sinks (``plans.job``).
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# functions that run in Python workers travel by value: executors need numpy and pandas, not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
