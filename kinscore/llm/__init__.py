"""Operators for preparing language-model training data.

One module per operator, thin contract queries in ``queries.py``, DuckDB statements in
``oracle.py``. Nothing outside this subpackage (and ``corpus_pipeline.py``) imports it.

Python functions of this package travel to the executors by value, so a cluster needs the
third-party libraries but not this repository on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
