"""Operators for preparing language-model training data.  Nothing outside this
subpackage (and ``corpus_pipeline.py``) imports it."""

import sys

from pyspark import cloudpickle

# functions that run in tasks travel with them: executors need not have this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
