"""Operators for large-scale training-data preparation.

One module per operator, plus three shared helpers: `words` (words and word
n-grams of Arrow text batches as numpy arrays), `staging` (tables written to
the cluster's shared folder) and `components` (connected components as joins
and aggregations). Nothing outside this package imports it.
"""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors inside the task, so the
# package needs no installation there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
