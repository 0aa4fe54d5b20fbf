"""tidemark: point-in-time analytics for keyed time series on Spark DataFrames."""

from pyspark import cloudpickle as _cloudpickle

import tidemark as _self

# Functions sent to Python workers carry their code, so workers need no copy of the package.
_cloudpickle.register_pickle_by_value(_self)
