"""kiln: retail, profiling, basket, modelling and sequence analytics on PySpark.

Every operator takes and returns DataFrames / Columns; the work is expressed with
the DataFrame API, Spark SQL functions and ``pyspark.ml`` so that it runs on
executors and is planned by Catalyst.

Functions of this package that run in Python workers are sent there whole, with
what they refer to: workers need numpy and pyarrow, not the package.
"""

import sys

from pyspark import cloudpickle

from kiln.session import get_session, configure, scratch_dir  # noqa: F401

cloudpickle.register_pickle_by_value(sys.modules[__name__])
