"""Job-posting analytics on PySpark: bronze -> staging -> silver -> gold -> index -> search."""

import sys

from pyspark import cloudpickle

# UDFs carry their code with them, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
