"""millrace: user-level data operations on Spark DataFrames.

Every public function takes DataFrames and returns DataFrames (or Columns, for
``millrace.functions``).  Work stays lazy unless a docstring says otherwise.
"""

import sys

from pyspark import cloudpickle

# Python functions that run on executors travel with their code, so the package
# need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
