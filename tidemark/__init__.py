"""Usage metrics and listing analytics as PySpark DataFrame operators.

Operators take and return DataFrames and never create a session. The few steps
that must look at the data before the plan is complete (fits, histogram edges,
size checks) read a bounded number of scalars.
"""

import sys

from pyspark import cloudpickle

# Functions shipped to Python workers travel with the job, so that executors
# need no copy of this package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
