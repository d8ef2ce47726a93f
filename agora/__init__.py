"""agora: threaded-discussion analytics and dataset building on PySpark.

Sub-packages
------------
sources    reading, writing, staging and the keyed result table
functions  Column -> Column helpers (text, prompts, rewards, numbers)
operators  DataFrame -> DataFrame building blocks
plans      end-to-end jobs composed from the operators
catalog    the registered queries, their input views and their SQL checks
"""

import sys

from pyspark import cloudpickle

# Functions that run in Python workers travel with the job, so executors need
# no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
