"""tenderloom — procurement monitoring expressed as Spark DataFrame jobs.

Every public function takes DataFrames or Columns and returns DataFrames or
Columns; nothing is collected on the driver and ``today`` is always a parameter.
"""

import sys

from pyspark import cloudpickle

from tenderloom.settings import Settings

# tasks get the package's functions themselves, so workers need no copy of it
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["Settings"]
