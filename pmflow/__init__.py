"""pmflow: prediction-market trade analytics as Spark DataFrame jobs.

Every public function takes and returns DataFrames (or Columns); nothing is
collected to the driver. See README.md for the module map.
"""

__version__ = "0.1.0"
