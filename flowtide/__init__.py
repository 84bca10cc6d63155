"""flowtide: trip records to station stock, forecasts and monitoring, on Spark.

Every public function takes and returns DataFrames and stays lazy unless its
docstring says that it writes or fits something.
"""
