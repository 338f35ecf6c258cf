"""tallystar: coded-statistics star schemas on PySpark.

The operators take DataFrames and column names and return lazy DataFrames
without Python UDFs. Only bounded facts reach the driver: file listings, CSV
headers, the years of a table, the rows of a check report. See README.md for
the module map.
"""

__version__ = "0.1.0"
