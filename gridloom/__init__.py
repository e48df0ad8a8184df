"""gridloom: set-based intake of messy tables on Spark.

Every operator takes and returns DataFrames keyed by ``file_id`` (and ``sheet_idx``),
so one plan serves any number of differently laid-out files.
"""

__version__ = "0.1.0"
