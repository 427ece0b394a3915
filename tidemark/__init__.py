"""tidemark: table archiving, change feeds and catalog profiling on Spark.

Every operator takes and returns DataFrames; planning, pushdown, shuffles
and spilling are left to Catalyst and AQE.
"""

__version__ = "0.1.0"
