"""A social-event lake on Spark: typed layers, dashboard marts, quality and telemetry.

Every operator is a function from DataFrames to a DataFrame.  No operator keeps a session,
and none reads the wall clock unless the caller leaves ``as_of`` unset.
"""

__version__ = "0.1.0"
