"""covlens — news and social coverage analytics on Spark.

Landed payloads are normalised to one item schema, folded into a keyed
snapshot, tagged with native column expressions (or a pluggable model
call), and summarised as DataFrames.  Every operator is a
DataFrame -> DataFrame function or a Column expression.
"""

__version__ = "0.1.0"
