"""claimlake: a PySpark-native medical-claims analytics engine.

Ingest raw claim archives and CSV/Parquet datasets with fixed schemas, clean
and quarantine them, build the beneficiary feature table, fit and score the
annual-cost model with Spark ML, answer the dashboard aggregates, profile
columns in single-pass jobs and ingest new files incrementally with
Structured Streaming.  Everything is expressed with DataFrame / SQL / ML /
Structured Streaming APIs; nothing is collected to the driver on a data path.
"""

from pyspark import cloudpickle as _cloudpickle

import claimlake as _self

# Functions shipped to Python workers (mapInPandas / foreachBatch) are pickled
# by value so executors do not need the package installed.  On a real cluster
# shipping the package with --py-files works just as well.
_cloudpickle.register_pickle_by_value(_self)

__all__ = ["__version__"]
__version__ = "0.1.0"
