"""recsort: record triage and classification on Spark."""

import sys as _sys

# Ship this package's functions to Python workers by value, so UDFs and
# mapInPandas work whether or not the package is installed on executors.
try:
    from pyspark import cloudpickle as _cp

    _cp.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # pragma: no cover - older pyspark without by-value pickling
    pass
