"""fleetlens: storage-fleet failure-risk analytics as PySpark DataFrame operators.

Every public operator takes DataFrames (or Columns) and returns DataFrames (or
Columns).  Work is expressed with built-in Spark SQL functions, joins,
aggregates and windows so Catalyst can prune, push down and plan it.
"""

import sys as _sys


def _ship_by_value() -> None:
    """Pickle this package's functions by value, so the few Python steps that run inside
    tasks (ZIP expansion, CSV header peek) work on executors without the package installed."""
    try:
        from pyspark import cloudpickle
        cloudpickle.register_pickle_by_value(_sys.modules[__name__])
    except Exception:  # noqa: BLE001  (older cloudpickle: the package must then be on the executors)
        pass


_ship_by_value()

from fleetlens.session import get_spark, scratch_path  # noqa: E402

__all__ = ["get_spark", "scratch_path"]
