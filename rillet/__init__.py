"""rillet: analytics jobs over tables and streams, written as PySpark DataFrame plans.

Every transform is a plain function ``DataFrame -> DataFrame`` (or a small
builder returning one).  Nothing here collects data to the driver; the
heavy lifting is left to Catalyst (pushdown, pruning, partial aggregation,
adaptive join selection) and to Structured Streaming for the stream forms.
"""

import sys as _sys

try:
    # Pandas-UDF bodies (panes, external programs, keyed state) are shipped
    # with their code, so executors need not have this package installed.
    from pyspark import cloudpickle as _cloudpickle

    _cloudpickle.register_pickle_by_value(_sys.modules[__name__])
except Exception:  # noqa: BLE001 - older cloudpickle: install the package on executors instead
    pass

__all__ = ["session", "model"]
