"""Training-data operators for web-scale corpora (secret scans, URL filters,
near-duplicate joins, decontamination, quality rules and models, BPE, line and
substring deduplication, WARC).

Nothing outside this package imports it. Functions that run on executors are
pickled by value, so a cluster needs numpy and pyarrow there, not this package.
"""

from pyspark import cloudpickle as _cloudpickle
import sys as _sys

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
