"""Operators for building training data: mixing, formatting, search, filters, deduplication.

Functions that run in Python workers are sent by value, so an executor needs
numpy and pyarrow but no copy of this package.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
