"""Operators for preparing training text. Nothing else in the library imports this package."""

from __future__ import annotations

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors with their code, so that the
# executors need no copy of it on their own path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
