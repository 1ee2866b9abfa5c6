"""Operators for preparing training text; each module states its method and its edge cases.

Functions of this package travel to the workers by value, so they need not be installed there.
"""
import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
