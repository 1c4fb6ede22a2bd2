"""Operators for preparing training data: dedup, packing, mixing, tokens, chat, quality, URLs, search.

Functions of this package that run in Python workers travel with their code, so the
workers need not have the package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
