"""Operators that build language-model training data out of documents, pages, vectors and chats.

Functions that run inside tasks are pickled by value, so workers need not find this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
