"""Operators for building training corpora (near-duplicates, language, toxicity, ...).

Nothing else in the library imports this subpackage. Its Python workers code is
pickled by value, so executors need no installed copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
