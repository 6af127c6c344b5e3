"""Training-data operators: thirteen independent operators over a ``documents``-like
table (doc_id, text, lang, source, ...) and the queries that apply them.

Python helpers used inside tasks are pickled by value, so executors need the
third-party packages but no copy of this package.
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

_cloudpickle.register_pickle_by_value(_sys.modules[__name__])
