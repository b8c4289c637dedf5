"""Operators for large training corpora: parsing, filtering, deduplication, packing, token files.

Nothing outside this folder (and ``corpus_pipeline.py``) imports it.
Functions that run in Python workers are shipped by value, so that executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
