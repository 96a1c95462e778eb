"""Operators of a training-data pipeline: scoring, formatting, deduplication,
mixing, encoding, search and fingerprints over text tables.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
Functions that run inside tasks are shipped by value, so executors need only
the public libraries, not this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
