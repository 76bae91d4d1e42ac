"""Training-data operators: deduplication, scanning, filtering, mixing,
tokenization and packing of document tables. Nothing outside this folder,
``corpus_pipeline.py`` and ``tests/llm`` imports it."""

import sys

from pyspark import cloudpickle

# Python tasks get this folder's functions by value, so executors need no
# copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
