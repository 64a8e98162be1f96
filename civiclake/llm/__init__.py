"""Operators of a training-data pipeline over documents, pages, conversations
and embeddings. Nothing else in the library imports this subpackage."""

import sys

from pyspark import cloudpickle

# the functions that run inside tasks travel with the tasks, so executors need
# numpy, pyarrow and the tokenizer libraries but not this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
