"""Training-data operators: dedup, search, packing, filters, tokenizers, chat.

Functions of this package travel to the executors by value, so a cluster needs
the listed libraries there, but not this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
