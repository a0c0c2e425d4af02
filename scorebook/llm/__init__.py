"""Training-data operators: language id, dedup, quality, URL, toxicity, decontamination, WARC audit, packing.

Nothing outside this package imports it. Each module holds one operator with its own general interface;
``queries`` binds them to the given tables and derives the contract's columns.

The functions that run inside tasks travel with the tasks (pickled by value), so executors need numpy and pyarrow
but no installed copy of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
