"""Operators of a training-data pipeline: sharding, packing, deduplication, scoring and scans.

Every operator takes a ``documents``-shaped DataFrame (``doc_id``, ``text``, any further columns) and
returns a DataFrame.  Spark partitions and shuffles the work; numpy and Arrow run inside tasks over
bounded blocks.  The package is shipped to the Python workers by value, so executors need only the
public libraries, not an installed copy of this repository.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
