"""Training-data operators: near-dedup, mixing, quality, secrets, line dedup,
token shards, sharding, passage dedup, toxicity, decontamination, personal data,
ranked search, spelling variants.

Nothing else in the library imports this subpackage.  Operators are in one
module each; ``queries.py`` applies them to the driver's tables and ``sql.py``
holds the DuckDB statements for those that SQL can express.

Functions that run in Python workers are pickled by value, so executors need the
installed third-party libraries but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
