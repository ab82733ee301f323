"""Operators of a training-data pipeline over ``documents``, ``embeddings``,
``pages`` and ``conversations``.  Nothing else in the library imports this
package; ``queries.py`` registers its queries."""

import sys

from pyspark import cloudpickle

# Python workers get these functions by value: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
