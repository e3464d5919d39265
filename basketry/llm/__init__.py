"""Operators for preparing text corpora (training data) with Spark.

Nothing else in the package imports this subpackage.  One module per operator;
``queries.py`` holds the registered queries and their DuckDB statements.

Functions that run in Python workers are shipped by value, so workers need not have the
package installed; broadcast values are plain tuples of arrays for the same reason.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
