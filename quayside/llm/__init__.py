"""Operators for preparing training data, one module per operator.

Nothing outside this subpackage imports it; ``queries.py`` holds the registered
queries and their SQL. Tasks carry the code of these modules with them, so
executors need numpy and pyarrow, but no copy of this package.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

register_pickle_by_value(sys.modules[__name__])
