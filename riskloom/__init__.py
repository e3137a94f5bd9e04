"""Relational feature engineering and model evaluation on PySpark."""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions travel to the workers with their code, so workers need no copy of this package.
register_pickle_by_value(sys.modules[__name__])
