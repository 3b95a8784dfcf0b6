"""Operators for preparing language-model training data.

Nothing outside this subpackage imports it; ``__spark_entry__.py`` adds its
queries when it is present.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
