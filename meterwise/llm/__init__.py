"""Operators for preparing language-model training text, and their queries.

Nothing else in the library imports this package. Functions that run inside
Spark's Python workers are pickled by value, so a cluster needs no copy of the
package on its executors.
"""

from __future__ import annotations

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
