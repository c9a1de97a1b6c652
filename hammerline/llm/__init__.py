"""Operators for preparing text corpora; nothing outside this package imports it.

Functions of the package travel to the executors by value, so that only the driver needs the
package on its path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
