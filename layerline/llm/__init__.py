"""Operators for training data. Nothing else in the library imports this package.

Functions of this package that run in Python workers travel with the plan, so the
package need not be installed on the executors.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
