"""Training-data operators, one module each; nothing else in the library imports this subpackage.

Functions of the subpackage travel to the executors with the tasks that call
them, so a cluster needs no copy of it.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
