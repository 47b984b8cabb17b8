"""Operations for preparing training text: the dealt operators, their queries and their SQL."""

import sys

from pyspark import cloudpickle

# Functions of this package travel to the executors whole, which therefore need not have it installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
