"""Operators for preparing training text. Nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# Executors need no copy of this package: functions of its modules travel with the tasks that call them.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
