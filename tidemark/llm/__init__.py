"""Operators for preparing large text corpora.

Nothing else in the library imports this subpackage. The functions that run
inside Python tasks are pickled by value, so executors need not have the
package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
