"""Operators for training-data pipelines over ``documents`` and its companions.

Nothing else in the library imports this subpackage. Its Python functions run
in executors, so they are pickled by value: a cluster needs no copy of the
package on its workers.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
