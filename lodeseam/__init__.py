"""lodeseam: a Spark-native engine for discovering, cataloguing and curating web documents.

Functions that run on executors are pickled by value, so a cluster needs no copy of this
package on its workers' path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
