"""Operations for preparing training data at scale. Nothing else in the library imports this subpackage.

Functions of these modules that run on executors travel with their jobs, so executors need no copy of the package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
