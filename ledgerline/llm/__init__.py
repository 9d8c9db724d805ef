"""Training-data operators: one module per operator, registered by ``queries``.

Their functions travel to the executors by value, so that executors need the third-party
libraries but not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
