"""Column expressions; all native unless the module says otherwise."""

import sys

from pyspark import cloudpickle

# UDFs carry this code to the executors, so it need not be installed there.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
