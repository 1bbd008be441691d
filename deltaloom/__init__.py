"""Change-log synchronisation and consolidation as ordinary Spark plans."""

import sys

from pyspark import cloudpickle

from deltaloom.model import TableSpec

# The few Python functions that run inside tasks travel with the task, so the
# package need not be installed on the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["TableSpec"]
