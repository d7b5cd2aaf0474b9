"""Web-corpus and link-graph analytics on Spark."""

import sys

from pyspark import cloudpickle

from linkloom.profile import SiteProfile

# Python tasks carry the code they need, so the package need not be installed on
# the executors.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["SiteProfile"]
