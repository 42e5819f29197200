"""bandsaw: image segmentation analytics as Spark DataFrame jobs.

An image is decoded by one task and cut there into *bands* (a bounded number of
full-width rows plus a halo). All later steps work band by band, so a large
image spreads over the cluster from then on like many small ones.
"""

import sys

from pyspark import cloudpickle

# Task functions travel with the job, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
