"""wayfold: DataFrame operators for road-survey point clouds, poses and detections."""

import sys

from pyspark import cloudpickle

# ship our small task-side helpers by value: executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
