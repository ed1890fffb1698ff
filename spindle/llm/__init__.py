"""Operations of a training-data pipeline, each a Spark job of its own.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.
"""

import sys

from pyspark import cloudpickle

# Functions that run in tasks travel by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
