"""Operations of a training-data pipeline, each a Spark job over whole tables."""

import sys

from pyspark import cloudpickle

# Python tasks carry these modules with them: executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
