"""Training-data operators (LM corpus preparation) as Spark jobs.

Each module holds one operator with its general interface; ``queries.py`` holds
the thin registered ``opN_<name>`` queries.  Nothing outside this folder, apart
from the guarded entry point and ``corpus_pipeline.py``, imports it.

Functions of this package that run in Python workers travel with the job
(pickled by value), so executors need the installed libraries only, not a copy
of this package.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
