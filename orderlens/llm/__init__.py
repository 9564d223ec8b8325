"""Training-data operators: one module per operator, registered in ``catalog``.

Nothing outside this package (and ``corpus_pipeline.py``) imports it.  Task
functions of these modules are pickled by value, so executors need only the
libraries, not this package on their path.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
