"""Training-data operators for text and embedding corpora.

Nothing else in the library imports this subpackage; it uses the library's
session and table helpers only.  ``queries.py`` holds the registered queries
and their DuckDB SQL.

The functions that run inside tasks are sent with the job, code and all, so a cluster
needs the package on the driver alone.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
