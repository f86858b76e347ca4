"""Operations of a training-data pipeline over whole text tables.

Nothing outside this subpackage imports it; ``queries`` holds the registered
queries and ``oracle`` their DuckDB SQL where SQL can express them.

Functions that run inside tasks travel with the task, so executors need not
have this package installed.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
