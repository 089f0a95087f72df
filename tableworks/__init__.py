"""tableworks: table loading and joins as plain Spark DataFrame functions.

Planning and execution are Spark's: every function here builds a DataFrame
plan (or writes one through the session's catalog) and leaves join algorithms,
pushdown, pruning and adaptive re-planning to Catalyst and AQE.
"""

from tableworks.functions import *  # noqa: F401,F403
from tableworks.operators import *  # noqa: F401,F403
from tableworks.sources import *  # noqa: F401,F403
