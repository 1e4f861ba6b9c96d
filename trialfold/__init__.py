"""trialfold — experiment analytics (metric logs, trial state, search spaces)
expressed as Spark DataFrame plans.

Every operator is a plain function ``(DataFrame, ..., params) -> DataFrame``
built from Spark SQL column expressions, joins, windows, aggregates or
Structured Streaming, so that one job serves all experiments at once.
"""

from trialfold.session import get_session, checkpoint_dir  # noqa: F401

UNAVAILABLE = "unavailable"
