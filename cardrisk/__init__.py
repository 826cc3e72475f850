"""Card-payment risk analytics on Spark DataFrames.

Every operator is a ``DataFrame -> DataFrame`` function that can be chained
with ``df.transform(f, ...)``; nothing is evaluated until an action runs.
"""

from cardrisk.session import ensure_conf, get_session, scratch_path

__all__ = ["ensure_conf", "get_session", "scratch_path"]
