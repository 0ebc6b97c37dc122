"""Connected-car trip analytics on Spark.

Trip-summary messages (nested JSON, batch or stream) are parsed into typed
rows and rolled up into per-day and per-hour driving metrics, score
distributions, device liveness and a key/field/value serving view.  Every
operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions; the streaming package runs the same operators incrementally.
"""

from tripmetrics.session import build_session, checkpoint_root

__all__ = ["build_session", "checkpoint_root"]
