"""actiflow: customer-activity analytics on Spark, in batch and as a stream.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
expressions, so the same code serves a static table, a micro-batch inside
``foreachBatch`` and (where Spark allows it) a streaming plan.
"""

from actiflow.session import get_session, work_root

__all__ = ["get_session", "work_root"]
