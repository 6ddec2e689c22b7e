"""lateline: order-fulfilment and delivery-performance analytics on Spark.

Every operator is a ``DataFrame -> DataFrame`` function built from Spark SQL
built-ins, so Catalyst plans it and the work runs distributed.  See
``lateline.plans.weekly.run_weekly`` for the end-to-end weekly job.
"""

from lateline.config import Config, DEFAULT_CONFIG

__all__ = ["Config", "DEFAULT_CONFIG"]
