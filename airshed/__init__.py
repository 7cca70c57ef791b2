"""airshed: measurement analytics on Spark.

Layers (raw -> Bronze -> Silver -> Gold), the Gold reports, run-history
monitoring and data-quality checks, all written as DataFrame -> DataFrame
functions over built-in Spark expressions.
"""

from airshed.session import build_session, checkpoint_dir

__all__ = ["build_session", "checkpoint_dir"]
