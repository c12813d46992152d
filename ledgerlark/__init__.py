"""ledgerlark: Spark-native feed reconciliation and weather-sensitivity analytics.

Every operator is a function ``DataFrame(s) -> DataFrame``; nothing is
collected to the driver. See README.md for the module map.
"""

from ledgerlark.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
