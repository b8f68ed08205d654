"""thermogrid: a Spark-native temperature-anomaly engine.

Weather readings come in as keyed messages, are folded to the newest value per
station and hour of day, averaged per station, spread over a latitude/longitude
grid (exact nearest neighbour, Gaussian smoothing, land mask) and compared with
a daily climatology brought onto the same grid. Around that sit the station
selection jobs and the request-log questions (quota, retries, failures).

Every public function takes and returns DataFrames; nothing on the data path is
collected to the driver.
"""

from thermogrid.session import get_spark, checkpoint_root  # noqa: F401

__all__ = ["get_spark", "checkpoint_root"]
