"""Wire and table schemas (one place, no inference)."""

from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType


def _s(*fields):
    return StructType([StructField(n, t, True) for n, t in fields])


# JSON payloads as the producers write them; ``timestamp`` is text and goes
# through ``functions.time.event_time`` (epoch ms, 'yyyy-MM-dd HH:mm:ss', ISO Z).
BUS_GPS = _s(("bus_id", StringType()), ("route_id", StringType()),
             ("lat", DoubleType()), ("lon", DoubleType()),
             ("speed_kmh", DoubleType()), ("occupancy_pct", IntegerType()),
             ("timestamp", StringType()))

# ``aqi`` is read as DOUBLE: an INT parse turns 120.5 into null, which the
# null rule would then mislabel.
AIR_QUALITY = _s(("sensor_id", StringType()), ("zone", StringType()),
                 ("pm25", DoubleType()), ("pm10", DoubleType()),
                 ("no2", DoubleType()), ("aqi", DoubleType()),
                 ("timestamp", StringType()))

SMART_METERS = _s(("meter_id", StringType()), ("ward_id", StringType()),
                  ("kwh_reading", DoubleType()), ("voltage", DoubleType()),
                  ("power_factor", DoubleType()), ("timestamp", StringType()))

TRAFFIC_SIGNALS = _s(("junction_id", StringType()), ("zone", StringType()),
                     ("avg_wait_sec", DoubleType()), ("timestamp", StringType()))

ZONE_PROFILE = _s(("zone", StringType()), ("zone_name", StringType()),
                  ("population", IntegerType()), ("num_schools", IntegerType()))

ROUTE_SCHEDULE = _s(("route_id", StringType()), ("route_name", StringType()),
                    ("terminal", StringType()),
                    ("scheduled_arrival_time", StringType()))
