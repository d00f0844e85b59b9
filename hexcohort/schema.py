"""Fixed schemas of the subscriber, event, tower and POI tables."""

from __future__ import annotations

from pyspark.sql import types as T

from hexcohort import constants as K

_NUMERIC = K.MOBILITY + K.VOLUME + K.TEMPORAL + K.POI_SCORES + K.NETWORK + ["monthly_charges", "tenure_months"]

SUBSCRIBER = T.StructType(
    [T.StructField("subscriber_id", T.StringType()),
     T.StructField("true_persona_id", T.IntegerType()),
     T.StructField("true_persona_name", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in ("home_lat", "home_lon", "work_lat", "work_lon")]
    + [T.StructField(c, T.StringType()) for c in ("home_h3", "work_h3")]
    + [T.StructField(c, T.DoubleType()) for c in _NUMERIC]
    + [T.StructField("senior_citizen", T.IntegerType()),
       T.StructField("internet_service", T.StringType()),
       T.StructField("same_h3_zone", T.IntegerType())]
)

# Both spellings of the voice field and of the position are accepted.
EVENT = T.StructType(
    [T.StructField("subscriber_id", T.StringType()), T.StructField("event_time", T.StringType())]
    + [T.StructField(c, T.DoubleType()) for c in K.SCORE_DEFAULTS]
    + [T.StructField("call_minutes", T.DoubleType()),
       T.StructField("location_lat", T.DoubleType()), T.StructField("location_lon", T.DoubleType()),
       T.StructField("senior_citizen", T.IntegerType())]
)

TOWER = T.StructType([
    T.StructField("radio", T.StringType()), T.StructField("mcc", T.IntegerType()),
    T.StructField("net", T.IntegerType()), T.StructField("area", T.LongType()),
    T.StructField("cell", T.LongType()), T.StructField("unit", T.IntegerType()),
    T.StructField("lon", T.DoubleType()), T.StructField("lat", T.DoubleType()),
    T.StructField("range", T.IntegerType()), T.StructField("samples", T.IntegerType()),
    T.StructField("changeable", T.IntegerType()), T.StructField("created", T.LongType()),
    T.StructField("updated", T.LongType()), T.StructField("averageSignal", T.IntegerType()),
])

_NODE = T.StructType([
    T.StructField("type", T.StringType()), T.StructField("id", T.LongType()),
    T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType()),
    T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
])
POI_DOCUMENT = T.StructType([T.StructField("elements", T.ArrayType(_NODE))])
POI_NODE = _NODE
