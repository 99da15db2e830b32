"""Declared column types of the landed tables."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the source files.
WEATHER_MEASURES = (
    "DD", "FH", "FF", "FX", "T", "T10N", "TD", "SQ", "Q", "DR", "RH",
    "P", "VV", "N", "U", "WW", "IX", "M", "R", "S", "O", "Y",
)
WEATHER_COLUMNS = ["STN", "YYYYMMDD", "HH", *WEATHER_MEASURES]

WEATHER = T.StructType([T.StructField(c, T.IntegerType()) for c in WEATHER_COLUMNS])

INCIDENTS = T.StructType(
    [
        T.StructField("Incident_ID", T.LongType()),
        T.StructField("Date", T.TimestampType()),
        T.StructField("LON", T.DoubleType()),
        T.StructField("LAT", T.DoubleType()),
        T.StructField("Incident_Starttime", T.TimestampType()),
        T.StructField("Incident_Endtime", T.TimestampType()),
        T.StructField("Incident_Duration", T.StringType()),
        T.StructField("Incident_Priority", T.IntegerType()),
        T.StructField("Service_Area", T.StringType()),
        T.StructField("Municipality", T.StringType()),
        T.StructField("Damage_Type", T.StringType()),
    ]
)

TREE_PROPERTIES = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("jaarVanAanleg", T.IntegerType()),
        *[
            T.StructField(c, T.StringType())
            for c in (
                "boomhoogteklasseActueel",
                "standplaatsGedetailleerd",
                "typeObject",
                "soortnaamTop",
                "stamdiameterklasse",
                "typeSoortnaam",
                "typeEigenaarPlus",
                "soortnaamKort",
            )
        ],
    ]
)

TREE_CATEGORIES = [
    "boomhoogteklasseActueel",
    "typeObject",
    "soortnaamTop",
    "standplaatsGedetailleerd",
]


def area_properties(code: str, name: str, municipality: str = "gemeentenaam") -> T.StructType:
    """Properties of an area level, such as wijkcode and wijknaam or buurtcode and buurtnaam."""
    return T.StructType([T.StructField(c, T.StringType()) for c in (code, name, municipality)])


def feature_collection(properties: T.StructType) -> T.StructType:
    """A GeoJSON page; coordinates stay JSON text until the geometry type is known."""
    geometry = T.StructType(
        [T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())]
    )
    feature = T.StructType(
        [T.StructField("geometry", geometry), T.StructField("properties", properties)]
    )
    return T.StructType(
        [T.StructField("type", T.StringType()), T.StructField("features", T.ArrayType(feature))]
    )
