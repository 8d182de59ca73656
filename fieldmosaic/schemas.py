"""Core table schemas, the label-to-type map and the table constraints."""

from __future__ import annotations

from pyspark.sql import types as T

AREA_LEVELS = ("county", "town")
STAGES = ("raw", "masked")

# Storage label -> Spark type.
LABEL_TYPES = {
    "text": T.StringType(),
    "integer": T.LongType(),
    "float": T.DoubleType(),
    "boolean": T.BooleanType(),
    "datetime": T.TimestampType(),
    "json": T.StringType(),
    "geometry": T.StringType(),
}

AREAS = (
    "area_id string, area_level string, COUNTYID string, COUNTYCODE string, COUNTYNAME string,"
    "COUNTYENG string, TOWNID string, TOWNCODE string, TOWNNAME string, TOWNENG string,"
    "geometry string, shp_version string, created_at timestamp"
)
AREA_COLUMNS = [field.split()[0] for field in AREAS.split(",")]
AREA_KEY = ["area_id", "shp_version"]

LEDGER = (
    "id long, area_id string, area_level string, classification string, shp_version string,"
    "stage string, file_path string, layer_updated boolean, recorded_at timestamp"
)
LEDGER_KEY = ["area_id", "classification", "shp_version", "stage"]
LEDGER_FOLDERS = ["shp_version", "classification"]

PIXELS = (
    "area_id string, shp_version string, classification string, row int, col int,"
    "b smallint, g smallint, r smallint"
)

COLOR_MAP = (
    "layer string, data_type string, b int, g int, r int, label string,"
    "value_num double, value_code string, value_vec array<double>"
)


def label_of(dtype: T.DataType, column: str = "") -> str:
    """Storage label of a Spark type; what is not known is kept as text."""
    if column == "geometry":
        return "geometry"
    if isinstance(dtype, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return "integer"
    if isinstance(dtype, (T.DoubleType, T.FloatType, T.DecimalType)):
        return "float"
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return "datetime"
    if isinstance(dtype, (T.VariantType, T.StructType, T.MapType, T.ArrayType)):
        return "json"
    return "text"


def type_of(label: str) -> T.DataType:
    return LABEL_TYPES.get(label, T.StringType())
