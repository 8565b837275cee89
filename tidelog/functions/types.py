"""Column types of the source: names in its dictionary, output types of both formats, decoded values.

Mappings are columns over ``(type, precision, scale)``, so that a table of columns is mapped at once; what
a type cannot be mapped to is null, and the caller routes or refuses it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidelog.functions import values

#: Dictionary names and the kinds that they stand for.
NAMES = {
    "VARCHAR2": "VARCHAR2", "VARCHAR": "VARCHAR2", "CHAR": "CHAR", "NVARCHAR2": "NVARCHAR2", "NCHAR": "NCHAR", "NUMBER": "NUMBER", "INTEGER": "NUMBER", "DECIMAL": "NUMBER", "FLOAT": "FLOAT",
    "BINARY_FLOAT": "BINARY_FLOAT", "BINARY_DOUBLE": "BINARY_DOUBLE", "DATE": "DATE", "RAW": "RAW", "LONG": "LONG", "LONG RAW": "LONG_RAW", "CLOB": "CLOB", "NCLOB": "NCLOB", "BLOB": "BLOB", "BFILE": "BFILE",
    "XMLTYPE": "XMLTYPE", "SYS.XMLTYPE": "XMLTYPE", "BOOLEAN": "BOOLEAN", "JSON": "JSON", "ROWID": "ROWID", "UROWID": "UROWID",
}
UNDECODABLE = ["BOOLEAN", "JSON", "VECTOR", "BFILE", "UNKNOWN"]
TEXT = ["VARCHAR2", "CHAR", "NVARCHAR2", "NCHAR", "LONG", "ROWID", "UROWID"]
LARGE = ["CLOB", "NCLOB", "BLOB", "XMLTYPE"]


def kind(name: Column) -> Column:
    """Kind of a dictionary type name."""
    t = F.upper(F.trim(name))
    zone = F.when(t.contains("LOCAL TIME ZONE"), "TIMESTAMP_LTZ").when(t.contains("TIME ZONE"), "TIMESTAMP_TZ").otherwise("TIMESTAMP")
    known = F.create_map(*[F.lit(x) for pair in NAMES.items() for x in pair])
    return (
        F.when(t.startswith("TIMESTAMP"), zone)
        .when(t.startswith("INTERVAL YEAR"), "INTERVAL_YM")
        .when(t.startswith("INTERVAL DAY"), "INTERVAL_DS")
        .when(t.startswith("VECTOR"), "VECTOR")
        .otherwise(F.coalesce(F.try_element_at(known, t), F.lit("UNKNOWN")))
    )


def _integer(precision: Column) -> Column:
    return F.when(precision < 3, "int8").when(precision < 5, "int16").when(precision < 10, "int32").when(precision < 19, "int64")


def envelope_type(k: Column, precision: Column, scale: Column, decimals: str = "PRECISE", temporals: str = "ADAPTIVE") -> Column:
    """Output type in the nested format; precision and scale are -1 where the dictionary has none."""
    iso = temporals == "ISO_STRING"
    if decimals == "PRECISE":
        exact = F.when((k == "FLOAT") | (precision < 0), "struct<scale:int32,value:bytes>").when((scale <= 0) & (precision < 19), _integer(precision)).otherwise(F.concat(F.lit("decimal:"), F.greatest(scale, F.lit(0)).cast("string")))
    else:
        exact = F.lit({"STRING": "string", "DOUBLE": "float64"}[decimals])
    digits = F.when(scale < 0, 6).otherwise(scale)
    stamp = F.lit("string") if iso else F.when(digits <= 3, "int64:ms").when(digits <= 6, "int64:us").otherwise("int64:ns")
    return (
        F.when(k.isin(*TEXT, "CLOB", "NCLOB", "XMLTYPE"), "string")
        .when(k.isin("RAW", "LONG_RAW", "BLOB"), "bytes")
        .when(k == "BINARY_FLOAT", "float32")
        .when(k == "BINARY_DOUBLE", "float64")
        .when(k.isin("NUMBER", "FLOAT"), exact)
        .when(k == "DATE", "string" if iso else "int64:ms")
        .when(k == "TIMESTAMP", stamp)
        .when(k.isin("TIMESTAMP_TZ", "TIMESTAMP_LTZ"), "string" if iso else "string:zoned")
        .when(k.isin("INTERVAL_YM", "INTERVAL_DS"), "string" if iso else "float64:us")
    )


def flat_type(k: Column, precision: Column, scale: Column, numeric: str = "NONE", default_scale: int = 127, dates: str = "TIMESTAMP") -> Column:
    """Output type in the flat format; null for types that its records leave out."""
    own_scale = F.when((precision < 0) & (scale < 0), default_scale).when(precision < 0, F.greatest(F.lit(0), scale)).otherwise(scale)
    number = F.concat(F.lit("decimal:"), own_scale.cast("string"))
    if numeric != "NONE":
        whole = (precision > 0) & ((scale == 0) if numeric == "PRECISION_ONLY" else (scale <= 0)) & (precision < 19)
        rest = {"PRECISION_ONLY": number, "BEST_FIT_OR_DECIMAL": number, "BEST_FIT_OR_DOUBLE": F.lit("float64"), "BEST_FIT_OR_STRING": F.lit("string")}[numeric]
        broken = F.lit(False) if numeric == "PRECISION_ONLY" else (precision < 0) | (scale > 0)
        number = F.when(whole, _integer(precision)).when(broken, "float64").otherwise(rest)
    return (
        F.when(k.isin(*TEXT), "string")
        .when(k.isin("RAW", "LONG_RAW"), "bytes")
        .when(k == "FLOAT", "float64")
        .when(k == "NUMBER", number)
        .when(k == "DATE", "date" if dates == "DATE" else "timestamp:ms")
        .when(k.isin("TIMESTAMP", "TIMESTAMP_TZ", "TIMESTAMP_LTZ"), "timestamp:ms")
    )


def exact_integer(text: Column, bits: int) -> Column:
    """A number text as an integer of so many bits; null where it has a fraction or does not fit (never rounded or wrapped)."""
    n = text.try_cast("decimal(38,10)")
    low, high = -(1 << (bits - 1)), (1 << (bits - 1)) - 1
    fits = (n == F.floor(n)) & n.between(F.lit(low).cast("decimal(38,0)"), F.lit(high).cast("decimal(38,0)"))
    return F.when(fits, n.try_cast("bigint"))


def decode(k: str, value: Column) -> Column:
    """A literal's text as a Spark value of its kind; null where it does not fit, which with a non-null text is an error."""
    if k in TEXT or k in ("CLOB", "NCLOB", "XMLTYPE", "NUMBER", "FLOAT", "TIMESTAMP_TZ"):
        return value  # numbers keep their text: their scale is open
    if k == "BINARY_FLOAT":
        return value.try_cast("float")
    if k == "BINARY_DOUBLE":
        return value.try_cast("double")
    if k == "DATE":
        return values.local_time(value)
    if k == "TIMESTAMP":
        return F.try_to_timestamp(F.regexp_replace(value, r"(\.\d{6})\d+$", "$1")).cast("timestamp_ntz")
    if k == "TIMESTAMP_LTZ":
        return values.zoned_instant(value)
    if k == "INTERVAL_YM":
        return values.months(value)
    if k == "INTERVAL_DS":
        return values.interval_micros(value)
    if k in ("RAW", "LONG_RAW", "BLOB"):
        return values.hex_bytes(value)
    raise ValueError(f"{k} cannot be decoded")


def _fields(text: str) -> T.StructType:
    kinds = {"long": T.LongType(), "int": T.IntegerType(), "string": T.StringType(), "ntz": T.TimestampNTZType(), "boolean": T.BooleanType()}
    return T.StructType([T.StructField(n, kinds[k]) for n, k in (f.split(":") for f in text.split())])


#: The 34 columns of a mined row, in order.
RAW_ROW = _fields(
    "SCN:long START_SCN:long COMMIT_SCN:long TIMESTAMP:ntz COMMIT_TIMESTAMP:ntz THREAD#:int XIDUSN:long XIDSLT:long XIDSQN:long OPERATION:string OPERATION_CODE:int ROLLBACK:int STATUS:int INFO:string "
    "SEG_OWNER:string SEG_NAME:string TABLE_NAME:string USERNAME:string SESSION#:long SERIAL#:long CLIENT_ID:string ROW_ID:string RS_ID:string SSN:long CSF:int DATA_OBJ#:long DATA_OBJD#:long DATA_OBJV#:long "
    "SRC_CON_ID:int CON_ID:int SRC_CON_NAME:string SRC_CON_DBID:long SQL_REDO:string SQL_UNDO:string"
)
#: The source block of a nested record.
SOURCE_BLOCK = _fields(
    "version:string connector:string name:string ts_ms:long snapshot:string db:string sequence:string schema:string table:string txId:string scn:string commit_scn:string rs_id:string ssn:long redo_thread:int "
    "user_name:string row_id:string pdb:string reselect:string"
)
