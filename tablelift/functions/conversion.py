"""Type conversions of an export, and the Avro schema of its result."""

from __future__ import annotations

import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Names of the array modes; bytes, typed by the rows, typed by PostgreSQL's type name.
ARRAY_MODES = ("bytes", "typed_first_row", "typed_postgres")
#: JDBC types without an Avro type.
REFUSED = {"STRUCT": "STRUCT", "REF": "REF and REF_CURSOR", "REF_CURSOR": "REF and REF_CURSOR", "DATALINK": "DATALINK", "MAP": "MAP"}
#: Avro names of Spark's types; all others are strings.
NAMES = {T.LongType: "long", T.IntegerType: "int", T.ShortType: "int", T.ByteType: "int", T.BooleanType: "boolean", T.BinaryType: "bytes", T.DoubleType: "double", T.FloatType: "float"}
#: Element types of PostgreSQL's arrays.
POSTGRES_ITEMS = {"uuid": "string", "int": "int", "int4": "int", "int8": "long", "varchar": "string", "text": "string"}
TIMES = (T.TimestampType, T.TimestampNTZType, T.DateType, *([T.TimeType] if hasattr(T, "TimeType") else []))


class UnsupportedType(Exception):
    """A column that has no Avro type; not a ValueError, so that it has the exit code for other errors."""


class SchemaError(Exception):
    """A supplied schema that is no schema of the result."""


def check_array_mode(mode: str | None) -> str:
    if mode not in ARRAY_MODES:
        raise UnsupportedType(f"no array mode: {mode}; there are {', '.join(ARRAY_MODES)}")
    return mode


def normalized(name: str) -> str:
    return re.sub(r"[^A-Za-z0-9_]", "_", name, flags=re.ASCII)


def client_type(field: T.StructField) -> str:
    """The database's own name of a column's type; empty for views."""
    return str((field.metadata or {}).get("jdbcClientType", ""))


def _scalar(kind: T.DataType, logical: bool, client: str = "") -> object:
    if isinstance(kind, T.StructType):
        refuse("STRUCT")
    if isinstance(kind, T.MapType):
        refuse("MAP")
    if isinstance(kind, TIMES):
        return {"type": "long", "logicalType": "timestamp-millis"} if logical else "long"
    if client.lower() == "uuid":
        return {"type": "string", "logicalType": "uuid"} if logical else "string"
    if client.lower() in ("bit", "varbit") and not isinstance(kind, T.BooleanType):
        return "bytes"  # of more than one bit
    return NAMES.get(type(kind), "string")


def refuse(name: str) -> None:
    raise UnsupportedType(f"columns of type {REFUSED[name]} cannot be exported")


def postgres_item(name: str, client: str, logical: bool) -> object:
    if not client.startswith("_"):
        raise UnsupportedType(f"column {name} has the type name {client!r}, which does not begin with '_'")
    if client[1:] not in POSTGRES_ITEMS:
        raise UnsupportedType(f"column {name}: arrays of PostgreSQL's type {client[1:]!r} cannot be exported")
    return _scalar(T.StringType(), logical, client[1:]) if client == "_uuid" else POSTGRES_ITEMS[client[1:]]


def avro_type(kind: T.DataType, logical: bool = False, nullable_items: bool = False, mode: str = "typed_first_row", name: str = "", client: str = "") -> object:
    if isinstance(kind, T.ArrayType):
        if mode == "bytes":
            return "bytes"
        if mode == "typed_postgres":
            item = postgres_item(name, client, logical)
        elif isinstance(kind.elementType, T.ArrayType):
            raise UnsupportedType(f"column {name}: arrays of arrays cannot be exported")
        else:
            item = _scalar(kind.elementType, logical, client.removeprefix("_"))
        return {"type": "array", "items": [item, "null"] if nullable_items else item}
    return _scalar(kind, logical, client)


def _array_text(column: Column, items: T.DataType) -> Column:
    """An array as a database writes it: {a,b}, null items as NULL, strings with odd characters quoted."""
    if isinstance(items, T.ArrayType):
        text = lambda x: _array_text(x, items.elementType)
    elif isinstance(items, T.StringType):
        odd = lambda x: (x == "") | (F.lower(x) == "null") | x.rlike(r'[\s{},"\\]')
        text = lambda x: F.when(odd(x), F.concat(F.lit('"'), F.regexp_replace(x, r'(["\\])', r"\\$1"), F.lit('"'))).otherwise(x)
    else:
        text = lambda x: x.cast("string")
    return F.concat(F.lit("{"), F.array_join(F.transform(column, lambda x: F.coalesce(text(x), F.lit("NULL"))), ","), F.lit("}"))


def convert(column: Column, kind: T.DataType, name: str = "", nullable_items: bool = False, mode: str = "typed_first_row", client: str = "") -> Column:
    if isinstance(kind, T.ArrayType):
        if mode == "bytes":
            return F.when(column.isNotNull(), _array_text(column, kind.elementType).cast("binary"))
        items = F.transform(column, lambda x: convert(x, kind.elementType, client=client.removeprefix("_")))
        if mode == "typed_postgres":
            wanted = postgres_item(name, client, False)
            items = F.transform(column, lambda x: x.cast(wanted))
        if nullable_items:
            return items
        # fixed value: the name of the option that allows null items
        message = F.lit(f"Array item is null in column '{name}', use --nullableArrayItems")
        return F.when(F.exists(column, lambda x: x.isNull()), F.raise_error(message)).otherwise(items)
    if isinstance(kind, TIMES[:3]):
        return F.unix_millis(column.cast("timestamp"))
    if isinstance(kind, TIMES):  # a time of day: on the first day of the epoch
        return (F.hour(column) * 3_600_000 + F.minute(column) * 60_000).cast("long") + F.floor(F.extract(F.lit("SECOND"), column) * 1000).cast("long")
    name_of = _scalar(kind, False, client)
    if name_of == "bytes" and not isinstance(kind, T.BinaryType):
        return column.cast("binary") if isinstance(kind, T.StringType) else F.unhex(F.hex(column))
    return column if name_of in ("long", "boolean", "bytes", "double", "float") else column.cast(name_of)


def export_columns(rows: DataFrame, nullable_items: bool = False, mode: str = "typed_first_row") -> DataFrame:
    """One projection of casts, inside code generation."""
    return rows.select(*[convert(F.col(f"`{f.name}`"), f.dataType, f.name, nullable_items, mode, client_type(f)).alias(normalized(f.name)) for f in rows.schema])


def avro_schema(rows: DataFrame, name: str, namespace: str = "tablelift_generated", doc: str = "", logical: bool = False, nullable_items: bool = False, mode: str = "typed_first_row", url: str = "") -> str:
    """Every field is a union of null and its type, null first."""
    fields = []
    for f in rows.schema:
        client = client_type(f)
        extra = {"columnTypeName": client} if client else {}
        fields.append({"name": normalized(f.name), "type": ["null", avro_type(f.dataType, logical, nullable_items, mode, f.name, client)], "doc": f"From {client or f.dataType.simpleString()}", "default": None, "columnName": f.name, "typeName": f.dataType.simpleString(), **extra})
    record = {"type": "record", "name": name or "no_table_name", "namespace": namespace, "doc": doc, "fields": fields, "tableName": name or "no_table_name"}
    return json.dumps(record | ({"connectionUrl": url} if url else {}), indent=2)


def _plain(kind: object) -> object:
    """A type without its logical type and other properties."""
    if isinstance(kind, dict):
        if kind.get("type") == "array":
            items = kind.get("items")
            return {"type": "array", "items": [_plain(i) for i in items] if isinstance(items, list) else _plain(items)}
        return kind.get("type")
    return kind


def supplied_schema(text: str, generated: str) -> str:
    """A supplied schema as it is, if files written by it can be read: the fields of the result, in their
    order, each a union of null and the type that the result has."""
    try:
        given = json.loads(text)
    except json.JSONDecodeError as e:
        raise SchemaError(f"the supplied schema is no JSON: {e}") from e
    if not isinstance(given, dict) or given.get("type") != "record" or not isinstance(given.get("fields"), list) or not given.get("name"):
        raise SchemaError("the supplied schema must be a record with a name and fields")
    own = json.loads(generated)["fields"]
    if [f.get("name") for f in given["fields"]] != [f["name"] for f in own]:
        raise SchemaError(f"the supplied schema must have the fields {', '.join(f['name'] for f in own)} in this order")
    for f, g in zip(own, given["fields"], strict=True):
        if not isinstance(g["type"], list) or [_plain(t) for t in g["type"]] != ["null", _plain(f["type"][1])]:
            raise SchemaError(f"field {f['name']} of the supplied schema must have the type {json.dumps(['null', _plain(f['type'][1])])}")
    return text
