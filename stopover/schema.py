"""Read schemas of the search-response envelope, and work on schemas.

Reading with a schema needs no inference job and makes drift between days
harmless: a field that one day lacks is null, an empty result list keeps its
element type, and an unknown field is passed over.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names and types of the fields in a landed search response.
_CARRIER_LIST = "array<struct<id:bigint,alternateId:string,logoUrl:string,name:string>>"
_CARRIER = "struct<id:bigint,name:string,alternateId:string,allianceId:bigint,displayCode:string>"
_LEG_PLACE = (
    "struct<id:string,entityId:string,name:string,displayCode:string,"
    "city:string,country:string,isHighlighted:boolean>"
)
_SEGMENT_PLACE = (
    "struct<flightPlaceId:string,displayCode:string,"
    "parent:struct<flightPlaceId:string,displayCode:string,name:string,type:string>,"
    "name:string,type:string,country:string>"
)
_SEGMENT = (
    f"struct<id:string,origin:{_SEGMENT_PLACE},destination:{_SEGMENT_PLACE},"
    "departure:string,arrival:string,durationInMinutes:bigint,flightNumber:string,"
    f"marketingCarrier:{_CARRIER},operatingCarrier:{_CARRIER}>"
)
_LEG = (
    f"struct<id:string,origin:{_LEG_PLACE},destination:{_LEG_PLACE},"
    "durationInMinutes:bigint,stopCount:bigint,isSmallestStops:boolean,"
    "departure:string,arrival:string,timeDeltaInDays:bigint,"
    f"carriers:struct<marketing:{_CARRIER_LIST},operating:{_CARRIER_LIST},operationType:string>,"
    f"segments:array<{_SEGMENT}>>"
)
_ITINERARY = (
    "struct<id:string,price:struct<raw:double,formatted:string,pricingOptionId:string>,"
    f"legs:array<{_LEG}>,isSelfTransfer:boolean,isProtectedSelfTransfer:boolean,"
    "farePolicy:struct<isChangeAllowed:boolean,isPartiallyChangeable:boolean,"
    "isCancellationAllowed:boolean,isPartiallyRefundable:boolean>,"
    "tags:array<string>,isMashUp:boolean,hasFlexibleOptions:boolean,score:double>"
)
_FILTER_STATS = (
    "struct<duration:struct<min:bigint,max:bigint,multiCityMin:bigint,multiCityMax:bigint>,"
    "airports:array<struct<city:string,"
    "airports:array<struct<id:string,entityId:string,name:string>>>>,"
    f"carriers:{_CARRIER_LIST},"
    "stopPrices:struct<direct:struct<isPresent:boolean,formattedPrice:string>,"
    "one:struct<isPresent:boolean,formattedPrice:string>,"
    "twoOrMore:struct<isPresent:boolean,formattedPrice:string>>>"
)
_CONTEXT = "struct<status:string,sessionId:string,totalResults:bigint>"

#: Every field, for the merged store.
FULL_ENVELOPE = (
    f"status boolean, message string, data struct<context:{_CONTEXT},"
    f"itineraries:array<{_ITINERARY}>,filterStats:{_FILTER_STATS},"
    "flightsSessionId:string,destinationImageUrl:string,token:string>"
)

_NARROW_SEGMENT = (
    "struct<flightNumber:string,departure:string,arrival:string,"
    "marketingCarrier:struct<name:string>,operatingCarrier:struct<name:string>,"
    "origin:struct<displayCode:string>,destination:struct<displayCode:string>>"
)
_NARROW_LEG = (
    "struct<id:string,departure:string,arrival:string,durationInMinutes:bigint,"
    f"stopCount:bigint,segments:array<{_NARROW_SEGMENT}>>"
)

#: Only the fields the operators use. JSON scans prune top-level columns only,
#: so the narrow schema is what keeps the parser from building the rest.
ENVELOPE = (
    f"status boolean, message string, data struct<context:{_CONTEXT},"
    "itineraries:array<struct<id:string,price:struct<raw:double,formatted:string>,"
    f"legs:array<{_NARROW_LEG}>>>>"
)

# Columns of the flat segment table and of the itinerary summary.
SEGMENT_COLUMNS = [
    "fetch_date", "formattedPrice", "departure", "arrival", "duration",
    "flightNumber", "marketingCarrier", "operatingCarrier", "originCode", "destinationCode",
]
SUMMARY_COLUMNS = [
    "fetch_date", "flightNumber", "formattedPrice", "departure", "duration",
    "marketingCarrier", "operatingCarrier", "origin", "destination", "layover", "numStops",
]
SUMMARY_SCHEMA = (
    "fetch_date string, flightNumber string, formattedPrice string, departure string, "
    "duration bigint, marketingCarrier string, operatingCarrier string, origin string, "
    "destination string, layover string, numStops int"
)


def schema_paths(data_type: T.DataType, prefix: str = "") -> list[tuple[str, str, bool]]:
    """``(dotted path, type, nullable)`` of every field, nested ones included.

    Arrays add no path part of their own: a field of the elements is written
    ``items.field``, as it is in a select.
    """
    if isinstance(data_type, T.ArrayType):
        return schema_paths(data_type.elementType, prefix)
    if not isinstance(data_type, T.StructType):
        return []
    rows = []
    for field in data_type.fields:
        path = f"{prefix}{field.name}"
        rows.append((path, field.dataType.simpleString(), field.nullable))
        rows += schema_paths(field.dataType, f"{path}.")
    return rows


def has_path(df: DataFrame, path: str) -> bool:
    """Whether a dotted path, through structs and arrays, exists in ``df``."""
    return any(found == path for found, _, _ in schema_paths(df.schema))


def describe_paths(df: DataFrame) -> DataFrame:
    """One row per field: its path, its type, and how many values are present.

    Values are counted inside each record, those in arrays by array functions,
    and summed in one aggregation over one scan.
    """
    counts: list[tuple[str, str, Column]] = []
    # One column for the elements of each array, so that none is taken apart twice.
    rows = df.select(F.array(F.struct("*")).alias("_0"))
    levels = [(F.col("_0"), df.schema, "")]
    while levels:
        values, struct, prefix = levels.pop()
        for field in struct.fields:
            path, kind, found = f"{prefix}{field.name}", field.dataType, values[field.name]
            counts.append((path, kind.simpleString(), F.array_size(F.array_compact(found))))
            if isinstance(kind, T.StructType):
                levels.append((found, kind, f"{path}."))
            elif isinstance(kind, T.ArrayType):
                while isinstance(kind, T.ArrayType):
                    found, kind = F.flatten(F.array_compact(found)), kind.elementType
                if isinstance(kind, T.StructType):
                    name = f"_{len(rows.columns)}"
                    rows = rows.withColumn(name, found)
                    levels.append((F.col(name), kind, f"{path}."))
    totals = rows.agg(*[
        F.coalesce(F.sum(count), F.lit(0)).alias(str(i)) for i, (_, _, count) in enumerate(counts)])
    return totals.select(F.inline(F.array(*[
        F.struct(F.lit(path).alias("path"), F.lit(kind).alias("type"),
                 F.col(str(i)).alias("present"))
        for i, (path, kind, _) in enumerate(counts)])))


def _aligned(value: Column, have: T.DataType | None, want: T.DataType) -> Column:
    if have is None:
        return F.lit(None).cast(want)
    if isinstance(want, T.StructType) and isinstance(have, T.StructType):
        types = {field.name: field.dataType for field in have.fields}
        fields = [
            _aligned(value[field.name], types.get(field.name), field.dataType).alias(field.name)
            for field in want.fields
        ]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(want, T.ArrayType) and isinstance(have, T.ArrayType):
        return F.transform(value, lambda item: _aligned(item, have.elementType, want.elementType))
    return value if have == want else value.cast(want)


def align_to(df: DataFrame, want: T.StructType) -> DataFrame:
    """Give ``df`` exactly the fields of ``want``, at every depth.

    A field that ``df`` lacks becomes a null of the wanted type, also inside
    structs and arrays of structs.
    """
    types = {field.name: field.dataType for field in df.schema.fields}
    return df.select(*[
        _aligned(F.col(f"`{field.name}`"), types.get(field.name), field.dataType).alias(field.name)
        for field in want.fields
    ])
