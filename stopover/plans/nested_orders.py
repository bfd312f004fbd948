"""Nested snapshots made from the flat test tables, in the shape of the landed ones.

An order is an itinerary, its year the snapshot, its line items are segments.
Line items are numbered in order; four make a leg, eight legs a page, and a record
holds one page of a block of 64 order keys. So a record stays small however
many line items one order has, alike or not. Orders without any have no legs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stopover.operators.numbering import group_goes_on, running_number
from stopover.session import fresh_path, passing, staged_from
from stopover.sources.snapshots import accepted, read_snapshots

SEGMENTS_PER_LEG = 4
LEGS_PER_PAGE = 8
ORDERS_PER_BLOCK = 64
# Records of a multi-line file: whole blocks, and pages, by this many.
BLOCKS_PER_FILE = 64
PAGES_PER_FILE = 64
CODES = 25
#: All that tells the line items of an order apart, in the order that they are numbered in.
LINE_COLUMNS = ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity",
                "l_linestatus", "l_shipdate"]
# Fixed value: what stands before a price, rupee sign and no-break space.
PRICE_MARK = "\u20b9\u00a0"

#: Names of landed files: the made ones are packed, as text takes ten times the room.
LANDED_FILES = "*.{json,json.gz}"
# Records of a landed file, so that its text is small enough to be read whole.
RECORDS_PER_FILE = 8192
# Records of a file of the merged store. A row of it grows when it is exploded, so small
# files are what keeps the tasks of a scan small.
RECORDS_PER_STORED_FILE = 1024
# Days that a task writes side by side; with more it sorts its records.
OPEN_DAYS = 64

_staged: dict[tuple[str, str, str], str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def once(spark: SparkSession, sf_dir: str, label: str, write) -> str:
    """Path of a staged input, written by the first query of the session that needs it."""
    key = (spark.conf.get("spark.app.id", "local"), sf_dir, label)
    if key not in _staged:
        path = fresh_path(spark, label)
        write(path)
        _staged[key] = path
    return _staged[key]


def whole(number: Column, size: int) -> Column:
    """Number of whole ``size`` in a non-negative integer."""
    return ((number - number % size) / size).cast("bigint")


def code(number: Column) -> Column:
    return F.concat(F.lit("N"), (number % CODES).cast("string"))


def iso_text(when: Column) -> Column:
    """Zone-less time as ISO text, whatever the session's time zone."""
    return F.translate(when.cast("string"), " ", "T")


def price_text(price: Column) -> Column:
    return F.concat(F.lit(PRICE_MARK), F.floor(price).cast("string"))


def fetch_date(day: Column) -> Column:
    return F.concat(F.year(day).cast("string"), F.lit("-01-01"))


_RECORD = ["fetch_date", "block", "page"]
_ORDER = ["o_orderkey", "o_totalprice", "o_orderdate"]
_SEGMENT = ["flightNumber", "departure", "arrival", "marketingCarrier", "operatingCarrier",
            "origin", "destination"]
_PAGES = """fetch_date string, block bigint, page bigint, itineraries array<struct<id: string,
    price: struct<raw: double, formatted: string>, legs: array<struct<id: string,
    departure: string, arrival: string, durationInMinutes: bigint, stopCount: bigint,
    segments: array<struct<flightNumber: string, departure: string, arrival: string,
    marketingCarrier: struct<name: string>, operatingCarrier: struct<name: string>,
    origin: struct<displayCode: string>, destination: struct<displayCode: string>>>>>>>"""


def _struct(**fields: pa.Array) -> pa.StructArray:
    return pa.StructArray.from_arrays([*fields.values()], [*fields])


def _lists(starts: np.ndarray, size: int, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(starts, size), pa.int32()), values)


def _nest(table: pa.Table) -> pa.RecordBatch:
    """Records of sorted lines: neighbours of one leg, order and record become lists."""
    table = table.combine_chunks()
    columns = {name: table[name].combine_chunks() for name in table.column_names}
    size = len(table)

    def starts(keys: list[str]) -> np.ndarray:
        return np.flatnonzero(np.append(True, ~group_goes_on(keys)(table))[:size])

    def at(name: str, rows: np.ndarray) -> pa.Array:
        return columns[name].take(pa.array(rows))

    of_records, of_orders = starts(_RECORD), starts([*_RECORD, *_ORDER])
    of_legs = starts([*_RECORD, *_ORDER, "leg_no"])
    name, displayed = (lambda c: _struct(name=columns[c])), (lambda c: _struct(displayCode=columns[c]))
    segments = _struct(**{c: {"marketingCarrier": name, "operatingCarrier": name,
                              "origin": displayed, "destination": displayed}
                          .get(c, columns.get)(c) for c in _SEGMENT})
    sizes = np.diff(np.append(of_legs, size))
    legs = _struct(
        id=at("leg_id", of_legs), departure=at("leg_departure", of_legs),
        arrival=at("leg_arrival", of_legs), durationInMinutes=pa.array(sizes * 90),
        stopCount=pa.array(sizes - 1), segments=_lists(of_legs, size, segments))
    # An order without lines has one row here, and no leg.
    real = columns["leg_no"].is_valid().to_numpy(zero_copy_only=False)[of_legs]
    first_legs = np.append(0, np.cumsum(real))[np.searchsorted(of_legs, of_orders)]
    orders = _struct(
        id=at("o_orderkey", of_orders).cast(pa.string()),
        price=_struct(raw=at("o_totalprice", of_orders), formatted=at("formatted", of_orders)),
        legs=_lists(first_legs, int(real.sum()), legs.filter(pa.array(real))))
    pages = _lists(np.searchsorted(of_orders, of_records), len(of_orders), orders)
    return pa.RecordBatch.from_arrays(
        [*[at(c, of_records) for c in _RECORD], pages], [*_RECORD, "itineraries"])


def _nested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``_nest`` of whole records; the last one of a batch waits for the next batch."""
    held: list[pa.RecordBatch] = []
    goes_on = group_goes_on(_RECORD)
    for batch in batches:
        if not batch.num_rows:
            continue
        before = [held[-1].slice(held[-1].num_rows - 1)] if held else []
        new = np.flatnonzero(~goes_on(pa.Table.from_batches([*before, batch]))) + 1 - len(before)
        if len(new):
            last = int(new[-1])
            yield _nest(pa.Table.from_batches([*held, batch.slice(0, last)]))
            held = []
            batch = batch.slice(last)
        held.append(batch)
    if held:
        yield _nest(pa.Table.from_batches(held))


def _lines_of_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Numbered lines with their order, and orders without lines."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", *LINE_COLUMNS)
    heads = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderdate")
    # From here on a line is what its segment is made of, and its number.
    numbered = running_number(lines, ["l_orderkey"], LINE_COLUMNS, "line_no").select(
        "l_orderkey", "line_no", "l_linenumber", "l_partkey", "l_suppkey",
        F.col("l_quantity").cast("int").alias("l_quantity"), "l_linestatus", "l_shipdate")
    # Both joins read one shuffle of the orders that have a key.
    known = heads.where("o_orderkey is not null")
    filled = numbered.join(known, numbered.l_orderkey == known.o_orderkey).drop("l_orderkey")
    filled_keys = lines.select("l_orderkey").distinct()
    bare = known.join(
        filled_keys, known.o_orderkey == filled_keys.l_orderkey, "left_anti",
    ).unionByName(heads.where("o_orderkey is null"))
    return filled.unionByName(bare, allowMissingColumns=True)


def order_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fetch_date, block, page`` and the envelope's three columns."""
    leg_no = whole(F.col("line_no"), SEGMENTS_PER_LEG)
    place = {
        "fetch_date": fetch_date(F.col("o_orderdate")),
        "block": whole(F.col("o_orderkey"), ORDERS_PER_BLOCK),
        "page": F.coalesce(whole(leg_no, LEGS_PER_PAGE), F.lit(0)),
    }
    # One shuffle and one sort of narrow rows. The texts are made behind them, those of a leg
    # or an order with its first line, and lists are cut in one pass, so no wide row is sorted.
    # The joins' shuffles are gone before this one is written.
    lines = staged_from(spark, lambda: _lines_of_orders(spark, sf_dir), "lines", "zstd")
    placed = lines.repartition(*place.values())
    lined = placed.withColumns({**place, "leg_no": leg_no}).sortWithinPartitions(
        *_RECORD, *_ORDER, "line_no")
    starts = F.col("l_shipdate") + F.make_dt_interval(hours=F.col("l_linenumber"))
    ends = starts + F.make_dt_interval(mins=F.col("l_quantity"))
    leaves = F.col("o_orderdate") + F.make_dt_interval(days=F.col("leg_no").cast("int"))
    heads_leg = F.col("line_no") % SEGMENTS_PER_LEG == 0
    heads_page = F.coalesce(F.col("line_no") % (SEGMENTS_PER_LEG * LEGS_PER_PAGE), F.lit(0)) == 0
    supplier = F.lpad(F.col("l_suppkey").cast("string"), 9, "0")
    texts = lined.select(
        *_RECORD, *_ORDER, "leg_no",
        F.when(heads_page, price_text(F.col("o_totalprice"))).alias("formatted"),
        F.when(heads_leg, F.concat_ws(
            "-", F.col("o_orderkey").cast("string"), F.col("leg_no").cast("string")))
        .alias("leg_id"),
        F.when(heads_leg, iso_text(leaves)).alias("leg_departure"),
        F.when(heads_leg, iso_text(leaves + F.make_dt_interval(days=F.lit(1))))
        .alias("leg_arrival"),
        F.col("l_partkey").cast("string").alias("flightNumber"),
        iso_text(starts).alias("departure"),
        iso_text(ends).alias("arrival"),
        F.concat(F.lit("Supplier#"), supplier).alias("marketingCarrier"),
        F.concat(F.lit("Operator "), F.col("l_linestatus")).alias("operatingCarrier"),
        code(F.col("l_suppkey")).alias("origin"),
        code(F.col("l_partkey")).alias("destination"),
    )
    pages = texts.mapInArrow(_nested, _PAGES)
    context = F.struct(
        F.lit("complete").alias("status"),
        F.concat_ws("-", "block", "page").alias("sessionId"),
        F.size("itineraries").cast("bigint").alias("totalResults"))
    return pages.select(
        *_RECORD,
        F.lit(True).alias("status"),
        F.concat_ws("-", "block", "page").alias("message"),
        F.struct(context.alias("context"), "itineraries").alias("data"),
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The envelopes as a staged table, before they become JSON text."""
    def write(path: str) -> None:
        with passing(spark):
            order_envelopes(spark, sf_dir).write.parquet(path, compression="zstd")
    return spark.read.parquet(once(spark, sf_dir, "envelopes", write))


def write_days(records: DataFrame, kind: str, path: str) -> None:
    """Packed text files in a folder per day, as the tasks have the records: no shuffle, no sort."""
    conf, name = records.sparkSession.conf, "spark.sql.maxConcurrentOutputFileWriters"
    before = conf.get(name)
    conf.set(name, OPEN_DAYS)
    try:
        records.write.partitionBy("fetch_date").option("compression", "gzip").option(
            "maxRecordsPerFile", RECORDS_PER_FILE).format(kind).save(path)
    finally:
        conf.set(name, before)


def landing(spark: SparkSession, sf_dir: str) -> str:
    """Landing folder of JSON lines, one folder per snapshot, written with no table between."""
    def write(path: str) -> None:
        with passing(spark):
            write_days(order_envelopes(spark, sf_dir).drop("block", "page"), "json", path)
    return once(spark, sf_dir, "landing", write)


def landed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value, fetch_date``: the records as they landed, as text, and their day."""
    return spark.read.schema("value string, fetch_date string").text(landing(spark, sf_dir))


def envelope_line() -> Column:
    """Text of a record without itineraries."""
    return F.lit('{"status": true, "message": "none", "data": {"itineraries": []}}').alias("value")


def envelope_text(pretty: bool = False) -> Column:
    fields = F.struct("status", "message", "data")
    return F.to_json(fields, {"pretty": "true"} if pretty else {})


def multiline_landing(spark: SparkSession, sf_dir: str) -> str:
    """The same records, as files that hold one indented JSON array each."""
    def write(path: str) -> None:
        records = envelopes(spark, sf_dir)
        files = records.groupBy(
            "fetch_date",
            whole(F.col("block"), BLOCKS_PER_FILE).alias("blocks"),
            whole(F.col("page"), PAGES_PER_FILE).alias("pages"),
        ).agg(F.collect_list(envelope_text(pretty=True)).alias("texts"))
        text = F.concat(F.lit("[\n"), F.array_join("texts", ",\n"), F.lit("\n]"))
        (
            files.select("fetch_date", text.alias("value"))
            .write.partitionBy("fetch_date")
            .option("maxRecordsPerFile", 1)
            .option("compression", "gzip")
            .text(path)
        )
    return once(spark, sf_dir, "multiline", write)


def merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The landed records as a columnar store, which prunes nested columns."""
    path = once(spark, sf_dir, "merged", lambda p: accepted(
        read_snapshots(spark, landing(spark, sf_dir), files=LANDED_FILES)
    ).write.option("maxRecordsPerFile", RECORDS_PER_STORED_FILE).option(
        "parquet.compression.codec.zstd.level", 6).parquet(p, compression="zstd"))
    return spark.read.parquet(path)

