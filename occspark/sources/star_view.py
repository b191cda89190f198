"""An occurrence table derived from the star-schema tables.

Each order line becomes one occurrence record. Only the joins that the wanted columns
need are made: every foreign key of the tables has exactly one partner, so leaving a
join out changes no row. No join is forced to broadcast; the optimiser decides by size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from occspark.functions.coerce import millis_to_iso

# Market segments read as states.
SEGMENT_STATES = {
    "AUTOMOBILE": "New South Wales",
    "BUILDING": "Victoria",
    "FURNITURE": "Queensland",
    "HOUSEHOLD": "Tasmania",
    "MACHINERY": "Overseas",
}

LINE_KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


_SCHEMAS: dict[str, T.StructType] = {}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A table of the star schema; its schema is looked up once per process."""
    path = f"{folder}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


_SPLITS: dict[str, int] = {}


def spread_scan(df: DataFrame, name: str) -> DataFrame:
    """Spread a scan that has fewer splits than the session has task slots.

    A single small file is one split, and everything up to the first shuffle would run
    in one task. A large table has far more splits than slots and is left alone.
    """
    if name not in _SPLITS:
        _SPLITS[name] = df.rdd.getNumPartitions()
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if _SPLITS[name] < slots else df


def _definitions() -> dict[str, tuple[Column, set[str]]]:
    """Column name to (expression, tables it needs beside the order lines)."""
    c = F.col
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    part, nation, region, customer = {"part"}, {"supplier", "nation"}, {"supplier", "nation", "region"}, {
        "orders",
        "customer",
    }
    two_words = F.concat_ws(" ", c("n_name"), c("p_type"))
    state = F.create_map(*[F.lit(x) for item in SEGMENT_STATES.items() for x in item])[c("c_mktsegment")]
    no_place = c("l_orderkey") % 17 == 0
    day = F.date_format(c("l_shipdate").cast("date"), "dd")
    month = F.date_format(c("l_shipdate").cast("date"), "MM")
    return {
        "query_species_key": (F.lower(F.replace(c("p_brand"), F.lit("#"), F.lit("_"))), part),
        "query_scientific_name": (c("p_brand"), part),
        "uuid": (
            F.when(c("l_linenumber") % 4 == 0, F.lit(None))
            .when(c("l_linenumber") == 7, F.lit(""))
            .otherwise(F.concat(F.lit("u"), c("l_orderkey").cast("string"))),
            set(),
        ),
        "scientificName": (F.concat_ws(" ", two_words, c("p_brand")), nation | part),
        "raw_scientificName": (
            F.when(c("l_linenumber") != 3, F.concat_ws(" ", two_words, c("p_name"))),
            nation | part,
        ),
        "vernacularName": (c("p_name"), part),
        "taxonRank": (
            F.when(c("l_linenumber") == 1, "genus").when(c("l_linenumber") == 2, "subspecies").otherwise("species"),
            set(),
        ),
        "taxonConceptID": (
            F.when(c("l_suppkey") % 7 != 0, F.concat(F.lit("tc"), (c("l_partkey") % 50).cast("string"))),
            set(),
        ),
        "classs": (c("r_name"), region),
        "order": (F.concat(F.lit("Order "), c("p_type")), part),
        "family": (c("r_name"), region),
        "genus": (F.when(c("l_partkey") % 13 != 0, c("n_name")), nation),
        "species": (F.when(c("l_partkey") % 11 != 0, two_words), nation | part),
        "stateProvince": (state, customer),
        "decimalLatitude": (
            F.when(~no_place, (c("l_partkey") * 37 % 3400 - 4400) / F.lit(100.0)),
            set(),
        ),
        "decimalLongitude": (
            F.when(~no_place, (c("l_suppkey") * 53 % 4000 + 11300) / F.lit(100.0)),
            set(),
        ),
        "eventDate": (F.timestamp_diff("MILLISECOND", epoch, c("l_shipdate")), set()),
        "year": (F.year("l_shipdate").cast("long"), set()),
        "month": (F.when(c("l_linenumber") != 6, month), set()),
        "day": (day, set()),
        "basisOfRecord": (F.when(c("l_linenumber") != 5, c("l_returnflag")), set()),
        "raw_basisOfRecord": (c("l_linestatus"), set()),
        "dataResourceUid": (F.concat(F.lit("dr"), c("l_suppkey").cast("string")), set()),
        "recordNumber": (F.concat(F.lit("rn"), c("l_partkey").cast("string")), set()),
        **{k: (c(k), set()) for k in LINE_KEY},
    }


OCCURRENCE_VIEW_COLUMNS = tuple(
    "query_species_key query_scientific_name uuid scientificName raw_scientificName vernacularName "
    "taxonRank taxonConceptID classs order family genus species stateProvince decimalLatitude "
    "decimalLongitude eventDate eventDate_iso year month day basisOfRecord raw_basisOfRecord "
    "dataResourceUid recordNumber".split()
)


def occurrences(
    spark: SparkSession, folder: str, columns: Sequence[str] = OCCURRENCE_VIEW_COLUMNS
) -> DataFrame:
    """The occurrence view with the wanted columns only."""
    defined = _definitions()
    wanted = dict.fromkeys(columns)
    needs: set[str] = set()
    for name in wanted:
        needs |= defined["eventDate" if name == "eventDate_iso" else name][1]
    rows = spread_scan(read_table(spark, folder, "lineitem"), f"{folder}/lineitem")

    def joined(left: DataFrame, table: str, key: str, other_key: str) -> DataFrame:
        return left.join(read_table(spark, folder, table), F.col(key) == F.col(other_key)) if table in needs else left

    # The segment meets its order first, and what adds only a key comes before what adds names: a line is
    # shuffled once by order and once by part while it has little beside its own columns.
    if "orders" in needs:
        orders = joined(read_table(spark, folder, "orders"), "customer", "o_custkey", "c_custkey")
        rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    rows = joined(rows, "supplier", "l_suppkey", "s_suppkey")
    rows = joined(rows, "part", "l_partkey", "p_partkey")
    rows = joined(rows, "nation", "s_nationkey", "n_nationkey")
    rows = joined(rows, "region", "n_regionkey", "r_regionkey")

    def column(name: str) -> Column:
        if name == "eventDate_iso":
            return millis_to_iso(defined["eventDate"][0], whole=True).alias(name)
        return defined[name][0].alias(name)

    return rows.select(*[column(n) for n in wanted])
