"""Stand-in inputs derived from the driver tables (see FIXTURES.md).

* ``fraud``  — binary classification rows from ``lineitem``
* ``trips``  — taxi-like regression rows from ``events``
* ``fraud_lines`` / ``trip_lines`` / ``trip_test_lines`` — the same rows as
  delimited text with a fixed share of damaged lines, for the parsers
* ``scored_fraud`` / ``scored_trips`` — rows scored by fixed parameters, for
  the evaluation operators

Every fixture is a projection of one table scan, so Catalyst prunes the
parquet columns and the work grows with the table.  Decimal constants are
written as doubles so Spark and DuckDB compute bit-identical values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.columns import add_apart, linear, sigmoid
from quarry.sources.tables import read_table, spread

_TEXT_FILES: dict[tuple, str] = {}


def as_text_file(spark: SparkSession, lines: DataFrame, key: tuple) -> DataFrame:
    """Write generated lines once per session and version of the tables they
    come from under the shared checkpoint folder, and scan them back with
    ``spark.read.text`` (the A1 source)."""
    import os
    import uuid

    from quarry.session import checkpoint_dir

    key = (*key, spark.sparkContext.applicationId, *[(f, file_version(spark, f)) for f in sorted(lines.inputFiles())])
    path = _TEXT_FILES.get(key)
    if path is None:
        path = os.path.join(checkpoint_dir(spark), "fixtures", f"{key[0]}-{uuid.uuid4().hex}")
        # several files, like a real input, so scans are not one task
        parts = max(8, spark.sparkContext.defaultParallelism)
        lines.repartition(parts).write.mode("overwrite").text(path)
        _TEXT_FILES[key] = path
    return spark.read.text(path)


def file_version(spark: SparkSession, path: str) -> tuple[int, int]:
    """Time of change and length of a file in any of Spark's file systems."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    status = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(at)
    return status.getModificationTime(), status.getLen()


FRAUD_FEATURES = ["f1", "f2", "f3"]
FRAUD_FEATURES_WIDE = ["f1", "f2", "f3", "f4"]
FRAUD_HEADER = "time,f1,f2,f3,label"

TRIP_FEATURES = [
    "vendor_id",
    "passenger_count",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
]
TRIP_HEADER = (
    "id,vendor_id,pickup_datetime,dropoff_datetime,passenger_count,pickup_longitude,"
    "pickup_latitude,dropoff_longitude,dropoff_latitude,store_and_fwd_flag,trip_duration"
)
TRIP_TEST_HEADER = (
    "id,vendor_id,pickup_datetime,passenger_count,pickup_longitude,"
    "pickup_latitude,dropoff_longitude,dropoff_latitude,store_and_fwd_flag"
)

# Fixed scoring parameters of the scored fixtures.
SCORED_FRAUD_WEIGHTS = (-6.0, 0.08, 30.0)


def fraud_label(q: Column, d: Column, cut: float = 4.0) -> Column:
    return F.when(q * d > cut, F.lit(1.0)).otherwise(F.lit(0.0))


def fraud(spark: SparkSession, sf_dir: str, wide: bool = False, cut: float = 4.0) -> DataFrame:
    """``f1, f2, f3 (NULL where tax is 0), label``; ``wide`` adds ``f4``."""
    li = read_table(spark, sf_dir, "lineitem")
    cols = [
        F.col("l_quantity").alias("f1"),
        F.col("l_discount").alias("f2"),
        F.when(F.col("l_tax") == 0.0, F.lit(None).cast("double"))
        .otherwise(F.col("l_tax"))
        .alias("f3"),
    ]
    if wide:
        cols.append(F.col("l_extendedprice").alias("f4"))
    cols.append(fraud_label(F.col("l_quantity"), F.col("l_discount"), cut).alias("label"))
    return li.select(*cols)


# The card fixture: 28 components and an amount, as in the classification input.
CARD_COMPONENTS = 28
CARD_FEATURES = [*[f"v{i}" for i in range(1, CARD_COMPONENTS + 1)], "amount"]


def card(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``key, v1..v28, amount, label`` from ``lineitem``: component i is a
    residue of the row's keys modulo 97 + 4i, centred, shifted for label 1 by
    one of five amounts; every row is its own."""
    li = spread(read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_discount", "l_extendedprice"))
    parts = {}
    for i in range(1, CARD_COMPONENTS + 1):
        m = 97 + 4 * i
        residue = (F.col("l_orderkey") * (2 * i + 1) + F.col("l_partkey") * (i + 3) + F.col("l_linenumber") * 7) % m
        parts[f"v{i}"] = residue / F.lit(float(m)) - F.lit(0.5) + F.col("label") * F.lit((i % 5 - 2) / 10.0)
    key = F.concat_ws("|", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    keyed = li.select(
        "l_orderkey", "l_partkey", "l_linenumber", key.alias("key"), F.col("l_extendedprice").alias("amount"),
        fraud_label(F.col("l_quantity"), F.col("l_discount")).alias("label"),
    )
    return add_apart(keyed, parts, 4).select("key", *CARD_FEATURES, "label")


def _trip_columns() -> dict[str, Column]:
    eid, uid = F.col("event_id"), F.col("user_id")
    lon = F.lit(-74.4) + ((eid * 37) % 800) / F.lit(1000.0)
    return {
        "id": eid.cast("string"),
        "vendor_id": F.lit(1) + uid % 3,
        "passenger_count": eid % 11,
        "pickup_datetime": F.col("ts"),
        "pickup_longitude": lon,
        "pickup_latitude": F.lit(40.4) + ((eid * 53) % 700) / F.lit(1000.0),
        "dropoff_longitude": F.lit(-74.4) + ((eid * 71 + uid) % 800) / F.lit(1000.0),
        "dropoff_latitude": F.lit(40.4) + ((eid * 97 + uid) % 700) / F.lit(1000.0),
        "store_and_fwd_flag": F.when(eid % 997 == 0, F.lit(None).cast("string"))
        .when(eid % 20 == 0, F.lit("Y"))
        .otherwise(F.lit("N")),
        "trip_duration": F.when(eid % 500 == 0, F.lit(40000.0)).otherwise(
            F.col("value") * 20.0
            + F.lit(8000.0) * F.abs(lon + F.lit(74.0))
            + F.when(F.hour("ts").between(7, 9), F.lit(1500.0)).otherwise(F.lit(0.0))
        ),
    }


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Taxi-like trips with ``trip_duration`` as the label."""
    cols = _trip_columns()
    return read_table(spark, sf_dir, "events").select(
        *[c.alias(name) for name, c in cols.items()]
    )


def _damage_key(c1: Column, c2: Column) -> Column:
    """0..99 from two key columns; rows with key < 10 get damaged."""
    return (c1 * 31 + c2) % 100


def fraud_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``value`` lines ``time,f1,f2,f3,label`` with one row in ten damaged.

    Damage by key ``m``: 0 empty f2, 1 ``NaN`` f1, 2 ``abc`` f3, 3 label 2,
    4 label missing, 5 quoted f1 (valid), 6 header line, 7 blanks around f2
    (valid), 8 bad ``time`` (valid only without time), 9 quoted label (valid).
    Built in stages (fields, damaged fields, line) to keep expressions small.
    """
    li = read_table(spark, sf_dir, "lineitem")
    base = li.select(
        _damage_key(F.col("l_orderkey"), F.col("l_linenumber")).alias("m"),
        F.col("l_orderkey").cast("string").alias("t"),
        F.col("l_quantity").cast("bigint").cast("string").alias("f1"),
        F.round(F.col("l_discount") * 100.0).cast("bigint").cast("string").alias("f2"),
        F.round(F.col("l_tax") * 100.0).cast("bigint").cast("string").alias("f3"),
        F.when(F.col("l_quantity") * F.col("l_discount") > 4.0, F.lit("1"))
        .otherwise(F.lit("0"))
        .alias("lab"),
    )
    m = F.col("m")
    damaged = base.select(
        "m",
        F.when(m == 8, F.lit("x")).otherwise(F.col("t")).alias("t"),
        F.when(m == 1, F.lit("NaN"))
        .when(m == 5, F.concat(F.lit('"'), F.col("f1"), F.lit('"')))
        .otherwise(F.col("f1"))
        .alias("f1"),
        F.when(m == 0, F.lit(""))
        .when(m == 7, F.concat(F.lit(" "), F.col("f2"), F.lit(" ")))
        .otherwise(F.col("f2"))
        .alias("f2"),
        F.when(m == 2, F.lit("abc")).otherwise(F.col("f3")).alias("f3"),
        F.when(m == 3, F.lit("2"))
        .when(m == 9, F.concat(F.lit('"'), F.col("lab"), F.lit('"')))
        .otherwise(F.col("lab"))
        .alias("lab"),
    )
    line = (
        F.when(m == 6, F.lit(FRAUD_HEADER))
        .when(m == 4, F.concat_ws(",", "t", "f1", "f2", "f3"))
        .otherwise(F.concat_ws(",", "t", "f1", "f2", "f3", "lab"))
    )
    return as_text_file(spark, damaged.select(line.alias("value")), ("fraud_lines", sf_dir))


def _fmt3(c: Column) -> Column:
    """Coordinates as fixed 3-decimal text, equal in Spark and DuckDB."""
    return F.format_string("%.3f", c)


def trip_lines(spark: SparkSession, sf_dir: str, test: bool = False) -> DataFrame:
    """Trips as CSV text in the reference's positional layout.

    Train: ``id,vendor,pickup,dropoff,passengers,4 coords,flag,duration``;
    test drops ``dropoff_datetime`` and ``trip_duration``.  Damage by key:
    0 empty passengers, 1 ``abc`` longitude, 2 one field short, 3 header.
    """
    cols = _trip_columns()
    ev = read_table(spark, sf_dir, "events")
    texts = ev.select(
        _damage_key(F.col("event_id"), F.col("user_id")).alias("m"),
        cols["id"].alias("id"),
        cols["vendor_id"].cast("string").alias("vendor"),
        F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss").alias("ts"),
        cols["passenger_count"].cast("string").alias("pc"),
        _fmt3(cols["pickup_longitude"]).alias("plon"),
        _fmt3(cols["pickup_latitude"]).alias("plat"),
        _fmt3(cols["dropoff_longitude"]).alias("dlon"),
        _fmt3(cols["dropoff_latitude"]).alias("dlat"),
        F.coalesce(cols["store_and_fwd_flag"], F.lit("")).alias("flag"),
        F.format_string("%.1f", cols["trip_duration"]).alias("dur"),
    )
    m = F.col("m")
    texts = texts.withColumns(
        {
            "pc": F.when(m == 0, F.lit("")).otherwise(F.col("pc")),
            "plon": F.when(m == 1, F.lit("abc")).otherwise(F.col("plon")),
        }
    )
    head = ["id", "vendor", "ts"] + ([] if test else ["ts"])
    body = ["pc", "plon", "plat", "dlon", "dlat", "flag"] + ([] if test else ["dur"])
    header = TRIP_TEST_HEADER if test else TRIP_HEADER
    line = (
        F.when(m == 3, F.lit(header))
        .when(m == 2, F.concat_ws(",", *head, *body[:-1]))
        .otherwise(F.concat_ws(",", *head, *body))
    )
    return as_text_file(spark, texts.select(line.alias("value")), ("trip_lines", sf_dir, test))


def scored_fraud(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``fraud`` without NULL rows, scored by fixed weights; ``p`` in (0, 1)."""
    df = fraud(spark, sf_dir).dropna()
    return df.select(
        *FRAUD_FEATURES,
        "label",
        sigmoid(linear(SCORED_FRAUD_WEIGHTS, ["f1", "f2"])).alias("p"),
    )


# Fixed rule of the ``scored_trips`` fixture: a two-level tree on
# pickup longitude and rush hour.
def scored_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outlier-filtered trips with a fixed two-level prediction."""
    from quarry.operators.clean import outlier_filter

    t = outlier_filter(trips(spark, sf_dir))
    rush = F.hour("pickup_datetime").between(7, 9)
    west = F.col("pickup_longitude") <= -74.0
    pred = (
        F.when(west, F.when(rush, F.lit(4500.0)).otherwise(F.lit(3000.0)))
        .otherwise(F.when(rush, F.lit(2500.0)).otherwise(F.lit(1000.0)))
    )
    return t.select("id", "trip_duration", pred.alias("prediction"))


def fraud_row_key(wide: bool = False) -> Column:
    """Canonical text of a fraud row (all columns), for hashing and ties."""
    feats = FRAUD_FEATURES_WIDE if wide else FRAUD_FEATURES
    return F.concat_ws(
        "|",
        *[F.col(c).cast("decimal(20,6)").cast("string") for c in feats],
        F.col("label").cast("decimal(20,6)").cast("string"),
    )
