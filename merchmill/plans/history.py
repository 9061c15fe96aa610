"""What a day needs of the source files, stored once in the shapes in which a day reads it.

``days``    order lines by day
``draws``   the same lines in draw order, in folders by the draw value's first bits, each written by one task
``prices``  how many items of a product were sold at a price, in buckets by product
``people``  the first row of each person, in buckets by person

A store belongs to the source files it was built from, and is built anew when they change. Its description,
a small file, is written last, so a build that failed is not taken for a store.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, replace
from datetime import date, datetime
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from merchmill.config import ShopConfig
from merchmill.operators import draw_order, head_rows, median_of_counts, other_rows, restamp, value_counts
from merchmill.plans import ingest
from merchmill.sources.buckets import bucket_count, read_buckets, write_buckets
from merchmill.sources.storage import COMPRESSION, delete, file_bytes, fingerprint, read_text, side_by_side, write_text
from merchmill.sources.tables import Layout, read_table, rows_between, write_folder

#: lines of a draw folder and rows of a bucket on average
LINES_PER_DRAW_FOLDER, ROWS_PER_BUCKET = 1 << 17, 1 << 18
MOST_DRAW_BITS = 12
#: a guess at the size of an item in the source files, for the number of buckets
BYTES_PER_ITEM = 32

PERSON = ["customer_unique_id"]
PEOPLE = T.StructType([T.StructField(c, T.StringType()) for c in ("customer_unique_id", "customer_city")])
PRICES = T.StructType([
    T.StructField("product_id", T.StringType()), T.StructField("cents", T.LongType()), T.StructField("n", T.LongType())])


def history_layout(config: ShopConfig) -> Layout:
    return Layout("order_date", config.partition_by)


@dataclass(frozen=True)
class History:
    """Where a store lies and what its readers must know of it."""

    path: str
    lines: int
    draw_bits: int
    buckets: int


def stored_history(spark: SparkSession, config: ShopConfig, src: dict[str, DataFrame]) -> History:
    """The store of these sources, built when they are new or have changed.

    A line whose time can't be read has neither time nor day here; it gets the time of the run that reads it.
    """
    used = {name: src[name] for name in ("orders", "order_items", "customers")}
    base = config.path("history", f"seed={config.seed}-{config.partition_by}")
    path = f"{base}/{fingerprint(spark, used)}"
    known = read_text(spark, f"{path}/_history")
    if known:
        return History(**json.loads(known))
    delete(spark, base)  # built from older sources, or not to its end
    layout = history_layout(config)
    history = History(path, 0, 0, bucket_count(file_bytes(spark, src["order_items"]) // BYTES_PER_ITEM, ROWS_PER_BUCKET))

    def lines() -> tuple[int, int]:
        built = ingest.build_orders(src["orders"], src["order_items"], src["customers"], None)
        count = write_folder(built, f"{path}/days", layout)
        bits = min(MOST_DRAW_BITS, (count // LINES_PER_DRAW_FOLDER).bit_length())
        stored = read_table(spark, f"{path}/days", layout)
        write_draws(stored.withColumn("draw", draw_order(config.seed, ingest.LINE_KEY)), f"{path}/draws", bits)
        return count, bits

    def persons() -> None:
        first = ingest.dedupe_people(src["customers"], ingest.person_order(src["customers"]))
        write_buckets(first.select(*PEOPLE.names), f"{path}/people", PERSON, history.buckets)

    done = side_by_side(config.threads, {"lines": lines, "people": persons, "prices": partial(add_prices, src["order_items"], history)})
    count, bits = done["lines"]
    history = replace(history, lines=count, draw_bits=bits)
    write_text(spark, f"{path}/_history", json.dumps(asdict(history)))
    return history


def write_draws(lines: DataFrame, path: str, bits: int) -> None:
    """Each task writes one draw folder, so files don't overlap. Draws are spread evenly, so no sample tells their ranges."""
    first = F.conv(F.substring("draw", 1, 4), 16, 10).cast("int")
    placed = lines.withColumn("draw_folder", F.shiftright(first, 16 - bits)).repartitionById(1 << bits, F.col("draw_folder"))
    writer = placed.sortWithinPartitions("draw_folder", "draw").write.mode("overwrite").option("compression", COMPRESSION)
    writer.partitionBy("draw_folder").parquet(path)


def day_lines(spark: SparkSession, config: ShopConfig, history: History, run_date: date, now: datetime) -> DataFrame:
    """The lines of one day; only its folder is read, and on the day of ``now`` that of lines without a time."""
    layout, path = history_layout(config), f"{history.path}/days"
    own = rows_between(spark, path, layout, run_date, run_date)
    if now.date() == run_date:
        bare = layout.in_folders(read_table(spark, path, layout, keep_folder=True), [None])
        own = own.unionByName(bare.select(*own.columns))
    return ingest.timed_lines(own, now)


def lines_before(spark: SparkSession, history: History, share: float) -> DataFrame:
    """The lines in about the first ``share`` of the draw order: only the draw folders up to it are read."""
    lines = spark.read.parquet(f"{history.path}/draws")
    if share >= 1:
        return lines.drop("draw_folder")
    bound = int(share * (1 << 32))
    folder = bound >> (32 - history.draw_bits)
    return lines.where((F.col("draw_folder") <= folder) & (F.col("draw") < f"{bound:08x}")).drop("draw_folder")


def drawn_lines(spark: SparkSession, history: History, run_date: date, now: datetime, count: int) -> DataFrame:
    """``count`` lines of other days in draw order, moved to ``run_date``.

    Draws are spread evenly, so the share of the lines that is wanted says about how far to look; it is
    raised until enough lines are before it.
    """
    share = (2 * count + 64) / max(1, history.lines)
    while True:
        others = other_rows(ingest.timed_lines(lines_before(spark, history, share), now, keep=("draw",)), run_date)
        if share >= 1 or others.count() >= count:
            return restamp(head_rows(others, count, ["draw", *ingest.LINE_KEY]).drop("draw"), run_date)
        share *= 4


def add_prices(items: DataFrame, history: History) -> None:
    """Add a batch of order items to the stored counts. Counts of several batches are summed when they are read."""
    counts = value_counts(items, "product_id", "price", "cents", "n")
    write_buckets(counts, f"{history.path}/prices", ["product_id"], history.buckets)


def median_prices(spark: SparkSession, history: History, batch: DataFrame | None = None) -> DataFrame:
    """product_id, median_price of all products, or of those in ``batch``, whose buckets alone are read."""
    counts = read_buckets(spark, f"{history.path}/prices", PRICES, ["product_id"], history.buckets, batch)
    whole = counts.groupBy("product_id", "cents").agg(F.sum("n").alias("n"))
    return median_of_counts(whole, "product_id", "cents", "n", "median_price")


def people(spark: SparkSession, history: History, batch: DataFrame | None = None) -> DataFrame:
    """The first row of every person, or of those in ``batch`` (by ``customer_unique_id``)."""
    return read_buckets(spark, f"{history.path}/people", PEOPLE, PERSON, history.buckets, batch)
