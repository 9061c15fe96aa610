"""How many values of a column occur more than once in a dated table, without grouping all its history each day.

Beside the totals of the last check the store keeps, for each folder of the table, a print of its files and a
digest of its values (their number and a sum of hashes, so order and files don't matter), and for each value and
folder its number of rows, twice: by folder, to know what a changed folder held, and in buckets by value, to know
where else a value is. A check reads the folders whose files changed, and of the store those folders and the
buckets of their values. Folders that were rewritten with the same values cost no more than that reading.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from merchmill.sources.buckets import bucket_count, read_buckets, write_buckets
from merchmill.sources.storage import child_names, data_summary, delete, materialise, read_text, write_text
from merchmill.sources.tables import Layout, table_folder

VALUES_PER_BUCKET = 1 << 18
#: checks after which the store is built anew, so that its small files don't pile up
REBUILD_AFTER = 64
#: a check whose changed folders hold one in so many of the other rows, or more, looks none of their values up
MANY = 4


@dataclass(frozen=True)
class Repeated:
    """Values that occur more than once: in the table, and in the rows of it that a view keeps."""

    values: int
    kept: int


def repeated_values(
    spark: SparkSession, path: str, layout: Layout, column: str, store: str, kept: Column | None = None
) -> Repeated:
    """Repeated values of ``column``, NULL left out, counted with the help of the ``store`` folder.

    ``kept`` is a view's condition; the values repeated in its rows are counted as well. The result equals that
    of a full pass however the table was changed in between.
    """
    live = table_folder(spark, path)
    now = {n: data_summary(spark, f"{live}/{n}") for n in child_names(spark, live) if n.startswith(f"{layout.folder}=")}
    state = _state(spark, store, live)
    old = state["folders"]
    changed = [n for n in now if old.get(n, {}).get("print") != now[n]]
    gone = [n for n in old if n not in now]
    if not changed and not gone:
        return Repeated(*state["totals"])
    # a number of its own for each attempt: what one that fails leaves behind is never taken for an entry
    write = uuid.uuid4().hex
    counts = _counts(spark, live, changed, column, kept, store, write)
    digests = {r["place"]: [r["rows"], str(r["digest"])] for r in counts.groupBy("place").agg(
        F.sum("n").alias("rows"), F.sum(F.xxhash64("value", "n", "m").cast("decimal(38,0)")).alias("digest")).collect()}
    other = [n for n in changed if n not in old or old[n]["digest"] != digests.get(n)]
    folders = {n: ({**old[n], "print": now[n]} if n in old and n not in other else
                   {"print": now[n], "digest": digests.get(n), "write": write}) for n in now if n in changed}
    folders = {**{n: old[n] for n in now if n not in changed}, **folders}
    totals = state["totals"]
    if other or gone:
        fresh = counts if len(other) == len(changed) else counts.where(F.col("place").isin(*other) if other else F.lit(False))
        if not state["buckets"]:
            state["buckets"] = bucket_count(sum(d[0] for d in digests.values()), VALUES_PER_BUCKET)
        names = [n for n in [*other, *gone] if n in old]
        changed_rows = _rows_in(digests, other) + _rows_in({n: f["digest"] for n, f in old.items()}, names)
        held_rows = _rows_in({n: f["digest"] for n, f in old.items()}, [n for n in old if n not in names])
        totals = _new_totals(spark, store, state, fresh, names, totals, many=MANY * changed_rows >= held_rows)
        write_buckets(fresh.withColumn("write", F.lit(write)), f"{store}/{state['name']}/values", ["value"], state["buckets"])
    write_text(spark, f"{store}/_state", json.dumps(
        {**state, "live": live, "folders": folders, "totals": totals, "checks": state["checks"] + 1}))
    return Repeated(*totals)


def _state(spark: SparkSession, store: str, live: str) -> dict:
    """What the last check left, or a new store where there was none, for another version of the table, or to tidy up."""
    text = read_text(spark, f"{store}/_state")
    try:
        state = json.loads(text) if text else None
    except ValueError:
        state = None  # cut off while it was written
    if state and state["live"] == live and state["checks"] < REBUILD_AFTER:
        return state
    name = uuid.uuid4().hex
    for n in child_names(spark, store):
        if n != "_state":
            delete(spark, f"{store}/{n}")
    return {"live": live, "name": name, "folders": {}, "totals": [0, 0], "checks": 0, "buckets": 0}


def _rows_in(digests: dict, names: list[str]) -> int:
    return sum((digests.get(n) or [0])[0] for n in names)


def _counts(
    spark: SparkSession, live: str, names: list[str], column: str, kept: Column | None, store: str, write: str
) -> DataFrame:
    """value, place (folder name), n, m of the listed folders, stored by folder under the number of this check."""
    if not names:
        return spark.createDataFrame([], _COUNTS)
    rows = spark.read.option("basePath", live).parquet(*[f"{live}/{n}" for n in names])
    place = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    rows = rows.select(F.col(column).cast("string").alias("value"), place.alias("place"),
                       (F.lit(True) if kept is None else F.coalesce(kept, F.lit(False))).alias("kept"))
    counted = rows.where("value IS NOT NULL").groupBy("value", "place").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("kept").alias("m"))
    path = f"{store}/folders-{write}"
    counted.withColumn("part", F.col("place")).hint("rebalance", F.col("part")).write.partitionBy("part").parquet(path)
    return spark.read.schema(_COUNTS).parquet(path)


_COUNTS = T.StructType([T.StructField("value", T.StringType()), T.StructField("place", T.StringType()),
                        T.StructField("n", T.LongType()), T.StructField("m", T.LongType())])


def _old_counts(spark: SparkSession, store: str, state: dict, names: list[str]) -> DataFrame:
    """What changed folders held at the last check that read them."""
    found = spark.createDataFrame([], _COUNTS)
    for write in sorted({state["folders"][n]["write"] for n in names}):
        mine = [n for n in names if state["folders"][n]["write"] == write]
        whole = spark.read.schema(T.StructType([*_COUNTS, T.StructField("part", T.StringType())])).parquet(f"{store}/folders-{write}")
        found = found.unionByName(whole.where(F.col("part").isin(*mine)).drop("part"))
    return found


def _new_totals(
    spark: SparkSession, store: str, state: dict, fresh: DataFrame, names: list[str], totals: list[int], many: bool
) -> list[int]:
    """The totals after the counts of folders ``names`` are replaced by ``fresh``; only their values are looked at.

    Where they are ``many``, the store is read as it is: a value that is only held elsewhere counts alike before
    and after, and picking the others out would shuffle all of them twice more.
    """
    if not state["folders"]:
        # nothing is held elsewhere: the totals are those of the new counts
        by_value = fresh.groupBy("value").agg(F.sum("n").alias("n"), F.sum("m").alias("m"))
        found = by_value.agg(*[F.count_if(F.col(c) > 1).alias(c) for c in ("n", "m")]).first()
        return [found["n"], found["m"]]
    before = _old_counts(spark, store, state, names)
    values = f"{store}/{state['name']}/values"
    schema = T.StructType([*_COUNTS, T.StructField("write", T.StringType())])
    elsewhere = spark.createDataFrame([], schema)
    if child_names(spark, values):
        touched = None if many else materialise(before.select("value").union(fresh.select("value")).distinct(), "touched-values")
        elsewhere = read_buckets(spark, values, schema, ["value"], state["buckets"], touched)
    # entries count while their folder was last read by the check that wrote them
    valid = spark.createDataFrame(
        [(n, f["write"]) for n, f in state["folders"].items() if n not in names], "place string, write string")
    rest = elsewhere.join(valid, ["place", "write"]).select("value", "n", "m")
    sides = [
        part.select("value", *[(F.col(c) if side in sides_of else F.lit(0).cast("long")).alias(f"{c}_{side}")
                               for side in ("before", "after") for c in ("n", "m")])
        for part, sides_of in ((rest, ("before", "after")), (before, ("before",)), (fresh, ("after",)))
    ]
    by_value = sides[0].unionByName(sides[1]).unionByName(sides[2]).groupBy("value").agg(
        *[F.sum(f"{c}_{side}").alias(f"{c}_{side}") for side in ("before", "after") for c in ("n", "m")])
    change = by_value.agg(*[
        (F.count_if(F.col(f"{c}_after") > 1) - F.count_if(F.col(f"{c}_before") > 1)).alias(c) for c in ("n", "m")]).first()
    return [totals[0] + change["n"], totals[1] + change["m"]]
