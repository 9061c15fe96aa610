"""A list of the batches that were loaded into a table, so that each is taken once and followers know what is new.

An entry is a small file, numbered in order: which batch, a digest of its rows, and the days they are of. It is
noted in two steps. ``begin`` says which files lie in the folders that the load is about to add to; ``finish``
makes the entry count. A load that failed between the two is undone by the next one: what lies in these folders
beside the noted files came from it.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F

from merchmill.sources.storage import child_names, delete, read_text, write_text


@dataclass(frozen=True)
class Entry:
    """A load that is done: its number, the batch's name, the digest of its rows, and their days (NULL as None).

    ``table`` says what the table's folder looked like after it, where the load noted that.
    """

    number: int
    batch: str
    digest: str
    days: tuple[date | None, ...]
    table: Sequence | None = None


def rows_of_digest(digest: str) -> int:
    return int(digest.split(":")[0])


def digest_of(rows: DataFrame) -> tuple[str, list[date | None]]:
    """What tells the rows of a batch from others, in any order and number of files, and the days they are of."""
    hashes = F.xxhash64(*rows.columns).cast("decimal(38,0)")
    # one row for each calendar day
    found = rows.groupBy("order_date").agg(F.count(F.lit(1)).alias("n"), F.sum(hashes).alias("h")).collect()
    return f"{sum(r['n'] for r in found)}:{sum(int(r['h']) for r in found)}", [r["order_date"] for r in found]


class Ledger:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def entries(self, after: int = 0) -> list[Entry]:
        """The loads that are done, in order; those with a number above ``after``."""
        numbers = sorted(int(n.split(".")[0]) for n in child_names(self.spark, self.path) if n.endswith(".done"))
        found = []
        for number in numbers:
            if number > after:
                said = json.loads(read_text(self.spark, self._file(number, "done")))
                found.append(Entry(number, said["batch"], said["digest"], tuple(d and date.fromisoformat(d) for d in said["days"]), said.get("table")))
        return found

    def _file(self, number: int, step: str) -> str:
        return f"{self.path}/{number}.{step}"

    def _open(self) -> list[int]:
        names = child_names(self.spark, self.path)
        begun = {int(n.split(".")[0]) for n in names if n.endswith(".begin")}
        return sorted(begun - {int(n.split(".")[0]) for n in names if n.endswith(".done")})

    def undo_open(self) -> None:
        """Remove the files that loads which never finished have added."""
        for number in self._open():
            said = json.loads(read_text(self.spark, self._file(number, "begin")))
            for folder, files in said["files"].items():
                for name in child_names(self.spark, folder):
                    if not name.startswith(("_", ".")) and name not in files:
                        delete(self.spark, f"{folder}/{name}")
            delete(self.spark, self._file(number, "begin"))

    def begin(self, folders: Sequence[str]) -> int:
        """Note the files of the folders that a load adds to; returns the load's number."""
        numbers = [int(n.split(".")[0]) for n in child_names(self.spark, self.path) if n[:1].isdigit()]
        number = max(numbers, default=0) + 1
        files = {f: [n for n in child_names(self.spark, f) if not n.startswith(("_", "."))] for f in folders}
        write_text(self.spark, self._file(number, "begin"), json.dumps({"files": files}), replace=False)
        return number

    def finish(self, number: int, batch: str, digest: str, days: Sequence[date | None], table: Sequence | None = None) -> None:
        said = {"batch": batch, "digest": digest, "days": [d and d.isoformat() for d in days], "table": table}
        write_text(self.spark, self._file(number, "done"), json.dumps(said), replace=False)
        delete(self.spark, self._file(number, "begin"))
