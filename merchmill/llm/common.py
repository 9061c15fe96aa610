"""What the operators share: stored intermediate tables, normalisation, and byte-level token ids."""

from __future__ import annotations

import base64
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: What separates words everywhere here: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names; a temporary one only where it is unset on one machine, as in tests."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/") if folder else _own_folder(spark.sparkContext.applicationId)


@functools.lru_cache(maxsize=1)
def _own_folder(application: str) -> str:
    return "file://" + tempfile.mkdtemp(prefix="merchmill-llm-")


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"


#: tables that ``stored`` wrote in this process and that weren't freed
_made: list[str] = []


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table into the shared folder and read it back: a lost executor then costs no recomputation."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    _made.append(path)
    return spark.read.schema(df.schema).parquet(path)


def stored_alone(spark: SparkSession, make: Callable[[], DataFrame], name: str) -> tuple[DataFrame, str]:
    """(table, path): the stored result of ``make``; what it stored on the way is deleted, as nothing reads it any more."""
    before = len(_made)
    table = stored(make(), name)
    *others, path = _made[before:]
    free_stored(spark, others)
    return table, path


def free_stored(spark: SparkSession, paths: list[str] | None = None) -> None:
    """Delete stored tables: those listed, or all of this process, for when no result is read any more."""
    for path in list(_made if paths is None else paths):
        hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
        hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop_path, True)
        if path in _made:
            _made.remove(path)


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@functools.lru_cache(maxsize=4)
def token_encoder(json_path: str, ranks_path: str):
    """text -> its ids as little-endian unsigned 32-bit bytes, equal to ``Tokenizer.from_file(json_path)``.

    The rank file holds the same vocabulary and is encoded about five times faster. Texts that hold the
    string of a special token go through the JSON file's tokenizer, which reads it as that token.
    """
    import numpy as np
    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    to_buffer, nothing = fast._core_bpe.encode_to_tiktoken_buffer, set()
    whole = Tokenizer.from_file(json_path)
    special = [t.content for t in whole.get_added_tokens_decoder().values()]

    def encode(text: str) -> bytes:
        if any(s in text for s in special):
            return np.asarray(whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return bytes(to_buffer(text, nothing))

    return encode


def vocabulary_paths(json_path: str | None = None, ranks_path: str | None = None) -> tuple[str, str]:
    import public_tokenizers

    return (json_path or public_tokenizers.path("byte_bpe_50k.json"),
            ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"))


def rows_of(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches into slices of few rows, so that Python copies stay small beside long texts."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
