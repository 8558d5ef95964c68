"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkrec.session import drop_materialized, ensure_checkpoint_dir, materialize, ship

__all__ = ["drop_materialized", "ensure_checkpoint_dir", "hash64", "map_rows", "materialize", "read", "sha_hex",
           "ship", "shuffle_parts", "texts"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A given table, whole."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string), every row, null texts as empty.

    Selecting exactly these two columns first means that no other column of the
    input, whatever its name, can clash with what an operator adds.
    """
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))


def map_rows(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], list | dict]], schema: str) -> DataFrame:
    """``mapInArrow`` where ``make()`` runs once per task and returns a function
    from one batch to a dict of columns (lists)."""
    arrow = _arrow_schema(schema)
    ship(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = make()
        for b in batches:
            cols = step(b)
            yield pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def _arrow_schema(schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(schema))


def sha_hex(s: str) -> str:
    return hashlib.sha256(s.encode("utf-8", "surrogatepass")).hexdigest()


def hash64(s: str) -> int:
    """Stable 64-bit hash of a string (signed, as Spark's long)."""
    return int.from_bytes(hashlib.blake2b(s.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little", signed=True)


def shuffle_parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
