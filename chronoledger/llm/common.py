"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chronoledger.session import ensure_checkpoint_dir

WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(col: str = "text") -> Column:
    """The text, with NULL as the empty string."""
    return F.coalesce(F.col(col), F.lit(""))


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, folder: str | None = None) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it again.

    This cuts the lineage: what follows survives the loss of any executor
    without computing ``df`` again, and several readers share one pass.
    """
    folder = folder or shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def dropped(spark: SparkSession, folders: list[str]) -> None:
    """Delete tables of ``written`` that nothing will read again."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    for folder in folders:
        path = hadoop.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over one evaluation of ``value`` (inside lambdas nothing else
    keeps an outer expression from being evaluated for each element)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(col: Column) -> Column:
    """A-Z in lower case, all other characters as they are."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return (F.when(F.octet_length(col) == F.length(col), F.lower(col))
            .otherwise(F.translate(col, upper, upper.lower())))


def running(values: Column, zero: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """For each element of the array ``values`` the ``merge`` of all elements
    before it (``zero`` for the first).

    Built-in functions have no scan, and growing an array inside
    ``aggregate`` copies it for each element. Here the array is cut in runs
    of about the cube root of its doubled length: runs are folded first,
    then each element folds the runs before it (folded once) and the
    elements before it in its own run.
    """
    def over(v: Column) -> Column:
        n = F.size(v)
        width = F.greatest(F.lit(8), F.ceil(F.cbrt(n * 2)).cast("int"))

        def runs(w: Column) -> Column:
            starts = F.sequence(F.lit(0), ((n - 1) / w).cast("int"))
            folded = F.transform(starts, lambda r: F.aggregate(F.slice(v, r * w + 1, w), zero, merge))

            def heads(f: Column) -> Column:
                head = F.transform(f, lambda _, r: F.when(r == 0, zero).otherwise(
                    F.aggregate(F.slice(f, F.lit(1), F.greatest(r, F.lit(1))), zero, merge)))
                return let(head, lambda h: F.transform(v, lambda _, i: F.when(
                    i % w == 0, F.get(h, (i / w).cast("int"))).otherwise(
                    F.aggregate(F.slice(v, (i - i % w + 1).cast("int"), F.greatest(i % w, F.lit(1))),
                                F.get(h, (i / w).cast("int")), merge))))
            return let(folded, heads)
        return let(width, runs)

    return F.when(F.size(values) == 0, F.slice(F.array(zero), 2, 1)).otherwise(let(values, over))
