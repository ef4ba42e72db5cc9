"""Helpers that the training-data operators share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of characters that are not ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: the cluster's
    ``spark.checkpoint.dir``; only where it is unset (tests on one machine) a
    fresh temporary one, which the context then keeps."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not folder:
        context.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="mosaiq-"))
        folder = context.getCheckpointDir()
    return str(folder)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back, which
    cuts its lineage: a lost executor costs a reread, not a recomputation."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path  # type: ignore[attr-defined]
    return out


def discard(df: DataFrame | None) -> None:
    """Delete what :func:`materialize` wrote, once nothing will read it again;
    other DataFrames are left alone."""
    path = getattr(df, "_written_to", None)
    if path is not None:
        spark = df.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(at, True)


def numbered(df: DataFrame, order: Column, to: str) -> DataFrame:
    """``df`` with ``to``: each row's number, from 0, in an order without ties.
    Rows are dealt by ranges and numbered where they lie; the driver sees one
    count for each range."""
    part, at = fresh(df, "part", "at")
    ranged = df.repartitionByRange(order).sortWithinPartitions(order)
    placed = ranged.select("*", F.spark_partition_id().alias(part), F.monotonically_increasing_id().bitwiseAND(F.lit(2**33 - 1)).alias(at))
    placed = materialize(placed, "numbered")
    done, before = 0, []
    for r in sorted(placed.groupBy(part).count().collect(), key=lambda r: r[part]):
        before += [F.lit(r[part]), F.lit(done).cast("long")]
        done += r["count"]
    first = F.element_at(F.create_map(*before), F.col(part)) if before else F.lit(0).cast("long")
    return placed.withColumn(to, first + F.col(at)).drop(part, at)


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z, every other character untouched."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def count_words(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit_hash(*cols: Column) -> Column:
    """A reproducible uniform number in [0, 1) from the columns' values."""
    return (F.shiftrightunsigned(F.xxhash64(*cols), 11).cast("double")) * F.lit(2.0**-53)


def fresh(df: DataFrame, *stems: str) -> list[str]:
    """Column names that ``df`` does not have, one for each stem."""
    taken = {c.lower() for c in df.columns}
    out = []
    for stem in stems:
        name = f"__{stem}"
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
