"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rows in an Arrow batch: texts can be long, so few of them travel at a time.
ARROW_ROWS = 256


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``. Without one a session on one machine (master ``local``) gets a temporary
    folder; on a cluster that is an error, as its machines do not see each other's folders."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        jsc = spark.sparkContext._jsc.sc().getCheckpointDir()
        if jsc.isDefined():
            root = jsc.get()
        elif spark.sparkContext.master.split("[")[0] == "local":
            root = tempfile.mkdtemp(prefix="paperloom-")
            spark.sparkContext.setCheckpointDir(root)
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
    return root.rstrip("/")


#: Tables written inside each open ``temporary_tables``, innermost last.
_made: list[list[DataFrame]] = []


@contextlib.contextmanager
def temporary_tables() -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Delete at the end all tables that were written inside, but those handed to the function that it gives: for callers who
    write an operator's result in full and then need nothing else of it."""
    _made.append([])
    kept: list[str] = []

    def keep(table: DataFrame) -> DataFrame:
        kept.append(table.written_to)
        return table

    try:
        yield keep
    finally:
        discard(*(t for t in _made.pop() if t.written_to not in kept))


def written(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage of ``df``: write it as Parquet in the shared folder and read it again.

    The files survive the loss of executors and are as small as the columns. ``discard`` deletes them, and the end of the
    innermost ``temporary_tables``; those that a returned DataFrame still reads stay until the folder is cleared.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.written_to = path
    if _made:
        _made[-1].append(table)
    return table


def discard(*tables: DataFrame) -> None:
    """Delete the files of tables from ``written`` that nothing reads any more."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.written_to)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    """Keep the Arrow batches that carry whole texts within ARROW_ROWS rows.

    Spark reads the setting when a plan runs, so it stays for the session; a smaller one of the caller's is left alone.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= ARROW_ROWS:
        spark.conf.set(key, str(ARROW_ROWS))


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, LOWER)


def text_or_empty(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


#: A key with more rows than HOT_ROWS is dealt in a join over shares of about so many rows each; the HOT_KEYS largest are.
HOT_ROWS, HOT_KEYS = 1_000, 10_000


def hot_join(rows: DataFrame, table: DataFrame, key: str, size: str, spread: str, how: str = "inner") -> DataFrame:
    """Join many ``rows`` to the one row of their key in ``table``, whose ``size`` says how many rows share the key.

    A key that holds a large part of the rows would make one join task. The HOT_KEYS largest keys are broadcast with
    their number of shares (a bounded list; any other key holds less than a HOT_KEYS-th of the rows), their rows are
    dealt by a hash of ``spread`` and their row of the table is copied to every share, one copy for HOT_ROWS rows.
    """
    shares = F.ceil(F.col(size) / HOT_ROWS).cast("int")
    hot = F.broadcast(table.where(F.col(size) > HOT_ROWS).orderBy(F.desc(size), key).limit(HOT_KEYS).select(key, shares.alias("_shares")))
    share = F.when(F.col("_shares").isNotNull(), F.pmod(F.xxhash64(spread), F.col("_shares")).cast("int")).otherwise(F.lit(-1))
    copies = F.when(F.col("_shares").isNotNull(), F.sequence(F.lit(0), F.col("_shares") - 1)).otherwise(F.array(F.lit(-1)))
    dealt = rows.join(hot, key, "left").withColumn("_share", share).drop("_shares")
    copied = table.join(hot, key, "left").withColumn("_share", F.explode(copies)).drop("_shares")
    return dealt.join(copied, [key, "_share"], how).drop("_share")
