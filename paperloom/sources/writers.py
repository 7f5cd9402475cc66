"""Writers of selections, pages and the response cache."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions.strings import category_dir


#: Tasks that may write to one folder, and the rows of a file at most.
SPREAD, MOST_ROWS = 32, 1_000_000


def _spread(df: DataFrame, folder: str, by: str, spread: int) -> DataFrame:
    """Rows of a folder dealt over ``spread`` tasks, so that a folder is not one task's work and holds few files."""
    return df.repartition(folder, F.pmod(F.xxhash64(by), F.lit(spread)))


def write_selection(df: DataFrame, path: str, spread: int = SPREAD) -> None:
    """JSON, one folder per category; a dot in its code becomes an underscore."""
    named = df.withColumn("category_name", F.replace("category", F.lit("."), F.lit("_")))
    _spread(named, "category_name", "id", spread).write.option("maxRecordsPerFile", MOST_ROWS).partitionBy("category_name").json(path)


def write_pages(df: DataFrame, path: str, spread: int = SPREAD) -> None:
    """Pages (category, page_path, page) as Parquet, one folder per category's name."""
    placed = df.withColumn("category_dir", category_dir(F.col("category")))
    _spread(placed, "category_dir", "page_path", spread).write.option("maxRecordsPerFile", MOST_ROWS).partitionBy("category_dir").parquet(path)


def write_page_files(df: DataFrame, root: str) -> DataFrame:
    """The exact files ``<root>/<page_path>``, written by the tasks; ``root`` must be a folder that all of them share.

    Returns (page_path, bytes). Writing a page again gives the same file, so a task that is run again does no harm.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        made = set()
        for batch in batches:
            sizes = []
            for name, page in zip(batch.column("page_path"), batch.column("page"), strict=True):
                target, data = os.path.join(root, name.as_py()), page.as_py().encode()
                folder = os.path.dirname(target)
                if folder not in made:
                    os.makedirs(folder, exist_ok=True)
                    made.add(folder)
                with open(f"{target}.{os.getpid()}.tmp", "wb") as f:
                    f.write(data)
                os.replace(f"{target}.{os.getpid()}.tmp", target)
                sizes.append(len(data))
            yield pa.RecordBatch.from_pydict({"page_path": batch.column("page_path"), "bytes": pa.array(sizes, pa.int64())})

    return df.select("page_path", "page").mapInArrow(write, "page_path string, bytes long")


def write_cache(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)
