"""Pages under their exact names, put in place only when the whole job commits."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

FORMAT = "paperloom_pages"
#: Rows and bytes of text, either of which fills a batch that a task hands on.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20
#: The list of the attempts that succeeded, in a job's staging folder.
ATTEMPTS = "_attempts"


@dataclass
class Staged(WriterCommitMessage):
    """The folder that a task's pages wait in, and how many they are."""

    folder: str
    pages: int


def _opened(root: str):
    """(file system, path) of a folder: a mounted path, or an address of one of Arrow's file systems (s3, gs, hdfs, file)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(root)


class PageFiles(DataSource):
    """Sink for (page_path, page): ``df.write.format(FORMAT).option("path", root).mode("append")``.

    Each attempt of a task writes below ``<root>/_staging/<job>/<attempt>``; the commit moves the pages of the attempts that
    succeeded to ``<root>/<page_path>``, a page that is there is replaced. A job that fails leaves no page, and no staging
    folder. Null names are an error, null pages are empty files.

    With the option ``job`` the commit moves nothing: it leaves the list of the attempts that succeeded, and
    ``move_committed`` moves their pages in tasks.
    """

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def writer(self, schema, overwrite: bool) -> PageWriter:
        if overwrite:
            raise ValueError("pages are replaced one by one: use mode append")
        return PageWriter(self.options["path"], self.options.get("job"))


class PageWriter(DataSourceArrowWriter):
    def __init__(self, root: str, job: str | None = None):
        self.root, self.moves = root.rstrip("/"), job is None
        self.job = f"_staging/{job or uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Staged:
        files, root = _opened(self.root)
        folder, pages, made = f"{self.job}/{TaskContext.get().taskAttemptId()}", 0, set()
        for batch in iterator:
            for name, page in zip(batch.column("page_path"), batch.column("page"), strict=True):
                name, page = name.as_py(), page.as_py()
                if name is None:
                    raise ValueError("a page without a path")
                target = f"{root}/{folder}/{name}"
                parent = target.rsplit("/", 1)[0]
                if parent not in made:
                    files.create_dir(parent, recursive=True)
                    made.add(parent)
                with files.open_output_stream(target) as out:
                    out.write((page or "").encode())
                pages += 1
        return Staged(folder, pages)

    def commit(self, messages: list[Staged | None]) -> None:
        files, root = _opened(self.root)
        folders = [m.folder for m in messages if m is not None and m.pages]
        if self.moves:
            for folder in folders:
                _move(files, root, folder)
            self._clear()
        elif folders:
            with files.open_output_stream(f"{root}/{self.job}/{ATTEMPTS}") as out:
                out.write("\n".join(folders).encode())

    def abort(self, messages: list[Staged | None]) -> None:
        self._clear()

    def _clear(self) -> None:
        _clear(self.root, self.job)


def _move(files, root: str, folder: str) -> int:
    """Move an attempt's pages to their places. Done again it moves what is left; another task may be at it too."""
    from pyarrow import fs

    start, made, moved = f"{root}/{folder}", set(), 0
    for info in files.get_file_info(fs.FileSelector(start, recursive=True, allow_not_found=True)):
        if info.type != fs.FileType.File:
            continue
        target = f"{root}/{info.path.split(f'{folder}/', 1)[1]}"
        parent = target.rsplit("/", 1)[0]
        if parent not in made:
            files.create_dir(parent, recursive=True)
            made.add(parent)
        try:
            files.move(info.path, target)
        except FileNotFoundError:
            if files.get_file_info(target).type != fs.FileType.File:
                raise
        moved += 1
    return moved


def _clear(at: str, job: str) -> None:
    from pyarrow import fs

    files, root = _opened(at)
    for folder in (f"{root}/{job}", f"{root}/_staging"):
        if files.get_file_info(folder).type == fs.FileType.Directory and (folder.endswith(job) or not files.get_file_info(fs.FileSelector(folder))):
            files.delete_dir(folder)


def move_committed(spark: SparkSession, root: str, job: str) -> None:
    """Move the pages of a written job to their places, each attempt's by a task, and take the staging folder away.

    Until it is done the pages wait, so after a failure it may be called again: what has been moved stays.
    """
    from pyarrow import fs

    root = root.rstrip("/")
    files, at = _opened(root)
    listed = f"{at}/_staging/{job}/{ATTEMPTS}"
    if files.get_file_info(listed).type == fs.FileType.File:
        with files.open_input_stream(listed) as told:
            folders = told.read().decode().split("\n")

        def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            to, base = _opened(root)
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"moved": pa.array([_move(to, base, f) for f in batch.column("folder").to_pylist()], pa.int64())})

        spark.createDataFrame([(f,) for f in folders], "folder string").repartition(len(folders), "folder").mapInArrow(move, "moved long").agg(F.sum("moved")).collect()
    _clear(root, f"_staging/{job}")


def write_committed(df: DataFrame, root: str) -> None:
    """Write the exact files ``<root>/<page_path>`` of (page_path, page), all or none. One page for each path.

    A failure before all pages are written leaves none; the moves behind it run in tasks (``move_committed``).
    """
    job = uuid.uuid4().hex
    df.sparkSession.dataSource.register(PageFiles)
    df.select("page_path", "page").write.format(FORMAT).option("path", root).option("job", job).mode("append").save()
    move_committed(df.sparkSession, root, job)


def scan_pages(spark: SparkSession, root: str) -> DataFrame:
    """(page_path, page) of the Markdown files below a folder, by its path or an address of one of Arrow's file systems.

    Folders are listed and files are read by tasks, a share of the names each: neither the driver nor the plan holds a
    file's name, and no file is a task's split. Staged pages are not seen.
    """
    root = root.rstrip("/")

    def entries(recursive: bool):
        def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            from pyarrow import fs

            files, base = _opened(root)
            for batch in batches:
                for below in batch.column("name").to_pylist():
                    found = files.get_file_info(fs.FileSelector(f"{base}/{below}".rstrip("/"), recursive=recursive))
                    rows = [(f.path[len(base) + 1 :], f.type == fs.FileType.Directory) for f in found]
                    rows = [r for r in rows if r[0].split("/", 1)[0] != "_staging"]
                    yield pa.RecordBatch.from_pydict({"name": pa.array([n for n, _ in rows], pa.string()), "folder": pa.array([d for _, d in rows], pa.bool_())})

        return listed

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _opened(root)
        names, pages, size = [], [], 0
        full = lambda: pa.RecordBatch.from_pydict({"page_path": pa.array(names, pa.string()), "page": pa.array(pages, pa.string())})
        for batch in batches:
            for name in batch.column("name").to_pylist():
                with files.open_input_stream(f"{base}/{name}") as f:
                    page = f.read().decode(errors="replace")
                names.append(name)
                pages.append(page)
                size += len(page)
                if len(names) >= BATCH_ROWS or size >= BATCH_BYTES:
                    yield full()
                    names, pages, size = [], [], 0
        if names:
            yield full()

    schema = "name string, folder boolean"
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    top = spark.createDataFrame([("",)], "name string").mapInArrow(entries(False), schema)
    deep = top.where("folder").select("name").repartition(tasks, "name").mapInArrow(entries(True), schema)
    names = top.unionByName(deep).where("not folder and name like '%.md'").select("name")
    return names.repartition(tasks, "name").mapInArrow(read, "page_path string, page string")
