"""A sink that inserts rows in batches of a fixed size and counts only when all tasks are done.

Format ``quernel_batches``, for stores that take limited batches: each task sends
its rows in batches of ``batch`` rows and a last, smaller one. A batch becomes one
file of JSON lines below the shared path; the commit, which runs once after all
tasks, lists the files that count. A task that is run again writes files of its own, and
those of the attempt that failed are not in the list. An aborted write lists nothing.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

#: Rows of a batch where no size is given.
BATCH_ROWS = 250
FORMAT = "quernel_batches"
_LIST = "_written"


class _Sent(WriterCommitMessage):
    """What one task sent: file names, and the rows of each."""

    def __init__(self, files: list[str], rows: list[int]):
        self.files, self.rows = files, rows


def _store(path: str):
    """File system and folder of a path or URI."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path


class BatchWriter(DataSourceWriter):
    def __init__(self, path: str, batch: int, overwrite: bool):
        if batch < 1:
            raise ValueError("a batch has one row at least")
        self.path, self.batch, self.overwrite, self.load = path.rstrip("/"), batch, overwrite, uuid.uuid4().hex

    def write(self, rows) -> _Sent:
        from pyspark import TaskContext

        context = TaskContext.get()
        name = f"{self.load}-{context.partitionId()}-{context.taskAttemptId()}"
        store, folder = _store(self.path)
        store.create_dir(f"{folder}/batches", recursive=True)
        files, counts, held = [], [], []

        def insert():
            file = f"batches/{name}-{len(files)}.json"
            text = "".join(json.dumps(row.asDict(True), default=str) + "\n" for row in held)
            with store.open_output_stream(f"{folder}/{file}") as out:
                out.write(text.encode())
            files.append(file)
            counts.append(len(held))
            held.clear()

        for row in rows:
            held.append(row)
            if len(held) == self.batch:
                insert()
        if held:
            insert()
        return _Sent(files, counts)

    def commit(self, messages) -> None:
        """Once, on the driver: the names of the files, some bytes for each batch of rows."""
        store, folder = _store(self.path)
        sent = [(f, n) for m in messages if m is not None for f, n in zip(m.files, m.rows)]
        before = [] if self.overwrite else listed(self.path)
        store.create_dir(folder, recursive=True)
        text = "".join(json.dumps({"file": f, "rows": n}) + "\n" for f, n in before + sent)
        # The list is replaced as a whole: a reader has the old or the new one.
        with store.open_output_stream(f"{folder}/{_LIST}-{self.load}") as out:
            out.write(text.encode())
        store.move(f"{folder}/{_LIST}-{self.load}", f"{folder}/{_LIST}")

    def abort(self, messages) -> None:
        """Nothing is listed, so nothing counts; files of tasks that did end are taken away."""
        store, folder = _store(self.path)
        for message in messages:
            for file in message.files if message is not None else ():
                store.delete_file(f"{folder}/{file}")


class BatchSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self):
        return self.options["schema"]

    def writer(self, schema, overwrite: bool) -> BatchWriter:
        return BatchWriter(self.options["path"], int(self.options.get("batch", BATCH_ROWS)), overwrite)


def listed(path: str) -> list[tuple[str, int]]:
    """(file, rows) of the batches that count."""
    from pyarrow import fs

    store, folder = _store(path.rstrip("/"))
    if store.get_file_info(f"{folder}/{_LIST}").type == fs.FileType.NotFound:
        return []
    with store.open_input_stream(f"{folder}/{_LIST}") as lines:
        return [(r["file"], r["rows"]) for r in map(json.loads, lines.read().decode().splitlines())]


def save_batches(df: DataFrame, path: str, batch: int = BATCH_ROWS, mode: str = "overwrite") -> None:
    """Rows in batches; ``overwrite`` starts anew, ``append`` adds."""
    df.sparkSession.dataSource.register(BatchSource)
    df.write.format(FORMAT).mode(mode).options(path=path, batch=batch, schema="x int").save()


def load_batches(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of the batches that count."""
    files = [f"{path.rstrip('/')}/{file}" for file, _ in listed(path)]
    return spark.read.schema(schema).json(files) if files else spark.createDataFrame([], schema)
