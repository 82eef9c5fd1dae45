"""``namedfiles``: one file of its own name per row (configs of G7-G12, for a simulator to read).

``df.write.format("namedfiles")`` takes ``name`` (a path below the target,
folders allowed) and ``text``.  A task writes each file under a hidden name
of its attempt and renames it, so a file is whole when it can be seen, and a
retried or speculative task leaves the same files.  With ``overwrite`` all
this happens in a folder beside the target, which takes the target's place
when the job commits: readers see the old set or the new one.  With
``append`` files appear in the target one by one.  Either way ``_SUCCESS``
marks a complete set, and two rows of one name fail the job.  For that the
commit lists the set on the driver; with option ``uniqueNames`` the caller
has made sure already, and nothing is listed.  ``read_named`` reads files
back by their names, so a set of any size is never listed either.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage

from sweepframe.sources.blocklog import _fs


@dataclass
class _Names(WriterCommitMessage):
    count: int


def _checked(name: str | None) -> str:
    parts = (name or "").split("/")
    if any(p in ("", "..") or p.startswith((".", "_")) for p in parts):
        raise ValueError(f"namedfiles: {name!r} is no name for a file")
    return name


class NamedFilesWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path = options.get("path")
        if not self.path:
            raise ValueError("namedfiles: a path is required")
        self.overwrite = overwrite
        self.unique = str(options.get("uniqueNames", "false")).lower() == "true"
        self.job = uuid.uuid4().hex[:8]

    def _folder(self):
        """Where this job's files go."""
        filesystem, root, _ = _fs(self.path.rstrip("/"))
        head, tail = posixpath.split(root)
        return filesystem, root, posixpath.join(head, f".{tail}.{self.job}") if self.overwrite else root

    def write(self, iterator):
        filesystem, _, folder = self._folder()
        filesystem.create_dir(folder, recursive=True)
        made, count, attempt = {""}, 0, uuid.uuid4().hex[:8]
        for batch in iterator:
            names = batch.column(batch.schema.get_field_index("name")).to_pylist()
            for name, text in zip(names, batch.column(batch.schema.get_field_index("text")).to_pylist()):
                sub, base = posixpath.split(_checked(name))
                if text is None:
                    raise ValueError(f"namedfiles: {name} has no text")
                if sub not in made:
                    filesystem.create_dir(posixpath.join(folder, sub), recursive=True)
                    made.add(sub)
                hidden = posixpath.join(folder, sub, f".{base}.{attempt}")
                with filesystem.open_output_stream(hidden) as f:
                    f.write(text.encode("utf-8"))
                filesystem.move(hidden, posixpath.join(folder, name))
                count += 1
        return _Names(count)

    def _visible(self, filesystem, folder) -> int:
        from pyarrow import fs as pafs

        found = filesystem.get_file_info(pafs.FileSelector(folder, recursive=True, allow_not_found=True))
        return sum(f.is_file and not f.base_name.startswith((".", "_")) for f in found)

    def commit(self, messages):
        filesystem, root, folder = self._folder()
        filesystem.create_dir(folder, recursive=True)
        if self.overwrite and not self.unique:
            rows, files = sum(m.count for m in messages if m), self._visible(filesystem, folder)
            if rows != files:
                filesystem.delete_dir(folder)
                raise ValueError(f"namedfiles: {rows} rows have {files} names")
        with filesystem.open_output_stream(posixpath.join(folder, "_SUCCESS")):
            pass
        if self.overwrite:
            old = f"{folder}.old"
            if filesystem.get_file_info(root).type.value:
                filesystem.move(root, old)
            filesystem.move(folder, root)
            if filesystem.get_file_info(old).type.value:
                filesystem.delete_dir(old)

    def abort(self, messages):
        filesystem, _, folder = self._folder()
        if self.overwrite and filesystem.get_file_info(folder).type.value:
            filesystem.delete_dir(folder)


class NamedFilesDataSource(DataSource):
    @classmethod
    def name(cls):
        return "namedfiles"

    def schema(self):
        return "name string, text string"

    def writer(self, schema, overwrite):
        return NamedFilesWriter(self.options, overwrite)


def write_configs(configs: DataFrame, path: str, name: Column | str = "name", text: Column | str = "config", mode: str = "overwrite") -> str:
    """Rendered configs as one file per row; names that repeat fail before anything is written.

    The names alone are grouped for that, not the texts.
    """
    out = configs.select((F.col(name) if isinstance(name, str) else name).cast("string").alias("name"),
                         (F.col(text) if isinstance(text, str) else text).cast("string").alias("text"))
    twice = out.groupBy("name").agg(F.count(F.lit(1)).alias("n")).where("n > 1").first()
    if twice is not None:
        raise ValueError(f"{twice.n} configs are named {twice.name}")
    out.write.format("namedfiles").mode(mode).option("uniqueNames", "true").save(path)
    return path


#: Bytes of text that a task of ``read_named`` holds before it passes them on, and files.
_BATCH_BYTES, _BATCH_FILES = 8 << 20, 1024


def read_named(names: DataFrame, path: str, name: Column | str = "name") -> DataFrame:
    """The named files below ``path`` read whole: ``name, text``.

    The names, shared out to the tasks, say what is read; a file that is
    missing or no UTF-8 fails the job."""
    wanted = names.select((F.col(name) if isinstance(name, str) else name).cast("string").alias("name"))
    cores = names.sparkSession.sparkContext.defaultParallelism

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, root, _ = _fs(path.rstrip("/"))
        held: list[tuple[str, str]] = []
        size = 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array([h[i] for h in held], pa.string()) for i in (0, 1)], names=["name", "text"])

        for batch in batches:
            for file in batch.column(0).to_pylist():
                with filesystem.open_input_stream(posixpath.join(root, _checked(file))) as f:
                    raw = f.read()
                held.append((file, raw.decode("utf-8")))
                size += len(raw)
                if size >= _BATCH_BYTES or len(held) >= _BATCH_FILES:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()

    return wanted.repartition(4 * cores).mapInArrow(task, "name string, text string")
