"""A Structured Streaming source of whole files: any name, a folder or a single file, any file system.

Spark's own file stream leaves out names that begin with '_' or '.'.  This
source lists with pyarrow and keeps its own offset log: an entry per planned
batch with the files that are new since all earlier entries, written under a
temporary name and renamed.  Offsets are entry numbers, so a batch that Spark
replays after a failure reads exactly the files it was planned with, and a file
is in one entry only, whatever happens between planning and commit.
"""

from __future__ import annotations

SCHEMA = "path string, length long, content binary"
#: file bytes of one record batch, and of one task
READ_BYTES, TASK_BYTES = 4 * 1024 * 1024, 64 * 1024 * 1024
#: files of one task
TASK_FILES = 1_000


def folder_source() -> type:
    """The data source class, made here so that workers need no module of ours to unpickle it."""
    from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

    task_bytes, task_files, read_bytes, schema = TASK_BYTES, TASK_FILES, READ_BYTES, SCHEMA

    def file_system(path):
        from pyarrow import fs as pafs

        if path.startswith("file:") and not path.startswith("file://"):
            path = path[len("file:") :]
        return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)

    class Files(InputPartition):
        def __init__(self, files):
            self.files = files

    class Reader(DataSourceStreamReader):
        def __init__(self, options):
            self.path, self.log = options["path"], options["log"]
            self.suffixes = tuple(s for s in options.get("suffixes", "").split(",") if s)
            self.limit = int(options.get("maxfiles", 0))

        def entries(self):
            """Names of the log's entries, in order."""
            from pyarrow import fs as pafs

            filesystem, inner = file_system(self.log)
            filesystem.create_dir(inner, recursive=True)
            found = filesystem.get_file_info(pafs.FileSelector(inner))
            return sorted(i.path for i in found if i.path.endswith(".json"))

        def files_of(self, entry):
            import json

            filesystem, _ = file_system(self.log)
            with filesystem.open_input_stream(entry) as f:
                return json.loads(f.read())

        def listed(self):
            from pyarrow import fs as pafs

            filesystem, inner = file_system(self.path)
            info = filesystem.get_file_info(inner)
            if info.type == pafs.FileType.File:
                return [(self.path, info.size)]
            found = filesystem.get_file_info(pafs.FileSelector(inner))
            named = [(self.path + i.path[len(inner) :], i.size) for i in found if i.type == pafs.FileType.File]
            return sorted(f for f in named if not self.suffixes or f[0].rsplit(".", 1)[-1].lower() in self.suffixes)

        def initialOffset(self):
            return {"n": 0}

        def latestOffset(self):
            import json

            entries = self.entries()
            seen = {path for e in entries for path, _ in self.files_of(e)}
            new = [f for f in self.listed() if f[0] not in seen]
            new = new[: self.limit] if self.limit else new
            if new:
                filesystem, inner = file_system(self.log)
                name = f"{inner}/{len(entries):08d}"
                with filesystem.open_output_stream(name + ".tmp") as f:
                    f.write(json.dumps(new).encode())
                filesystem.move(name + ".tmp", name + ".json")
            return {"n": len(entries) + bool(new)}

        def partitions(self, start, end):
            parts, held, size = [], [], 0
            for entry in self.entries()[start["n"] : end["n"]]:
                for path, length in self.files_of(entry):
                    held.append((path, length))
                    size += length
                    if size >= task_bytes or len(held) >= task_files:
                        parts.append(Files(held))
                        held, size = [], 0
            return [*parts, Files(held)] if held or not parts else parts

        def read(self, partition):
            import pyarrow as pa

            shape = pa.schema([("path", pa.string()), ("length", pa.int64()), ("content", pa.binary())])
            rows, size = [], 0
            for path, _ in partition.files:
                filesystem, inner = file_system(path)
                with filesystem.open_input_stream(inner) as f:
                    content = f.read()
                rows.append((path, len(content), content))
                size += len(content)
                if size >= read_bytes:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), shape.types)], schema=shape)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), shape.types)], schema=shape)

    class FolderSource(DataSource):
        @classmethod
        def name(cls):
            return "sftprep_folder"

        def schema(self):
            return schema

        def streamReader(self, schema):
            return Reader(self.options)

    return FolderSource
