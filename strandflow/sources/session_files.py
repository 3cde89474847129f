"""Session folders as Spark data sources: their metadata, their episode files, and new ones as a stream.

Only the folders that are asked for are listed and read. A file's header is settled where the file
is read, so files of different headers, formats and sessions are one table of canonical channels; a file that
cannot be used is a row with its `error`, and never a failed job.
"""

from __future__ import annotations

import csv
import io
import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from strandflow.operators.canonical import canonical_name
from strandflow.profile import Profile

FORMATS = ("csv", "jsonl", "ndjson", "parquet")
META = "session.json"
#: Rows of a record batch, and bytes of small files that share a partition.
BATCH_ROWS, PARTITION_BYTES = 20_000, 16 << 20


def located(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder; a plain path is local, a URI is whatever Arrow knows."""
    return fs.FileSystem.from_uri(path) if ":/" in path else (fs.LocalFileSystem(), path)


def folders(root: str) -> list[str]:
    """Names of the folders right below `root` (none if it is not there yet)."""
    where, path = located(root)
    found = where.get_file_info(fs.FileSelector(path, allow_not_found=True))
    return sorted(f.base_name for f in found if f.type == fs.FileType.Directory)


def suffix_of(name: str) -> str:
    return name.rpartition(".")[2].lower() if "." in name else ""


@dataclass
class Files(InputPartition):
    """(directory, path, bytes) of the files that a task reads; an empty path tells of a folder that has none."""

    files: list[tuple[str, str]]


def _shared(files: list[tuple[str, str, int]]) -> list[Files]:
    """A partition for each large file; small ones share some."""
    out: list[Files] = []
    room = 0
    for directory, path, size in files:
        if not out or room < size:
            out.append(Files([]))
            room = PARTITION_BYTES
        out[-1].files.append((directory, path))
        room -= max(size, 1 << 12)
    return out


class _Folders(DataSourceReader):
    """What the readers share: the asked folders below a root."""

    def __init__(self, options: dict, schema: StructType):
        self.root, self.schema = options["root"].rstrip("/"), schema
        asked = options.get("directories")
        self.asked = None if asked is None else json.loads(asked)

    def directories(self) -> list[str]:
        return folders(self.root) if self.asked is None else sorted(set(self.asked))

    def listed(self, directory: str) -> list[fs.FileInfo]:
        where, path = located(f"{self.root}/{directory}")
        return sorted(where.get_file_info(fs.FileSelector(path, allow_not_found=True)), key=lambda f: f.path)

    def batch(self, n: int, columns: dict) -> pa.RecordBatch:
        kinds = to_arrow_schema(self.schema)
        arrays = [columns[f.name] if isinstance(columns.get(f.name), pa.Array) else pa.array(columns.get(f.name, [None] * n), f.type) for f in kinds]
        return pa.RecordBatch.from_arrays(arrays, schema=kinds)


class MetaReader(_Folders):
    def partitions(self) -> list[InputPartition]:
        return _shared([(d, f"{self.root}/{d}/{META}", 0) for d in self.directories()])

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        rows = []
        for directory, path in partition.files:
            where, at = located(path)
            body = None
            if where.get_file_info(at).type == fs.FileType.File:
                with where.open_input_stream(at) as f:
                    body = f.read().decode("utf-8", "replace")
            rows.append((directory, body))
        if rows:
            directory, body = zip(*rows, strict=True)
            yield self.batch(len(rows), {"directory": list(directory), "body": list(body)})


class SessionMeta(DataSource):
    """(directory, body): the text of each folder's session.json, null where there is none."""

    @classmethod
    def name(cls) -> str:
        return "session_meta"

    def schema(self) -> str:
        return "directory string, body string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return MetaReader(self.options, schema)


class Unusable(ValueError):
    """Why a file is an error of its session."""


class EpisodeReader(_Folders):
    """Rows of the episode files; of a file that cannot be used, one row with its error."""

    def __init__(self, options: dict, schema: StructType):
        super().__init__(options, schema)
        profile = Profile(n_joints=int(options["n_joints"]))
        self.channels, self.needed = ["t", *profile.channels()], ["t", *profile.joints("q")]

    def partitions(self) -> list[InputPartition]:
        files = []
        for directory in self.directories():
            own = [f for f in self.listed(directory) if f.type == fs.FileType.File and f.base_name != META]
            files += [(directory, f"{self.root}/{directory}/{f.base_name}", f.size or 0) for f in own]
            if not any(suffix_of(f.base_name) in FORMATS for f in own):
                files.append((directory, "", 0))
        return _shared(files)

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        for directory, path in partition.files:
            name = path.rpartition("/")[2]
            fixed = {"directory": directory, "stem": name.rpartition(".")[0], "source_file": f"{directory}/{name}" if name else None}
            if not name:
                yield self._told(fixed, error="no episode files")
            elif suffix_of(name) not in FORMATS:
                yield self._told(fixed, skipped="unsupported suffix")
            else:
                yield from self._file(path, fixed)

    def _told(self, fixed: dict, **what: str) -> pa.RecordBatch:
        return self.batch(1, {k: [v] for k, v in (fixed | what).items()})

    def _file(self, path: str, fixed: dict) -> Iterator[pa.RecordBatch]:
        where, at = located(path)
        parts = {"csv": self._csv, "parquet": self._parquet}.get(suffix_of(path), self._json)
        names: dict[str, str] = {}  # canonical name -> header
        timed = 0
        try:
            with where.open_input_file(at) as f:
                for n, columns in parts(f):
                    made = self._rows(n, columns, names)
                    timed += n - made["t"].null_count
                    yield self.batch(n, {k: [v] * n for k, v in fixed.items()} | made)
            if "t" not in names:
                raise Unusable("no recognisable time column")
            if lacking := [c for c in self.needed if c not in names]:
                raise Unusable(f"missing required column(s): {', '.join(lacking)}")
            if not timed:
                raise Unusable("no row with a time")
        except Unusable as e:
            yield self._told(fixed, error=str(e))
        except Exception as e:  # whatever a damaged file brings about is that file's error
            yield self._told(fixed, error=f"unreadable: {type(e).__name__}: {e}"[:500])

    def _rows(self, n: int, columns: dict[str, list], names: dict[str, str]) -> dict:
        """Channels as doubles (null where a cell is no number), and what else there is as text."""
        out, extra = {}, {}
        for header, cells in columns.items():
            name = canonical_name(header)
            if names.setdefault(name, header) != header:
                raise Unusable(f"several columns are {name}")
            if name in self.channels:
                out[name] = pa.array(pd.to_numeric(pd.Series(cells, dtype=object), errors="coerce").to_numpy(np.float64), from_pandas=True)
            else:
                extra[name] = cells
        out.setdefault("t", pa.nulls(n, pa.float64()))
        if extra:
            pairs = [[(k, str(v[i])) for k, v in extra.items() if v[i] is not None] for i in range(n)]
            out["extra"] = pa.array(pairs, pa.map_(pa.string(), pa.string()))
        return out

    def _csv(self, f: pa.NativeFile) -> Iterator[tuple[int, dict[str, list]]]:
        lines = csv.reader(io.TextIOWrapper(f, "utf-8-sig", newline=""))
        header = next(lines, None)
        if header is None:
            raise Unusable("empty file")
        for name in header:
            if sum(canonical_name(h) == canonical_name(name) for h in header) > 1:
                raise Unusable(f"several columns are {canonical_name(name)}")
        rows: list[list] = []

        def made() -> tuple[int, dict[str, list]]:
            return len(rows), {h: [r[i] or None for r in rows] for i, h in enumerate(header)}

        for cells in lines:
            if not cells:
                continue
            if len(cells) > len(header):
                raise Unusable(f"line {lines.line_num} has more cells than the header")
            rows.append(cells + [""] * (len(header) - len(cells)))
            if len(rows) == BATCH_ROWS:
                yield made()
                rows = []
        yield made()

    def _json(self, f: pa.NativeFile) -> Iterator[tuple[int, dict[str, list]]]:
        rows: list[dict] = []

        def made() -> tuple[int, dict[str, list]]:
            return len(rows), {k: [r.get(k) for r in rows] for k in dict.fromkeys(k for r in rows for k in r)}

        for number, line in enumerate(io.TextIOWrapper(f, "utf-8-sig"), 1):
            if line.strip():
                row = json.loads(line)
                if not isinstance(row, dict):
                    raise Unusable(f"line {number} is no object")
                rows.append(row)
            if len(rows) == BATCH_ROWS:
                yield made()
                rows = []
        yield made()

    def _parquet(self, f: pa.NativeFile) -> Iterator[tuple[int, dict[str, list]]]:
        file = pq.ParquetFile(f)
        names = file.schema_arrow.names
        if len(set(names)) < len(names):
            raise Unusable("several columns are of one name")
        yield 0, {k: [] for k in names}
        for batch in file.iter_batches(BATCH_ROWS):
            yield batch.num_rows, {k: batch.column(i).to_pylist() for i, k in enumerate(names)}


class SessionEpisodes(DataSource):
    """Canonical rows of episode files: directory, stem, source_file, t, channels, `extra`, and `error` or `skipped` of a file that gives none."""

    @classmethod
    def name(cls) -> str:
        return "session_episodes"

    def schema(self) -> str:
        channels = "".join(f", {c} double" for c in ["t", *Profile(n_joints=int(self.options["n_joints"])).channels()])
        return f"directory string, stem string, source_file string{channels}, extra map<string, string>, error string, skipped string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return EpisodeReader(self.options, schema)


class NewSessions(DataSourceStreamReader):
    """The offset is the set of folders seen: a folder counts once its session.json is there, whatever its time."""

    def __init__(self, options: dict):
        self.root = options["root"].rstrip("/")

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        where, path = located(self.root)
        files = where.get_file_info([f"{path}/{d}/{META}" for d in folders(self.root)])
        return {f.path.rpartition("/")[0].rpartition("/")[2]: 1 for f in files if f.type == fs.FileType.File}

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        new = sorted(set(end) - set(start))
        return [Files([(d, "") for d in new[at : at + 10_000]]) for at in range(0, len(new), 10_000)]

    def read(self, partition: Files) -> Iterator[tuple]:
        for directory, _ in partition.files:
            yield (directory,)


class Sessions(DataSource):
    """A stream of new folders: (directory), each once."""

    @classmethod
    def name(cls) -> str:
        return "sessions"

    def schema(self) -> str:
        return "directory string"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return NewSessions(self.options)
