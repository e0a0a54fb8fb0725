"""Digests of files and folders of any size: a Spark data source that reads byte ranges.

The planner lists the files and cuts them into pieces; each task streams its pieces through SHA-256, so that it holds one
buffer whatever the length of a file, and a lost executor costs one piece. Only digests leave the tasks.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

PIECE_BYTES = 2**31
TASK_BYTES = 2**27  # small files share a task up to this
BUFFER_BYTES = 2**22


@dataclass
class Piece:
    asked: str
    place: int  # among the pieces of what was asked for, in order of path and start
    uri: str
    path: str
    start: int
    length: int


@dataclass
class Task(InputPartition):
    pieces: list[Piece]


class PieceDigests(DataSource):
    """Options: ``paths`` (a JSON list of qualified URIs of files or folders) and ``pieceBytes``."""

    @classmethod
    def name(cls) -> str:
        return "piece_digests"

    def schema(self) -> str:
        return "asked STRING, place BIGINT, length BIGINT, sha256 STRING"

    def reader(self, schema) -> DataSourceReader:
        return PieceReader(json.loads(self.options["paths"]), int(self.options.get("pieceBytes", PIECE_BYTES)))


class PieceReader(DataSourceReader):
    def __init__(self, paths: Sequence[str], piece_bytes: int) -> None:
        if piece_bytes < 1:
            raise ValueError(f"pieces need at least one byte, not {piece_bytes}")
        self.paths, self.piece_bytes = paths, piece_bytes

    def partitions(self) -> list[Task]:
        tasks, waiting, held = [], [], 0
        for piece in (p for uri in self.paths for p in pieces_of(uri, self.piece_bytes)):
            if waiting and held + piece.length > TASK_BYTES:
                tasks.append(Task(waiting))
                waiting, held = [], 0
            waiting.append(piece)
            held += piece.length
        return [*tasks, Task(waiting)]

    def read(self, partition: Task) -> Iterator[tuple]:
        for piece in partition.pieces:
            yield piece.asked, piece.place, piece.length, digest(piece)


def file_system(uri: str):
    """The Arrow file system of a URI and the path there; Hadoop's names of local and S3 URIs are understood."""
    from pyarrow import fs

    scheme, _, rest = uri.partition(":")
    if scheme == "file":
        uri = "file:///" + rest.lstrip("/")
    elif scheme in ("s3a", "s3n"):
        uri = "s3:" + rest
    return fs.FileSystem.from_uri(uri)


def pieces_of(uri: str, piece_bytes: int) -> Iterator[Piece]:
    """The pieces of a file, or of the files below a folder; as in Spark, names that begin with ``_`` or ``.`` don't count."""
    from pyarrow import fs

    system, path = file_system(uri)
    info = system.get_file_info(path)
    files = [info]
    if info.type == fs.FileType.Directory:
        below = len(info.path.rstrip("/")) + 1
        listed = system.get_file_info(fs.FileSelector(path, recursive=True))
        files = sorted((f for f in listed if not any(n[0] in "_." for n in f.path[below:].split("/"))), key=lambda f: f.path)
    place = 0
    for f in files:
        if f.type != fs.FileType.File:
            continue
        for start in range(0, max(f.size, 1), piece_bytes):
            yield Piece(uri, place, uri, f.path, start, min(piece_bytes, f.size - start))
            place += 1


def digest(piece: Piece) -> str:
    system, _ = file_system(piece.uri)
    made, left = hashlib.sha256(), piece.length
    with system.open_input_file(piece.path) as stream:
        stream.seek(piece.start)
        while left:
            part = stream.read(min(left, BUFFER_BYTES))
            if not part:
                raise OSError(f"{piece.path} has become shorter while it was read")
            made.update(part)
            left -= len(part)
    return made.hexdigest()


def piece_digests(spark: SparkSession, uris: Sequence[str], piece_bytes: int = PIECE_BYTES) -> DataFrame:
    """One row a piece: what was asked for, the place of the piece there, its length and its SHA-256."""
    spark.dataSource.register(PieceDigests)
    return spark.read.format(PieceDigests.name()).options(paths=json.dumps(list(uris)), pieceBytes=piece_bytes).load()
