"""Dump rows straight from archives: members of zip and tar files, parsed as they stream.

One archive is read by one task, its members row by row.  Where the worker can open the archive's store itself
(Arrow's file systems: local, hdfs, s3, gs), it is streamed from there and may have any size; from a store that only
Spark reads it comes as one binary row, of 2 GiB at most.  Members with absolute or climbing paths and anything but
regular files are refused, and so are documents with a type declaration, nested rows, a root that doesn't
fit the member's name, and rows beyond 4 MiB.
"""

from __future__ import annotations

import io
import posixpath
import re
import tarfile
import zipfile
from collections.abc import Iterator
from xml.parsers import expat

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glyphloom.sources.tables import DUMP_COLUMNS

#: Fixed value: the largest row of a dump.
MOST_ROW_BYTES = 4 << 20
_CHUNK = 1 << 16


def member_table(name: str) -> str | None:
    """The dump table that a member's name stands for."""
    m = re.fullmatch(r"(\w+)\.xml", posixpath.basename(name), re.IGNORECASE)
    return next((t for t in DUMP_COLUMNS if m and t.lower() == m[1].lower()), None)


def safe_member(name: str) -> bool:
    parts = name.replace("\\", "/").split("/")
    return bool(name) and not name.startswith(("/", "\\")) and ".." not in parts and ":" not in parts[0]


def members(content: bytes | io.IOBase) -> Iterator[tuple[str, io.BufferedIOBase]]:
    """Name and stream of every regular member of an archive, given whole or as a seekable stream; an unsafe one is an error."""
    raw = io.BytesIO(content) if isinstance(content, bytes | bytearray | memoryview) else content
    if zipfile.is_zipfile(raw):
        with zipfile.ZipFile(raw) as z:
            for info in z.infolist():
                if not safe_member(info.filename) or (info.external_attr >> 16) & 0o170000 not in (0, 0o100000, 0o040000):
                    raise ValueError(f"refused member {info.filename!r}")
                if not info.is_dir():
                    with z.open(info) as stream:
                        yield info.filename, stream
        return
    raw.seek(0)
    with tarfile.open(fileobj=raw) as t:
        for info in t:
            if not safe_member(info.name) or not (info.isfile() or info.isdir()):
                raise ValueError(f"refused member {info.name!r}")
            if info.isfile():
                yield info.name, t.extractfile(info)


def dump_rows(stream: io.BufferedIOBase, root: str) -> Iterator[dict[str, str]]:
    """Attributes of every row of a dump document, as it is read."""
    parser = expat.ParserCreate()
    depth, ready, began = 0, [], 0

    def refuse(*_: object) -> None:
        raise ValueError("document types and entities are refused")

    def start(name: str, attributes: dict[str, str]) -> None:
        nonlocal depth, began
        if depth == 0 and name.lower() != root.lower():
            raise ValueError(f"root {name!r} where {root!r} was expected")
        if depth == 1 and name != "row" or depth > 1:
            raise ValueError(f"unexpected element {name!r}")
        if depth == 1:
            began = parser.CurrentByteIndex
            ready.append(attributes)
        depth += 1

    def end(_: str) -> None:
        nonlocal depth
        depth -= 1

    parser.StartDoctypeDeclHandler = parser.EntityDeclHandler = refuse
    parser.StartElementHandler, parser.EndElementHandler = start, end
    fed = 0
    while chunk := stream.read(_CHUNK):
        parser.Parse(chunk, False)
        fed += len(chunk)
        if fed - max(began, parser.CurrentByteIndex) > MOST_ROW_BYTES:
            raise ValueError("a row is larger than 4 MiB")
        yield from ready
        ready.clear()
    parser.Parse(b"", True)
    yield from ready


def _opened(path: str):
    """A seekable stream of an archive, or None where Arrow has no file system for its store."""
    from pyarrow import fs

    try:
        system, own = fs.FileSystem.from_uri(path)
        return system.open_input_file(own)
    except (OSError, ValueError, NotImplementedError):
        return None


def archive_rows(spark: SparkSession, path: str, tables: tuple[str, ...] = tuple(DUMP_COLUMNS), streamed: bool = True) -> DataFrame:
    """(archive, member, table, ordinal, attributes) of the dump rows in all archives under a path.

    ``streamed``: the workers open the archives themselves; without it, or from stores that they can't open, they come through Spark.
    """

    def rows_in(archive: str, content) -> Iterator[pd.DataFrame]:
        for name, stream in members(content):
            table = member_table(name)
            if table not in tables:
                continue
            batch: list[tuple] = []
            for ordinal, row in enumerate(dump_rows(stream, table), 1):
                batch.append((archive, name, table, ordinal, row))
                if len(batch) >= 2000:
                    yield pd.DataFrame(batch, columns=_COLUMNS)
                    batch = []
            if batch:
                yield pd.DataFrame(batch, columns=_COLUMNS)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for k, archive in enumerate(pdf["path"]):
                if "content" in pdf:
                    yield from rows_in(archive, pdf["content"].iloc[k])
                else:
                    with _opened(archive) as stream:
                        yield from rows_in(archive, stream)

    files = spark.read.format("binaryFile").load(path)
    first = files.select("path").first()
    # only the names are read where the workers open the files
    own = files.select("path") if streamed and first is not None and _opened(first["path"]) is not None else files.select("path", "content")
    return own.mapInPandas(run, "archive string, member string, table string, ordinal bigint, attributes map<string,string>")


_COLUMNS = ["archive", "member", "table", "ordinal", "attributes"]


def table_of(rows: DataFrame, table: str) -> DataFrame:
    """One dump table of archive rows, with its columns."""
    return rows.where(F.col("table") == table).select("archive", "ordinal", *[F.col("attributes")[c].alias(c) for c in DUMP_COLUMNS[table]])


def resumed(rows: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Rows behind the saved ordinal of their archive and table; an archive that got shorter is an error row count."""
    saved = checkpoints.select("archive", "table", F.col("ordinal").alias("_done"))
    return rows.join(saved, ["archive", "table"], "left").where(F.col("ordinal") > F.coalesce("_done", F.lit(0))).drop("_done")


def shrunk(rows: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Archives with fewer rows than were already taken from them."""
    now = rows.groupBy("archive", "table").agg(F.max("ordinal").alias("rows"))
    return checkpoints.join(now, ["archive", "table"], "left").where(F.coalesce("rows", F.lit(0)) < F.col("ordinal"))
