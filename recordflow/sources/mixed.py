"""Record files of one folder whose headers differ, read in one pass.

Spark's own reader wants one header for all files, and finding the headers
first costs a scan of everything. This is a data source of its own: a partition
is a piece of one file, and its task takes the header from the file's first
block before it reads the piece. Nothing but the list of files passes through
the driver.

The caller names the columns. Columns that a file lacks are NULL, and columns
that were not named are collected in a map, if the caller wants one. Paths are
opened by Arrow (local and shared disks, and the object stores that Arrow
knows); elsewhere ``read_csv_as_text(mixed=True)`` does the same with two scans.
"""

from __future__ import annotations

import csv
import fnmatch
import io
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyarrow import csv as arrow_csv, fs
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from recordflow.functions.coerce import NULL_TOKENS, null_tokens
from recordflow.session import package_on_workers
from recordflow.sources.delimited import DIALECT, POSITION, typed

REST = "_rest"
#: Size of a piece of a file, and of the blocks that are parsed at once.
SPLIT_BYTES, BLOCK_BYTES = 64 << 20, 4 << 20
_MARK = b"\xef\xbb\xbf"


@dataclass
class Piece(InputPartition):
    """Bytes ``start`` to ``end`` of a file: the lines that begin there. ``end`` is None for a whole file."""

    path: str
    start: int
    end: int | None


class MixedCsv(DataSource):
    """Options: ``path``, ``splitBytes`` and ``multiLine``; the schema is the caller's."""

    @classmethod
    def name(cls) -> str:
        return "recordflow_mixed_csv"

    def schema(self):
        raise ValueError("name the columns to read: the files' own headers differ")

    def reader(self, schema: T.StructType) -> MixedReader:
        whole = self.options.get("multiline", "false") == "true"
        return MixedReader(schema, self.options["path"], int(self.options.get("splitbytes", SPLIT_BYTES)), whole)


class MixedReader(DataSourceReader):
    def __init__(self, schema: T.StructType, path: str, split: int, whole: bool):
        self.schema, self.path, self.split, self.whole = schema, path, split, whole

    def partitions(self) -> list[Piece]:
        store, root = _store(self.path)
        out = []
        for info in _files(store, root):
            if self.whole:
                out.append(Piece(info.path, 0, None))
            else:
                out += [Piece(info.path, at, min(at + self.split, info.size)) for at in range(0, info.size, self.split)]
        if not out and not _matches(store, root):
            raise FileNotFoundError(f"{self.path}: no such file or folder")
        return out

    def read(self, piece: Piece | None) -> Iterator[pa.RecordBatch]:
        if piece is None:  # a folder without files
            return
        store, _ = _store(self.path)
        try:
            with store.open_input_file(piece.path) as file:
                names, length = _header(file)
                if not names:
                    return
                row = 0
                for block in _whole(file, length) if piece.end is None else _blocks(file, max(piece.start, length), piece.end):
                    table = _parsed(block, names, piece.end is None)
                    yield _as_batch(table, names, self.schema, piece, row)
                    row += table.num_rows
        except (ValueError, pa.ArrowInvalid, csv.Error) as error:
            raise ValueError(f"{piece.path}: {error}") from error


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):  # also file:/x, as Spark writes it
        return fs.LocalFileSystem(), unquote(urlsplit(path).path)
    return fs.FileSystem.from_uri(path)


def _children(store: fs.FileSystem, folder: str) -> list[fs.FileInfo]:
    found = store.get_file_info(fs.FileSelector(folder))
    return sorted((x for x in found if not x.base_name.startswith(("_", "."))), key=lambda x: x.path)


def _matches(store: fs.FileSystem, pattern: str) -> list[fs.FileInfo]:
    """What a path with ``*``, ``?`` and ``[...]`` in some parts names."""
    fixed, *parts = pattern.split("/")
    found = [fs.FileInfo(fixed, fs.FileType.Directory)]
    for part in parts:
        if not part:
            continue
        folders = [x for x in found if x.type == fs.FileType.Directory]
        if any(c in part for c in "*?["):
            found = [c for x in folders for c in _children(store, x.path or "/") if fnmatch.fnmatchcase(c.base_name, part)]
        else:
            found = [x for x in store.get_file_info([f"{x.path}/{part}" for x in folders]) if x.type != fs.FileType.NotFound]
    return found


def _files(store: fs.FileSystem, pattern: str) -> list[fs.FileInfo]:
    out = []
    for found in _matches(store, pattern):
        inside = [found] if found.type == fs.FileType.File else _children(store, found.path)
        out += [x for x in inside if x.type == fs.FileType.File]
    return out


def _header(file: pa.NativeFile) -> tuple[list[str], int]:
    """The column names and the bytes they take; no names for an empty file."""
    head, size = b"", 1 << 16
    while b"\n" not in head and len(head) < file.size():
        file.seek(0)
        head, size = file.read(size), size * 4
    line = head.split(b"\n", 1)[0]
    text = line.removeprefix(_MARK).decode("utf-8").rstrip("\r")
    if not text:
        return [], 0
    names = next(csv.reader([text], delimiter=DIALECT["sep"], quotechar=DIALECT["quote"]))
    twice = sorted({n for n in names if names.count(n) > 1})
    if twice:
        raise ValueError(f"columns {twice} occur twice in the header")
    return names, len(line) + 1


def _blocks(file: pa.NativeFile, start: int, end: int) -> Iterator[bytes]:
    """Whole lines that begin between two positions."""
    if start >= end:
        return
    file.seek(start - 1)  # a header stands before
    rest = b""
    if file.read(1) != b"\n":
        start += len(_line(file))
        file.seek(start)
    while start < end:
        block = file.read(min(BLOCK_BYTES, end - start))
        if not block:
            break
        start += len(block)
        if start >= end and not block.endswith(b"\n"):
            block += _line(file)
        cut = len(block) if start >= end else block.rfind(b"\n") + 1
        yield rest + block[:cut]
        rest = block[cut:]
    if rest:
        yield rest


def _line(file: pa.NativeFile) -> bytes:
    """From here to the end of the line."""
    out, at = b"", file.tell()
    while b"\n" not in out:
        more = file.read(1 << 16)
        if not more:
            return out
        out += more
    out = out[: out.index(b"\n") + 1]
    file.seek(at + len(out))
    return out


def _whole(file: pa.NativeFile, start: int) -> Iterator[bytes]:
    """All of a file whose cells hold line breaks, as one block."""
    file.seek(start)
    yield file.read()


def _parsed(block: bytes, names: list[str], breaks: bool) -> pa.Table:
    """Text columns; an empty cell is NULL. A row with another number of cells loses or lacks the last ones."""
    odd = []

    def keep(row) -> str:
        odd.append(row.text)
        return "skip"

    if not block.strip():
        return pa.table({n: pa.array([], pa.string()) for n in names})
    table = arrow_csv.read_csv(
        io.BytesIO(block),
        read_options=arrow_csv.ReadOptions(column_names=names, use_threads=False, block_size=len(block) + 1),
        parse_options=arrow_csv.ParseOptions(
            delimiter=DIALECT["sep"], quote_char=DIALECT["quote"], double_quote=True, newlines_in_values=breaks, invalid_row_handler=keep
        ),
        convert_options=arrow_csv.ConvertOptions(
            column_types={n: pa.string() for n in names}, null_values=[""], strings_can_be_null=True, quoted_strings_can_be_null=True
        ),
    )
    if not odd:
        return table
    rows = csv.reader(odd, delimiter=DIALECT["sep"], quotechar=DIALECT["quote"])
    cells = [([cell or None for cell in row] + [None] * len(names))[: len(names)] for row in rows]
    return pa.concat_tables([table, pa.table({n: pa.array(c, pa.string()) for n, c in zip(names, zip(*cells))})])


def _as_batch(table: pa.Table, names: list[str], schema: T.StructType, piece: Piece, row: int) -> pa.RecordBatch:
    columns, wanted = [], set(schema.names)
    for field in schema.fields:
        if field.name == POSITION[0]:
            columns.append(pa.array([piece.path] * table.num_rows, pa.string()))
        elif field.name == POSITION[1]:
            columns.append(pa.array([piece.start] * table.num_rows, pa.int64()))
        elif field.name == POSITION[2]:
            columns.append(pa.array(range(row, row + table.num_rows), pa.int64()))
        elif field.name == REST:
            others = [n for n in names if n not in wanted]
            cells = zip(*(table[n].to_pylist() for n in others)) if others else [()] * table.num_rows
            columns.append(pa.array([list(zip(others, c)) for c in cells], pa.map_(pa.string(), pa.string())))
        elif field.name in names:
            columns.append(table[field.name].combine_chunks())
        else:
            columns.append(pa.nulls(table.num_rows, pa.string()))
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.concat_arrays(c.chunks) for c in columns], names=schema.names)


def read_mixed_text(
    spark: SparkSession, path: str, columns: Sequence[str], rest: bool = False, position: bool = False, multiline: bool = False,
    split_bytes: int = SPLIT_BYTES,
) -> DataFrame:
    """The named columns as text from files that each have a header of their own.

    ``rest`` adds the other columns of each file as a map :data:`REST`;
    ``position`` adds :data:`~recordflow.sources.delimited.POSITION` (file, piece
    and row within it). Files are cut between tasks; ``multiline`` reads cells
    with line breaks, each file by one task. A file that cannot be read as text
    or names a column twice is an error that names the file; one without a
    header line has no rows.
    """
    package_on_workers(spark)
    spark.dataSource.register(MixedCsv)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    if rest:
        schema.add(REST, T.MapType(T.StringType(), T.StringType()))
    if position:
        schema.add(POSITION[0], T.StringType()).add(POSITION[1], T.LongType()).add(POSITION[2], T.LongType())
    reader = spark.read.format(MixedCsv.name()).schema(schema).option("splitBytes", split_bytes)
    return reader.option("multiLine", str(multiline).lower()).load(path)


def read_mixed_records(
    spark: SparkSession, path: str, schema: T.StructType | str, tokens: tuple[str, ...] = NULL_TOKENS, **options
) -> DataFrame:
    """Typed records, as ``read_records_csv`` gives them; ``options`` are those of :func:`read_mixed_text`."""
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    raw = read_mixed_text(spark, path, schema.names, **options)
    others = [c for c in raw.columns if c not in schema.names]
    return raw.select(*[typed(null_tokens(F.col(f"`{f.name}`"), tokens), f.dataType).alias(f.name) for f in schema.fields], *others)
