"""Reading list sources as a Spark data source: a partition for each url and each range of a file, failures as rows and not as lost jobs."""

from __future__ import annotations

from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from listloom.schema import CONTENTS
from listloom.shipping import ship

USER_AGENT = "listloom/0.1"
#: Bytes of a file that one task reads, and that it holds at one time unless one line is longer.
RANGE, PIECE = 32 << 20, 4 << 20


def _file(source: object) -> Path | None:
    """The file of that name, if there is one."""
    try:
        path = Path(source.strip())
        return path if path.is_file() else None
    except (AttributeError, OSError, ValueError):
        return None


def fetch(source: str, timeout: float = 30) -> str:
    """A source's text: a file if there is one of that name, read as strict UTF-8, else what the url returns.

    Raises ValueError for what is no source, and OSError or UnicodeError where reading fails.
    """
    if not isinstance(source, str):
        raise ValueError(f"a source is a string, not {type(source).__name__}")
    if not (source := source.strip()):
        raise ValueError("a source is not empty")
    if _file(source):
        with open(source, encoding="utf-8") as f:
            return f.read()
    try:
        import requests
    except ImportError:
        return _urlopen(source, timeout)
    response = requests.get(source, timeout=timeout, headers={"User-Agent": USER_AGENT})
    response.raise_for_status()
    return response.text


def _urlopen(url: str, timeout: float) -> str:
    from urllib.request import Request, urlopen

    if "://" not in url:
        raise OSError(f"neither a file nor a url: {url}")
    with urlopen(Request(url, headers={"User-Agent": USER_AGENT}), timeout=timeout) as response:  # noqa: S310
        return response.read().decode(response.headers.get_content_charset() or "iso-8859-1", "replace")


class _Source(InputPartition):
    """Sources of one task: (index, source, begin, end), whole where end is None, else the lines that begin in a range of the file's bytes."""

    def __init__(self, parts: list[tuple[int, str, int, int | None]]):
        self.parts = parts


def _parts(index: int, source: object) -> list[tuple[int, object, int, int | None]]:
    """The ranges of a file that is too large for one task, else the whole source."""
    path = _file(source)
    size = path.stat().st_size if path else 0
    if size <= RANGE:
        return [(index, source, 0, None)]
    return [(index, source, begin, min(begin + RANGE, size)) for begin in range(0, size, RANGE)]


def _pieces(path: Path, begin: int, end: int) -> Iterator[bytes]:
    """The bytes of the lines that begin in a range of a file, in pieces that end with a line feed or the file.

    A line belongs to the range that holds its first byte. Only line feeds are looked for, which are never part of another
    character in UTF-8; what else ends lines is found within a piece.
    """
    with open(path, "rb") as f:
        if begin:
            f.seek(begin - 1)
            f.readline()  # the line that began before
        while f.tell() < end:
            data = f.read(min(PIECE, end - f.tell()))
            yield data if data.endswith(b"\n") else data + f.readline()


def _lines(source: str, begin: int, end: int | None, timeout: float) -> Iterator[list[str]]:
    """The lines of a part, some at a time. Raises where they cannot be read, maybe after some have come."""
    if (path := _file(source)) is None:
        yield fetch(source, timeout).splitlines()
        return
    for data in _pieces(path, begin, path.stat().st_size if end is None else end):
        yield data.decode("utf-8").splitlines()


class _Reader(DataSourceReader):
    def __init__(self, sources: list[str], timeout: float, content: bool, tasks: int | None):
        self.sources, self.timeout, self.content, self.tasks = sources, timeout, content, tasks

    def partitions(self) -> list[InputPartition]:
        parts = [(i, s, 0, None) for i, s in enumerate(self.sources)] if self.content else [p for i, s in enumerate(self.sources) for p in _parts(i, s)]
        n = min(len(parts), self.tasks or len(parts))
        return [_Source(parts[k::n]) for k in range(n)]

    def read(self, partition: _Source | None) -> Iterator[pa.RecordBatch]:
        for part in partition.parts if partition is not None else []:  # None: Spark's one partition of no sources
            yield from self._contents(*part) if self.content else self._read(*part)

    def _contents(self, index: int, source: str, begin: int, end: int | None) -> Iterator[pa.RecordBatch]:
        try:
            text, error = fetch(source, self.timeout), None
        except Exception as e:  # noqa: BLE001  any failure is the source's own
            text, error = None, f"{type(e).__name__}: {e}"
        kinds = [("source_idx", pa.int32()), ("source", pa.string()), ("content", pa.string()), ("error", pa.string())]
        yield pa.RecordBatch.from_pylist([{"source_idx": index, "source": source, "content": text, "error": error}], pa.schema(kinds))

    def _read(self, index: int, source: str, begin: int, end: int | None) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("source_idx", pa.int32()), ("source", pa.string()), ("line_no", pa.int64()), ("line", pa.string()), ("error", pa.string())])
        k, error = begin, None  # a line has a byte at least, so numbers of a range stay below the next range's
        try:
            for lines in _lines(source, begin, end, self.timeout):
                n = len(lines)
                yield pa.RecordBatch.from_pydict({"source_idx": [index] * n, "source": [source] * n, "line_no": range(k, k + n), "line": lines, "error": [None] * n}, schema)
                k += n
        except Exception as e:  # noqa: BLE001
            error = f"{type(e).__name__}: {e}"
        yield pa.RecordBatch.from_pydict({"source_idx": [index], "source": [source], "line_no": [None], "line": [None], "error": [error]}, schema)


class ListSource(DataSource):
    """Format "lists": option sources (JSON array of files and urls), timeout (seconds), content (true: whole texts), tasks (how many read at one time, all parts dealt to them)."""

    @classmethod
    def name(cls) -> str:
        return "lists"

    def _content(self) -> bool:
        return str(self.options.get("content", "false")).lower() == "true"

    def schema(self) -> str:
        return CONTENTS if self._content() else "source_idx int, source string, line_no bigint, line string, error string"

    def reader(self, schema) -> _Reader:  # noqa: ANN001
        import json

        return _Reader(json.loads(self.options["sources"]), float(self.options.get("timeout", 30)), self._content(), int(self.options.get("tasks", 0)) or None)


def _load(spark: SparkSession, sources: list[str], timeout: float, content: bool, max_workers: int | None) -> DataFrame:
    import json

    ship(spark)
    spark.dataSource.register(ListSource)
    options = {"sources": json.dumps(sources), "timeout": str(timeout), "content": str(content).lower(), "tasks": str(max_workers or 0)}
    return spark.read.format("lists").options(**options).load()


def read_lines(spark: SparkSession, sources: list[str], timeout: float = 30, max_workers: int | None = None) -> DataFrame:
    """(source_idx, source, line_no, line, error): the lines of all sources, and for each part that was read a row without line, with its error if it failed.

    Files of over RANGE bytes are read by several tasks, a range each; line_no rises with the lines of a source and, in
    such a file, goes on from a range's first byte. A source fails as a whole: readable() leaves out the lines that came
    before its error, or from its other ranges. max_workers bounds the tasks; None is one for each part.
    """
    return _load(spark, sources, timeout, content=False, max_workers=max_workers)


def readable(read: DataFrame, lines: bool = True) -> DataFrame:
    """The lines of read_lines() of the sources without an error; or, not lines, a row (source_idx, source) for each such source."""
    whole = read.where("line IS NULL").groupBy("source_idx", "source").agg(F.count("error").alias("errors"))
    if not lines:
        return whole.where("errors = 0").select("source_idx", "source")
    failed = whole.where("errors > 0").select("source_idx")
    return read.where("line IS NOT NULL").drop("error").join(failed, "source_idx", "left_anti")


def read_contents(spark: SparkSession, sources: list[str], timeout: float = 30, max_workers: int | None = None) -> DataFrame:
    """(source_idx, source, content, error) of each distinct source string; the content of a failed one is null."""
    return _load(spark, list(dict.fromkeys(sources)), timeout, content=True, max_workers=max_workers)


def read_files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(source_idx, source, content, error) of files in any store that Spark reads; bytes that are no UTF-8 fail the file.

    Like any Spark scan it takes globs and folders; source_idx follows the paths found, in their order.
    """
    from pyspark.sql import Window

    files = spark.read.format("binaryFile").load(paths)
    found = files.select("path", F.col("content").cast("string").alias("text"))
    order = files.select("path").withColumn("source_idx", (F.row_number().over(Window.orderBy("path")) - 1).cast("int"))  # one row a file
    valid = F.is_valid_utf8("text")
    error = F.when(~valid, F.lit("UnicodeDecodeError: invalid UTF-8"))
    return found.join(order, "path").select("source_idx", F.col("path").alias("source"), F.when(valid, F.col("text")).alias("content"), error.alias("error"))
