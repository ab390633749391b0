"""File scans in the formats the pipeline reads and writes."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from quiver.functions.vectors import parse_vector_line
from quiver.operators.persist import reliable

PRICE_SCHEMA = T.StructType([
    T.StructField("date", T.StringType()),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
])
MANY_ENTRIES = 32  # a price folder with more entries is listed and read by the tasks themselves; up to as many, Spark lists in the driver
PIECE_BYTES = 16 << 20  # longer price files are read in pieces of this size
_PIECES = "file string, start long, end long, plain boolean"
_SYMBOL_FILE = re.compile(r"/symbol=[^/]+/[^/]*\.csv\Z")
_NAMED_FILE = re.compile(r"[A-Za-z0-9_.~!$&'()*+,;=@-]+\.csv\Z")  # names that are the same in a file's URI
_BLANK = bytes(range(33))


def read_symbol_directory(spark: SparkSession, path: str) -> DataFrame:
    """Pipe-delimited symbol directory: a header line, then ``SYM|...`` lines.

    -> (symbol, file, block, seq).  The line reader splits large files across
    tasks; (file, split start offset, id within the partition) is the file
    order, because a split is read front to back and ids grow along it.  The
    header is the first line of each file's offset-0 split.  Empty lines are
    dropped.  :func:`number_directory` turns the order into positions.
    """
    raw = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.col("value").alias("line"),
    )
    heads = raw.where(F.col("block") == 0).groupBy("file").agg(F.min("seq").alias("head_seq"))
    data = raw.join(heads, "file", "left").where(
        (F.col("block") != 0) | (F.col("seq") != F.col("head_seq"))).where(F.length(F.trim("line")) > 0)
    sym = F.trim(F.split_part(F.col("line"), F.lit("|"), F.lit(1)))
    return data.select(sym.alias("symbol"), "file", "block", "seq")


def number_directory(symbols: DataFrame) -> DataFrame:
    """(symbol, file, block, seq) -> (symbol, pos): global 0-based position in file order."""
    from quiver.functions.ranking import global_row_number

    ranked = global_row_number(symbols, [F.col("file"), F.col("block"), F.col("seq")], "rn")
    return ranked.select("symbol", (F.col("rn") - 1).alias("pos"))


def _unescape(c):
    """%XX decoding only ('+' is kept): file paths are URI-encoded partition values."""
    return F.url_decode(F.replace(c, F.lit("+"), F.lit("%2B")))


def read_price_csv(spark: SparkSession, path: str) -> DataFrame:
    """One CSV per symbol (``<SYM>.csv`` or a ``symbol=<SYM>/`` folder), header row.

    Columns are positional: date, open, high, low, close; further columns are
    ignored.  A symbol with a row whose date or prices do not parse fails as a
    whole, so a window never silently reaches further back; ``load_report`` and
    ``failed_symbols`` show it.  Of rows with one symbol and date the one with the
    smallest (open, high, low, close) counts.

    Spark's file scan lists every folder by a task of its own, opens 32 files in a task and takes
    milliseconds for each, so a shared ``file:`` folder with many entries is listed and read by
    the tasks themselves; what they read is parsed by Spark's CSV parser all the same.
    """
    raw = _price_rows(spark, path)
    if raw is None:
        fpath = F.col("_metadata.file_path")
        part_sym = F.regexp_extract(fpath, r"/symbol=([^/]+)/[^/]*$", 1)
        file_sym = F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.csv$", 1)
        raw = (
            spark.read.schema(PRICE_SCHEMA)
            .option("header", True)
            .option("mode", "PERMISSIVE")
            .option("recursiveFileLookup", True)
            .csv(path)
            .select(F.when(part_sym != "", _unescape(_unescape(part_sym))).otherwise(file_sym).alias("symbol"), "*")
        )
    parsed = raw.select("symbol", F.to_date("date").alias("d"), "open", "high", "low", "close")
    bad = F.lit(False)
    for c in ("d", "open", "high", "low", "close"):
        bad = bad | F.col(c).isNull()
    day = F.min(F.struct("open", "high", "low", "close")).alias("p")
    days = parsed.groupBy("symbol", "d").agg(day, F.max(bad).alias("bad"))  # one scan: the symbol's flag comes from its days
    fails = F.max("bad").over(Window.partitionBy("symbol"))
    return days.withColumn("fails", fails).where(~F.col("fails")).select("symbol", "d", "p.*")


def _price_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """(symbol, date, open, high, low, close) of a shared ``file:`` folder with many entries, read by the tasks.

    None where Spark's scan is to read: other file systems, patterns, few entries, and folders with
    files that are not plain ``.csv`` (compressed ones, names that a URI would change).
    """
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    folder = fs.makeQualified(root).toUri().getPath()
    if fs.getUri().getScheme() != "file" or re.search(r"[{}\[\]*?\\]", path) or not os.path.isdir(folder):
        return None
    with os.scandir(folder) as entries:
        if sum(1 for _ in islice(entries, MANY_ENTRIES + 1)) <= MANY_ENTRIES:
            return None
    tasks = 4 * spark.sparkContext.defaultParallelism
    entries = spark.range(1, numPartitions=1).mapInArrow(_entries(folder), "path string")  # the names of one folder, streamed
    pieces = reliable(entries.repartition(tasks, "path").mapInArrow(_file_pieces, _PIECES), "price-files")
    n, size, plain = pieces.agg(F.count(F.lit(1)), F.sum(F.col("end") - F.col("start")), F.bool_and("plain")).first()
    if not plain:
        return None
    part_sym = F.regexp_extract("file", r"/symbol=([^/]+)/[^/]*$", 1)
    file_sym = F.regexp_extract("file", r"([^/]*)\.csv$", 1)
    symbol = F.when(part_sym != "", _unescape(part_sym)).otherwise(file_sym)
    parts = max(min(n, tasks), size // (2 * PIECE_BYTES), n // 10_000)
    lines = (pieces.select(symbol.alias("symbol"), "file", "start", "end").repartition(parts, "file", "start")
             .mapInArrow(_price_lines, "symbol string, line binary"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in PRICE_SCHEMA)
    row = F.from_csv(F.col("line").cast("string"), fields, {"mode": "PERMISSIVE"})
    return lines.select("symbol", row.alias("row")).select("symbol", "row.*")


def _hidden(name: str) -> bool:
    """Names that Spark's listing leaves out."""
    return name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_")


def _entries(folder: str):
    """mapInArrow body: the paths of a folder's entries, whatever the input."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            with os.scandir(folder) as entries:
                paths = (e.path for e in entries if not _hidden(e.name))
                while some := list(islice(paths, 10_000)):
                    yield pa.RecordBatch.from_pydict({"path": pa.array(some, pa.string())})

    return run


def _files(path: str) -> Iterator[tuple[str, int]]:
    """Non-empty files (path, size) of a path that is a file or a folder of any depth."""
    if os.path.isdir(path):
        with os.scandir(path) as entries:
            for e in entries:
                if not _hidden(e.name):
                    yield from _files(e.path)
    elif os.path.isfile(path) and (size := os.path.getsize(path)):
        yield path, size


def _file_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow body: (path) -> (file, start, end, plain), files in pieces of ``PIECE_BYTES``."""
    for batch in batches:
        found = ((file, start, min(start + PIECE_BYTES, size), bool(_SYMBOL_FILE.search(file) or _NAMED_FILE.match(os.path.basename(file))))
                 for path in batch.column("path").to_pylist() for file, size in _files(path) for start in range(0, size, PIECE_BYTES))
        while some := list(islice(found, 10_000)):
            file, start, end, plain = zip(*some)
            yield pa.RecordBatch.from_pydict({"file": pa.array(file, pa.string()), "start": pa.array(start, pa.int64()),
                                              "end": pa.array(end, pa.int64()), "plain": pa.array(plain, pa.bool_())})


def _piece_lines(file: str, start: int, end: int) -> list[bytes]:
    """Lines without the header and blank ones; a line belongs to the piece that holds the byte before it."""
    with open(file, "rb") as f:
        f.seek(start)
        if start:
            f.readline()
        if f.tell() > end:
            return []
        data = f.read(end - f.tell()) + f.readline()
    if start:
        return [line for line in data.splitlines() if line.strip(_BLANK)]
    return [line for line in data.removeprefix(b"\xef\xbb\xbf").splitlines() if line.strip(_BLANK)][1:]


def _price_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """mapInArrow body: (symbol, file, start, end) -> (symbol, line), some 20,000 lines at a time."""
    symbols, lines = [], []
    for batch in batches:
        for symbol, file, start, end in zip(*(batch.column(c).to_pylist() for c in ("symbol", "file", "start", "end"))):
            piece = _piece_lines(file, start, end)
            symbols += [symbol] * len(piece)
            lines += piece
            if len(lines) >= 20_000 or end - start >= 1 << 20:
                yield pa.RecordBatch.from_pydict({"symbol": pa.array(symbols, pa.string()), "line": pa.array(lines, pa.binary())})
                symbols, lines = [], []
    yield pa.RecordBatch.from_pydict({"symbol": pa.array(symbols, pa.string()), "line": pa.array(lines, pa.binary())})


def read_vector_text(spark: SparkSession, path: str) -> DataFrame:
    """``SYM v1,v2,...`` lines -> (symbol, v array<double>)."""
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    symbol, values = parse_vector_line(F.col("value"))
    return lines.select(symbol.alias("symbol"), values.alias("v"))


def read_canopies(spark: SparkSession, path: str) -> DataFrame:
    """Canopy membership written partitioned by canopy_id (one folder per canopy).

    Only folders with the canopy prefix count; others beside them are skipped, and without any
    there are no members.
    """
    schema = "symbol string, v array<double>, canopy_id string"
    folders = f"{path}/canopy_id=*"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(folders)
    if not hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).globStatus(hadoop_path):
        return spark.createDataFrame([], schema).select("symbol", "canopy_id", "v")
    return spark.read.schema(schema).option("basePath", path).parquet(folders).select("symbol", "canopy_id", "v")


def read_assignments(spark: SparkSession, path: str) -> DataFrame:
    """Cluster assignments written by the run: every part file of the folder."""
    schema = "symbol string, canopy_id string, center_id bigint, dist double"
    return spark.read.schema(schema).parquet(path)


def read_cluster_text(spark: SparkSession, path: str) -> DataFrame:
    """Cluster text: ``<cluster_no> sym sym ...`` per line -> (cluster_no, symbol).

    A cluster may span several lines (the writer bounds each line).
    """
    lines = spark.read.text(path).where(F.length(F.trim("value")) > 0)
    toks = lines.select(F.split(F.trim("value"), " +").alias("t"))
    return toks.select(
        F.col("t")[0].cast("int").alias("cluster_no"),
        F.explode(F.slice("t", F.lit(2), F.size("t"))).alias("symbol"),
    )
