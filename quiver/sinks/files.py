"""Sinks.  All use ``mode('overwrite')``; none routes data through the driver."""

from __future__ import annotations

import os
import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from quiver.functions.ranking import global_row_number
from quiver.functions.vectors import format_vector_line
from quiver.operators.joins import salt_by_count

# Fixed value: longest cluster-text line, in symbols; larger clusters continue
# on further lines with the same cluster number.
MAX_LINE_SYMBOLS = 1_000_000  # symbols of a cluster in one line; only a larger cluster is continued on further lines


def write_symbol_directory(symbols: DataFrame, path: str) -> None:
    """(symbol, pos) -> pipe-delimited files with a header line each, in pos order.

    A distributed sort writes range-ordered part files; reading them back by
    (file name, line) restores the order, so no single task holds the list.
    """
    (symbols.orderBy(F.col("pos"))
     .select(F.col("symbol").alias("Symbol"), F.col("pos").cast("string").alias("Position"))
     .write.mode("overwrite").option("header", True).option("sep", "|").csv(path))


PRICE_COLUMNS = ("date", "open", "high", "low", "close")
NO_SYMBOL = "__HIVE_DEFAULT_PARTITION__"  # folder of rows without a symbol, as partitionBy names it
_ESCAPED = re.compile(r"""[\x01-\x1f\x7f"#%'*/:=?\\{\[\]^]""")  # characters that partitionBy writes as %XX in a folder's name


def write_price_csv(bars: DataFrame, path: str) -> None:
    """bars -> one folder of CSV files per symbol (``symbol=<SYM>/``), header row, newest first.

    Range partitioning on (symbol, date) keeps most symbols in one file while a
    symbol with a very long history is split over several tasks and files.
    """
    prices = (bars.select("symbol", F.date_format("d", "yyyy-MM-dd").alias("date"), "open", "high", "low", "close")
              .repartitionByRange("symbol", F.desc("date")).sortWithinPartitions("symbol", F.desc("date")))
    _write_symbol_folders(prices, path, "overwrite")


def append_price_rows(rows: DataFrame, path: str) -> None:
    """(symbol, date, open, high, low, close) of any type -> further files in the folders of their symbols."""
    _write_symbol_folders(rows.repartitionByRange("symbol").sortWithinPartitions("symbol"), path, "append")


def _write_symbol_folders(rows: DataFrame, path: str, mode: str) -> None:
    """Rows sorted by symbol in each partition -> a CSV file per symbol and task in ``symbol=<SYM>/``.

    Hadoop's local file system starts a process (chmod) for every folder, file and checksum file it creates, so on
    a shared ``file:`` folder the tasks write their files themselves; other file systems get Spark's own writer.
    """
    spark = rows.sparkSession
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if fs.getUri().getScheme() != "file":
        rows.write.mode(mode).partitionBy("symbol").option("header", True).csv(path)
        return
    if mode == "overwrite":
        fs.delete(root, True)
    fs.mkdirs(root)
    lines = rows.select("symbol", F.to_csv(F.struct(*PRICE_COLUMNS)).alias("line"))
    folder = fs.makeQualified(root).toUri().getPath()
    lines.mapInArrow(_symbol_files(folder, uuid.uuid4().hex), "files long").agg(F.sum("files")).collect()


def _symbol_files(folder: str, write_id: str):
    """mapInArrow body: (symbol, line) sorted by symbol -> files; one is open at a time.

    A file is written beside its place under a hidden name of the attempt and renamed, so an attempt
    that is repeated replaces its file and one that is cut off leaves nothing to read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{write_id}.csv"
        hidden = f".{name}.{task.taskAttemptId()}"
        current, out, home, files = None, None, "", 0
        for batch in batches:
            for symbol, line in zip(batch.column("symbol").to_pylist(), batch.column("line").to_pylist()):
                symbol = symbol or NO_SYMBOL
                if symbol != current:
                    if out is not None:
                        out.close()
                        os.replace(f"{home}/{hidden}", f"{home}/{name}")
                    home = f"{folder}/symbol={_ESCAPED.sub(lambda c: f'%{ord(c[0]):02X}', symbol)}"
                    os.makedirs(home, exist_ok=True)
                    out = open(f"{home}/{hidden}", "w", encoding="utf-8", newline="")
                    out.write(",".join(PRICE_COLUMNS) + "\n")
                    current, files = symbol, files + 1
                out.write(line + "\n")
        if out is not None:
            out.close()
            os.replace(f"{home}/{hidden}", f"{home}/{name}")
        yield pa.RecordBatch.from_pydict({"files": pa.array([files], pa.int64())})

    return run


def write_vector_text(vectors: DataFrame, path: str) -> None:
    vectors.select(format_vector_line("symbol", "v").alias("value")).write.mode("overwrite").text(path)


def write_canopies(members: DataFrame, path: str, rows_per_file: int = 1_000_000) -> None:
    """One folder per canopy (``canopy_id=<SYM>``) with about one file per ``rows_per_file`` members.

    Members meet by (canopy, salt), so a task writes few folders and a hot canopy many tasks.
    """
    salted, _ = salt_by_count(members.select("symbol", "v", "canopy_id"), "canopy_id", rows_per_file)
    salted.repartition("canopy_id", "__salt").drop("__salt").write.mode("overwrite").partitionBy("canopy_id").parquet(path)


def write_assignments(assignments: DataFrame, path: str) -> None:
    assignments.write.mode("overwrite").parquet(path)


def cluster_text_lines(clusters: DataFrame, max_symbols: int = MAX_LINE_SYMBOLS) -> DataFrame:
    """(cluster_no, symbol) -> (cluster_no, chunk, line): one line per cluster of up to ``max_symbols``.

    Symbols are numbered globally in (cluster_no, symbol) order by a distributed
    sort and cut by their rank inside their own cluster, so one task never gathers
    more than ``max_symbols`` and no smaller cluster is ever cut.
    """
    ranked = global_row_number(clusters.select("cluster_no", "symbol"), [F.col("cluster_no"), F.col("symbol")], "g")
    first = clusters.groupBy("cluster_no").agg(F.count(F.lit(1)).alias("n"))
    first = first.select(F.col("cluster_no").alias("k"), F.sum("n").over(
        Window.orderBy("cluster_no").rowsBetween(Window.unboundedPreceding, -1)).alias("before"))  # one row per cluster
    ranked = ranked.join(first, F.col("cluster_no") == F.col("k")).withColumn("before", F.coalesce("before", F.lit(0)))
    chunked = ranked.withColumn("chunk", F.floor((F.col("g") - F.col("before") - 1) / max_symbols).cast("long"))
    return chunked.groupBy("cluster_no", "chunk").agg(
        F.concat_ws(" ", F.array_sort(F.collect_list("symbol"))).alias("members")
    ).select("cluster_no", "chunk",
             F.concat(F.col("cluster_no").cast("string"), F.lit(" "), F.col("members")).alias("line"))


def write_cluster_text(clusters: DataFrame, path: str, max_symbols: int = MAX_LINE_SYMBOLS) -> None:
    lines = cluster_text_lines(clusters, max_symbols)
    lines.orderBy("cluster_no", "chunk").select(F.col("line").alias("value")).write.mode("overwrite").text(path)
