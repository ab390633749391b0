import datetime as dt
import gzip
import os

from pyspark.sql import functions as F

from quiver.session import scratch_path
from quiver.sinks import append_price_rows, write_canopies, write_cluster_text, write_price_csv, write_symbol_directory, write_vector_text
from quiver.sinks.files import cluster_text_lines
from quiver.sources import read_canopies, read_cluster_text, read_price_csv, read_symbol_directory, read_vector_text
from quiver.sources import files as source_files
from quiver.sources.files import number_directory
from conftest import vec_df


def test_vector_text_round_trip(spark):
    rows = [("A", [0.1, 1e-7, 123456.789]), ("B", [1.0 / 3.0, 0.0, -2.5]), ("C", [0.5])]
    path = scratch_path(spark, "t-vec")
    write_vector_text(vec_df(spark, rows[:2]), path)
    got = {r["symbol"]: r["v"] for r in read_vector_text(spark, path).collect()}
    assert got == {s: v for s, v in rows[:2]}
    path1 = scratch_path(spark, "t-vec1")
    write_vector_text(vec_df(spark, rows[2:]), path1)
    assert read_vector_text(spark, path1).first()["v"] == [0.5]


def test_symbol_directory_skips_header_and_empty_lines(spark, tmp_path):
    f = tmp_path / "dir.txt"
    f.write_text("Symbol|Name\nAAA|first\nBBB|second\nCCC|third\n\n")
    got = number_directory(read_symbol_directory(spark, str(f))).orderBy("pos").collect()
    assert [(r["symbol"], r["pos"]) for r in got] == [("AAA", 0), ("BBB", 1), ("CCC", 2)]
    syms = spark.createDataFrame([(f"S{i}", i) for i in range(50)], "symbol string, pos long")
    path = scratch_path(spark, "t-dir")
    write_symbol_directory(syms.repartition(5), path)
    back = number_directory(read_symbol_directory(spark, path)).orderBy("pos").collect()
    assert [(r["symbol"], r["pos"]) for r in back] == [(f"S{i}", i) for i in range(50)]


def test_symbol_directory_split_across_tasks(spark, tmp_path):
    f = tmp_path / "big.txt"
    f.write_text("Symbol|Name\n" + "".join(f"SYM{i:05d}|name {i}\n" for i in range(3000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        raw = read_symbol_directory(spark, str(f))
        assert raw.select("block").distinct().count() > 5  # really split
        got = number_directory(raw).orderBy("pos").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [(r["symbol"], r["pos"]) for r in got] == [(f"SYM{i:05d}", i) for i in range(3000)]


def test_price_csv_per_symbol_files_and_bad_rows(spark, tmp_path):
    d = tmp_path / "prices"
    d.mkdir()
    (d / "AAA.csv").write_text("Date,Open,High,Low,Close,Volume\n2024-01-02,1,2,0.5,1.5,100\n2024-01-01,1,2,0.5,x,9\n")
    (d / "BBB.csv").write_text("Date,Open,High,Low,Close\n2024-01-02,3,4,2,3.5\n2024-01-02,5,6,4,5.5\n")
    got = read_price_csv(spark, str(d)).collect()
    # a symbol with a corrupt row fails as a whole; of one day's rows the smallest counts
    assert sorted((r["symbol"], str(r["d"]), r["close"]) for r in got) == [("BBB", "2024-01-02", 3.5)]


def test_price_csv_round_trip(spark):
    bars = spark.createDataFrame(
        [("A/B", dt.date(2024, 1, 2), 1.0, 2.0, 0.5, 1.5), ("C", dt.date(2024, 1, 1), 3.0, 4.0, 2.0, 3.5)],
        "symbol string, d date, open double, high double, low double, close double")
    path = scratch_path(spark, "t-px")
    write_price_csv(bars, path)
    assert sorted(read_price_csv(spark, path).collect()) == sorted(bars.collect())


def test_cluster_text_round_trip_with_bounded_lines(spark):
    cl = spark.createDataFrame([(1, "b"), (1, "a"), (2, "c"), (1, "d"), (3, "e")], "cluster_no int, symbol string")
    lines = {(r["cluster_no"], r["chunk"]): r["line"] for r in cluster_text_lines(cl, 2).collect()}
    assert lines == {(1, 0): "1 a b", (1, 1): "1 d", (2, 0): "2 c", (3, 0): "3 e"}
    path = scratch_path(spark, "t-cl")
    write_cluster_text(cl, path, max_symbols=2)
    assert sorted(read_cluster_text(spark, path).collect()) == sorted(cl.collect())
    one = spark.createDataFrame([(1, "only")], "cluster_no int, symbol string")
    p1 = scratch_path(spark, "t-cl1")
    write_cluster_text(one, p1)
    assert [tuple(r) for r in read_cluster_text(spark, p1).collect()] == [(1, "only")]


def test_canopy_files_round_trip(spark):
    m = vec_df(spark, [("a", [0.0]), ("b", [0.1])]).withColumn("canopy_id", F.lit("007"))
    path = scratch_path(spark, "t-can")
    write_canopies(m, path)
    assert sorted((r["symbol"], r["canopy_id"]) for r in read_canopies(spark, path).collect()) == [
        ("a", "007"), ("b", "007")]


def test_canopy_read_skips_folders_without_the_prefix(spark):
    path = scratch_path(spark, "t-foreign")
    assert read_canopies(spark, path).count() == 0  # nothing there yet
    rows = [("a", "a b", [0.1]), ("b", "a b", [0.2]), ("c", "c", [0.9])]
    write_canopies(spark.createDataFrame(rows, "symbol string, canopy_id string, v array<double>"), path)
    spark.range(5).write.parquet(f"{path}/Other")
    assert sorted((r["symbol"], r["canopy_id"]) for r in read_canopies(spark, path).collect()) == [(s, c) for s, c, _ in rows]


def test_price_files_are_scanned_once(spark):
    path = scratch_path(spark, "t-once")
    bars = [(s, dt.date(2024, 1, d), 1.0, 2.0, 0.5, 1.5) for s in "ab" for d in (1, 2)]
    write_price_csv(spark.createDataFrame(bars, "symbol string, d date, open double, high double, low double, close double"), path)
    read = read_price_csv(spark, path)
    assert read._jdf.queryExecution().executedPlan().toString().count("FileScan csv") == 1
    assert read.count() == 4


PRICES = "symbol string, d date, open double, high double, low double, close double"


def _tree(root):
    return sorted(os.path.relpath(os.path.join(at, f), root) for at, _, files in os.walk(root) for f in files)


def test_price_files_are_one_per_symbol_without_checksum_files(spark, tmp_path):
    names = ["A/B", "x=1%", "50%25", "a+b", "\u00e9 t", "c.d", "'q'", None, ""]
    bars = spark.createDataFrame([(s, dt.date(2024, 1, d), 1e10, float("nan"), -0.5, 1.5) for s in names for d in (1, 2, 3)], PRICES)
    path = str(tmp_path / "ours")
    write_price_csv(bars.repartition(3), path)
    write_price_csv(bars.coalesce(1), path)  # replaces the first
    files = _tree(path)
    theirs = str(tmp_path / "spark")
    bars.write.partitionBy("symbol").csv(theirs)
    assert {f.split("/")[0] for f in files} == {f.split("/")[0] for f in _tree(theirs) if "/" in f}  # the folders of partitionBy
    assert not [f for f in files if f.endswith(".crc") or "/." in f]
    assert len(files) <= len({*names}) + bars.rdd.getNumPartitions() + spark.sparkContext.defaultParallelism
    days = {f.split("/")[0]: [] for f in files}
    for f in files:
        with open(f"{path}/{f}", encoding="utf-8") as lines:
            head, *rows = lines.read().splitlines()
        assert head == "date,open,high,low,close"
        days[f.split("/")[0]] += rows
    assert sorted(days["symbol=c.d"]) == [f"2024-01-0{d},1.0E10,NaN,-0.5,1.5" for d in (1, 2, 3)]
    got = {(r["symbol"], r["d"]) for r in read_price_csv(spark, path).collect()}
    assert got == {(s or "__HIVE_DEFAULT_PARTITION__", dt.date(2024, 1, d)) for s in names for d in (1, 2, 3)}


def test_price_rows_are_appended_beside_the_files_of_their_symbol(spark):
    path = scratch_path(spark, "t-more")
    bars = spark.createDataFrame([(s, dt.date(2024, 1, 1), 1.0, 2.0, 0.5, 1.5) for s in "abc"], PRICES)
    write_price_csv(bars, path)
    more = [("a", "2024-01-02", "3.0", 4.0, 2.0, 3.5), ("b", "2024-01-02", "?", 4.0, 2.0, 3.5), ("d", "2024-01-02", "3.0", 4.0, 2.0, 3.5)]
    append_price_rows(spark.createDataFrame(more, "symbol string, date string, open string, high double, low double, close double"), path)
    got = {(r["symbol"], r["d"].day, r["open"]) for r in read_price_csv(spark, path).collect()}
    assert got == {("a", 1, 1.0), ("a", 2, 3.0), ("c", 1, 1.0), ("d", 2, 3.0)}  # b has an unreadable row


def test_price_files_on_a_path_that_only_spark_reaches(spark, tmp_path):
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.prices.link./far", f"file://{tmp_path}")
    bars = spark.createDataFrame([(s, dt.date(2024, 1, 1), 1.0, 2.0, 0.5, 1.5) for s in "ab"], PRICES)
    write_price_csv(bars, "viewfs://prices/far/px")
    assert sorted(read_price_csv(spark, "viewfs://prices/far/px").collect()) == sorted(bars.collect())


def _scans_files(df):
    return "FileScan csv" in df._jdf.queryExecution().executedPlan().toString()


def _both_ways(spark, path, monkeypatch):
    """Rows by the tasks' own reading and by Spark's file scan."""
    ours = read_price_csv(spark, path)
    with monkeypatch.context() as m:
        m.setattr(source_files, "MANY_ENTRIES", 10**9)
        scan = read_price_csv(spark, path)
    assert _scans_files(scan)
    return ours, sorted(map(repr, ours.collect())), sorted(map(repr, scan.collect()))


def test_tasks_that_read_price_files_do_not_grow_with_the_symbols(spark):
    most = 4 * spark.sparkContext.defaultParallelism
    bars = spark.range(2 * most).selectExpr("cast(id as string) symbol", "date'2024-01-01' d", "1d open", "2d high", "0d low", "id + 0d close")
    path = scratch_path(spark, "t-many")
    write_price_csv(bars, path)
    group = f"read {path}"
    spark.sparkContext.setJobGroup(group, group)
    try:
        got = read_price_csv(spark, path).collect()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(got) == sorted(bars.collect())
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    assert stages and max(info.numTasks for s in stages if (info := tracker.getStageInfo(s))) <= most


def test_price_files_read_by_tasks_give_the_rows_of_the_file_scan(spark, tmp_path, monkeypatch):
    head, row = b"Date,Open,High,Low,Close\n", b"2024-01-02,1,2,0.5,1.5\n"
    odd = {
        "AAA.csv": head + row, "deep/er/BBB.csv": head + row, "_hidden.csv": head + row, ".dot.csv": head + row, "empty.csv": b"", "c+d.csv": head + row,
        "_temporary/CCC.csv": head + row, "symbol=a%2Fb/p.csv": head + row, "symbol=50%25/p.csv": head + row, "symbol=e f/p q.csv": head + row,
        "symbol=\u00e9/p.csv": head + row, "symbol=__HIVE_DEFAULT_PARTITION__/p.csv": head + row, "symbol=_x/p.csv": head + row,
        "symbol=two/1.csv": head + row, "symbol=two/2.csv": head + b"2024-01-02,0,2,0.5,1.5\n2024-01-03,1,1,1,1\n", "symbol=two/_x=1/3.csv": head + b"2024-01-04,1,1,1,1",
        "header.csv": head, "headless.csv": row, "blank.csv": b"\n \t\n" + head + b"\n" + row + b"  \n\x01\n2024-01-03,1,2,0.5,1.5", "crlf.csv": (head + row + row).replace(b"\n", b"\r\n"),
        "cr.csv": (head + row).replace(b"\n", b"\r"), "bom.csv": b"\xef\xbb\xbf" + head + row, "bom2.csv": b"\xef\xbb\xbf\n" + head + row,
        "quotes.csv": head + b'"2024-01-02","1","2","0.5","1.5"\n',
        "short.csv": head + b"2024-01-02,1,2\n", "long.csv": head + b"2024-01-02,1,2,0.5,1.5,9,x\n",
        "text.csv": head + b"2024-01-02,1,2,0.5,x\n" + row, "space.csv": head + b" 2024-01-02 , 1,2 , 0.5,1.5\n", "float.csv": head + b"2024-01-02,NaN,Infinity,-Inf,1e3\n",
        "null.csv": head + b"2024-01-02,,2,0.5,1.5\n", "zero.csv": head + b"2024-01-02,1\x00,2,0.5,1.5\n",
        "date.csv": head + b"2024-1-2,1,2,0.5,1.5\n2024-01-03 10:00:00,1,2,0.5,1.5\n", "long9.csv": head + row * 50_000 + b"2024-01-03,7,7,7,7\n",
    }
    odd |= {f"symbol=S{i}/p.csv": head + row for i in range(source_files.MANY_ENTRIES)}
    no_dates = {
        "open.csv": head + b'"2024-01-02,1,2,0.5,1.5\n2024-01-03,1,2,0.5,1.5"\n', "bytes.csv": head + b"2024-01-02,1,2,0.5,1.5\n2024-01-0\xff,1,2,0.5,1.5\n",
        "quoted.csv": head + b'"2024-01-02","1","2","0.5","1.5"\n"2024-01-03,1",2,3,4\n', "hash.csv": head + b"#2024-01-02,1,2,0.5,1.5\n",
    }
    for ansi, files in (("true", odd), ("false", no_dates)):  # to_date raises an error in ANSI mode
        for name, content in files.items():
            f = tmp_path / "px" / name
            f.parent.mkdir(parents=True, exist_ok=True)
            f.write_bytes(content)
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            ours, got, want = _both_ways(spark, str(tmp_path / "px"), monkeypatch)
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")
        assert not _scans_files(ours)
        assert got == want
    for name in no_dates:
        (tmp_path / "px" / name).unlink()
    assert {"AAA", "BBB", "a/b", "50%", "e f", "\u00e9", "two", "crlf", "cr", "quotes"} <= {r["symbol"] for r in ours.collect()}
    for name in ("g.csv.gz", "h i.csv"):  # compressed, and a name that its URI changes: Spark reads the whole folder
        f = tmp_path / "px" / name
        f.write_bytes(gzip.compress(head + row) if name.endswith("gz") else head + row)
        ours, got, want = _both_ways(spark, str(tmp_path / "px"), monkeypatch)
        assert _scans_files(ours) and got == want
        f.unlink()


def test_long_price_files_are_read_in_pieces(tmp_path):
    f = tmp_path / "long.csv"
    for end in ("\n", "\r\n"):
        rows = [f"2024-01-{d:02d},{'1' * (d % 7)},2,0.5,1.5" for d in range(1, 31)]
        f.write_bytes(("Date,Open,High,Low,Close" + end + end.join(rows) + end * 2).encode())
        size = f.stat().st_size
        for step in (1, 7, 24, 25, 26, 100, size):
            lines = [line for at in range(0, size, step) for line in source_files._piece_lines(str(f), at, min(at + step, size))]
            assert lines == [r.encode() for r in rows], step
