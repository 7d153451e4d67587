"""Sources and sinks: explicit scans, counts, verified publication."""

from __future__ import annotations

import json
import math
import tempfile
import uuid
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from priorwise.operators.groups import content_fingerprint

CODECS = {"snappy", "none", "zstd"}


def scan_explicit(spark: SparkSession, path: str, columns: Sequence[str]) -> DataFrame:
    """Only the named columns; the scan prunes the rest."""
    return spark.read.parquet(path).select(*columns)


def scan_jdbc(spark: SparkSession, url: str, table: str, columns: Sequence[str], key: str, low: int, high: int, partitions: int, fetch: int = 10_000, **options: str) -> DataFrame:
    """The named columns of a database table, read in key ranges by parallel tasks."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, partitionColumn=key, lowerBound=low, upperBound=high, numPartitions=partitions, fetchsize=fetch, **options)
    return reader.load().select(*columns)


def scan_jdbc_balanced(spark: SparkSession, url: str, table: str, columns: Sequence[str], key: str, partitions: int, low: int, high: int, fetch: int = 10_000, **options: str) -> DataFrame:
    """As :func:`scan_jdbc`, but each task reads about as many rows, however the key is skewed.

    The key alone is read first, in even ranges from ``low`` to ``high``; its
    exact quantiles bound the ranges of the second read.  Rows of one key stay
    together, rows without a key go with the first range.
    """
    from priorwise.operators.quantiles import exact_quantiles

    keys = scan_jdbc(spark, url, table, [key], key, low, high, partitions, fetch, **options)
    found = exact_quantiles(keys, key, [k / partitions for k in range(1, partitions)]).first() if partitions > 1 else None
    # one number a partition
    bounds = sorted({math.ceil(x) for x in found["q"]}) if found else []
    if not bounds:
        return scan_jdbc(spark, url, table, columns, key, low, high, 1, fetch, **options)
    quoted = '"' + key.replace('"', '""') + '"'
    inner = [f"{quoted} >= {a} AND {quoted} < {b}" for a, b in zip(bounds, bounds[1:])]  # noqa: B905
    predicates = [f"{quoted} < {bounds[0]} OR {quoted} IS NULL", *inner, f"{quoted} >= {bounds[-1]}"]
    return spark.read.jdbc(url, table, predicates=predicates, properties={**options, "fetchsize": str(fetch)}).select(*columns)


def scan_all_tables(spark: SparkSession, root: str, contract: Mapping[str, Sequence[str]]) -> dict[str, DataFrame]:
    """Every contract table, lazily, with its contract columns."""
    return {name: scan_explicit(spark, f"{root}/{name}.parquet", columns) for name, columns in contract.items()}


def exact_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table_name, row_count."""
    counts = [t.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name, t in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def chunks(df: DataFrame, key: str, columns: Sequence[str], rows: int) -> DataFrame:
    """The named columns and chunk: its number when rows in the order of a unique key go ``rows`` to a chunk."""
    from priorwise.operators.metrics import global_place

    placed = global_place(df.select(*dict.fromkeys([key, *columns])), [F.col(key)], F.lit(0))
    return placed.select(*columns, F.floor(F.col("place") / rows).cast("long").alias("chunk"))


def deliver_chunks(df: DataFrame, key: str, columns: Sequence[str], rows: int, sink: Callable[[int, pa.Table], None]) -> DataFrame:
    """chunk, rows: ``sink`` is given each chunk's number and Arrow table by the task that holds it.

    Rows go from executor to sink; the driver sees none.  A task that is tried
    again delivers the same chunks under the same numbers, so a sink that
    replaces what it has under a number holds every row once.
    """

    def work(table: pa.Table) -> pa.Table:
        number = table.column("chunk")[0].as_py()
        sink(number, table.drop_columns(["chunk"]))
        return pa.table({"chunk": [number], "rows": [table.num_rows]})

    return chunks(df, key, columns, rows).groupBy("chunk").applyInArrow(work, "chunk long, rows long")


def plan_columns(mappings: DataFrame, excluded: Sequence[str] = ()) -> DataFrame:
    """table_name, columns: what the field mappings need of each table, sorted, without excluded tables.

    ``mappings``: source_table, source_column, join_columns (array of
    "table.column" on the way there).
    """
    direct = mappings.select(F.col("source_table").alias("table_name"), F.col("source_column").alias("column_name"))
    path = mappings.select(F.explode("join_columns").alias("step")).select(F.substring_index("step", ".", 1).alias("table_name"), F.substring_index("step", ".", -1).alias("column_name"))
    needed = direct.unionByName(path).distinct()
    if excluded:
        needed = needed.filter(~F.col("table_name").isin(*excluded))
    return needed.groupBy("table_name").agg(F.array_sort(F.collect_set("column_name")).alias("columns"))


def scan_labels_semi(labels: DataFrame, keys: DataFrame, key: str, target: str) -> DataFrame:
    """Labels of the allowed keys only."""
    return labels.select(key, target).join(keys.select(key).distinct(), key, "left_semi")


def label_guard(labels: DataFrame, keys: DataFrame, key: str, target: str) -> DataFrame:
    """One row of counts that must be zero: keys without a label, labels that are not binary, duplicates."""
    found = scan_labels_semi(labels, keys, key, target)
    missing = keys.select(key).distinct().join(labels, key, "left_anti").agg(F.count(F.lit(1)).alias("missing_labels"))
    checks = found.agg(F.count_if(~F.coalesce(F.col(target).isin(0, 1), F.lit(False))).alias("invalid_labels"), (F.count(F.lit(1)) - F.count_distinct(key)).alias("duplicate_labels"))
    return missing.crossJoin(checks)


def shared_folder(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; only a local master may go without, and gets a temporary one set."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="priorwise-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


#: Spark's setting by which the shuffle files of a query are deleted when it ends.
_SHUFFLES_END = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _set_for(spark: SparkSession, **settings: str) -> Iterator[None]:
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def _shuffles_end(spark: SparkSession):
    """Writes inside leave no shuffle files: what they wrote is read instead, and files would stay until the driver's heap is collected."""
    return _set_for(spark, **{_SHUFFLES_END: "true"})


#: Spark's setting by which a task writes to so many files at once, in place of a sort by file.
_FILES_AT_ONCE = "spark.sql.maxConcurrentOutputFileWriters"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read again: computed once, and safe from lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    with _shuffles_end(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, name: str, key: str, buckets: int | None = None, dealt: bool = False) -> DataFrame:
    """As :func:`written`, in as many buckets of ``key`` as there are shuffle partitions, or as are told.

    Groups and joins on the key that read it, however many, need no exchange.
    ``dealt``: the frame is in these buckets already; it is neither exchanged nor sorted.
    The bucketed table has a name of its own in the session's catalog; its files
    lie in the shared folder.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex}"
    at = f"{shared_folder(spark)}/{table}"
    if dealt:
        # a task has one bucket
        with _set_for(spark, **{_SHUFFLES_END: "true", _FILES_AT_ONCE: "2"}):
            df.write.bucketBy(n, key).option("path", at).saveAsTable(table)
        return spark.table(table)
    with _shuffles_end(spark):
        df.repartition(n, key).sortWithinPartitions(key).write.bucketBy(n, key).sortBy(key).option("path", at).saveAsTable(table)
    return spark.table(table)


def write_parquet(df: DataFrame, path: str, compression: str = "snappy", mode: str = "errorifexists") -> DataFrame:
    """Write and return one row of metadata: row_count, column_count."""
    if compression not in CODECS:
        raise ValueError(f"compression must be one of {sorted(CODECS)}")
    df.write.mode(mode).option("compression", compression).parquet(path)
    back = df.sparkSession.read.parquet(path)
    return back.agg(F.count(F.lit(1)).alias("row_count")).withColumn("column_count", F.lit(len(df.columns)))


def publish_staged(df: DataFrame, path: str, key: str, compression: str = "snappy") -> DataFrame:
    """Write beside ``path``, check the staged copy, then rename it; an existing target is refused.

    Returns the published table.  A failed check leaves no target behind.
    """
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(conf)
    if fs.exists(target):
        raise FileExistsError(path)
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex}"
    try:
        df.write.option("compression", compression).parquet(staged)
        bad = spark.read.parquet(staged).groupBy(key).count().filter(F.col(key).isNull() | (F.col("count") > 1)).limit(1).count()
        if bad:
            raise ValueError(f"{key} is null or repeats")
        if not fs.rename(jvm.org.apache.hadoop.fs.Path(staged), target):
            raise OSError(f"could not rename to {path}")
    finally:
        fs.delete(jvm.org.apache.hadoop.fs.Path(staged), True)
    return spark.read.parquet(path)


def _manifests(spark: SparkSession, root: str) -> list[tuple[int, dict]]:
    """Number and content of every whole manifest, in order; what a killed writer left half written is passed over."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(f"{root}/manifests")
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(folder):
        return []
    out = []
    for status in fs.listStatus(folder):
        text = spark.read.text(str(status.getPath().toString()), wholetext=True).first()
        try:
            out.append((int(status.getPath().getName()), json.loads(text[0] if text else "")))
        except ValueError:
            continue
    return sorted(out, key=lambda x: x[0])


def _digests(df: DataFrame) -> dict[str, str]:
    return {k: str(v) for k, v in content_fingerprint(df).first().asDict().items()}


def publish_versioned(df: DataFrame, root: str, key: str, compression: str = "snappy") -> int:
    """Publish as the next version of the table at ``root``; returns its number.

    Files are written to a folder of their own and checked; then a manifest
    that names the folder, its files, row count and digests is created, only if
    no other has its number.  Readers go by manifests, so nothing is renamed,
    which object stores do not do at once: before the manifest stands readers
    see the version before, afterwards the new one.
    """
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    root = root.rstrip("/")
    data = f"{root}/versions/{uuid.uuid4().hex}"
    df.write.option("compression", compression).parquet(data)
    back = spark.read.parquet(data)
    if back.groupBy(key).count().filter(F.col(key).isNull() | (F.col("count") > 1)).limit(1).count():
        raise ValueError(f"{key} is null or repeats")
    folder = jvm.org.apache.hadoop.fs.Path(data)
    fs = folder.getFileSystem(conf)
    files = sorted((x.getPath().getName(), x.getLen()) for x in fs.listStatus(folder) if x.getPath().getName().endswith(".parquet"))
    number = max([n for n, _ in _manifests(spark, root)], default=0) + 1
    manifest = json.dumps({"data": data, "files": files, "rows": back.count(), "digests": _digests(back)})
    while True:
        target = jvm.org.apache.hadoop.fs.Path(f"{root}/manifests/{number:012d}")
        if not fs.exists(target):
            out = fs.create(target, False)  # refused if another writer came first
            out.write(bytearray(manifest.encode()))
            out.close()
            return number
        number += 1


def read_version(spark: SparkSession, root: str, number: int | None = None) -> DataFrame:
    """The newest version (or that of a number) whose manifest and files are whole; digests are checked."""
    jvm = spark.sparkContext._jvm
    found = [m for n, m in _manifests(spark, root.rstrip("/")) if number is None or n == number]
    if not found:
        raise FileNotFoundError(root)
    manifest = found[-1]
    folder = jvm.org.apache.hadoop.fs.Path(manifest["data"])
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    there = {x.getPath().getName(): x.getLen() for x in fs.listStatus(folder)}
    if any(there.get(name) != size for name, size in manifest["files"]):
        raise ValueError(f"files of {manifest['data']} are not as recorded")
    df = spark.read.parquet(*[f"{manifest['data']}/{name}" for name, _ in manifest["files"]])
    if _digests(df) != manifest["digests"]:
        raise ValueError(f"content of {manifest['data']} is not as recorded")
    return df


def read_verified(spark: SparkSession, path: str, expected: DataFrame) -> DataFrame:
    """The table at ``path`` if its content fingerprint is that of ``expected`` (one row)."""
    found = spark.read.parquet(path)
    if content_fingerprint(found).exceptAll(expected).limit(1).count():
        raise ValueError(f"content at {path} is not as recorded")
    return found
