"""The data lake: four zones below one root, on any file system Spark can address."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loglake import fixed_values as fv
from loglake.functions.columns import human_size


def zone_path(root: str, zone: str, name: str = "") -> str:
    if zone not in fv.ZONES:
        raise ValueError(f"invalid zone {zone!r}: use one of {fv.ZONES}")
    return "/".join(p for p in (root.rstrip("/"), zone, name) if p)


def store_table(
    df: DataFrame, root: str, zone: str, name: str, fmt: str = "parquet", partition_by: tuple[str, ...] = ()
) -> str:
    """Write a table into a zone; the raw line is not kept. Returns the path.

    With ``partition_by`` only the partitions that ``df`` holds are replaced, others stay.
    """
    path = zone_path(root, zone, name)
    writer = df.drop("_raw").write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.save(path)
    return path


def store_batch(
    df: DataFrame, root: str, zone: str, name: str, run: str, by: str = "run_date", partition_by: tuple[str, ...] = ()
) -> str:
    """Write the batch of one run below ``<by>=<run>``. A repeated run replaces its own
    batch as a whole; the batches of all other runs stay. Returns the table's path.

    With ``partition_by`` rows are dealt out by partition first, large ones to several tasks:
    otherwise every task would write a file into each partition."""
    path = zone_path(root, zone, name)
    rows = df.drop("_raw", by)
    if partition_by:
        rows = rows.hint("rebalance", *partition_by)
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/{by}={run}")
    return path


def partition_values(spark: SparkSession, path: str, by: str) -> list[str]:
    """Values of the first partition column, from one listing of a table's folder; none if it
    does not exist. Whole numbers are in numeric order, anything else in that of text."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    listed = files.listStatus(folder) if files.exists(folder) else []
    names = [entry.getPath().getName() for entry in listed if entry.isDirectory()]
    values = [n.removeprefix(f"{by}=") for n in names if n.startswith(f"{by}=")]
    numbers = all(v.removeprefix("-").isdecimal() for v in values)
    return sorted(values, key=int) if numbers else sorted(values)


def read_latest(spark: SparkSession, root: str, zone: str, name: str, by: str = "run_date") -> DataFrame:
    """The newest batch of a table partitioned by ``by``; files of older ones are not opened."""
    path = zone_path(root, zone, name)
    runs = partition_values(spark, path, by)
    if not runs:
        raise FileNotFoundError(f"no batch below {path}")
    return spark.read.option("basePath", path).parquet(f"{path}/{by}={runs[-1]}")


def retrieve(spark: SparkSession, root: str, zone: str, name: str) -> DataFrame:
    """Whole content of the files of a document, one row per file."""
    files = spark.read.text(zone_path(root, zone, name), wholetext=True)
    return files.select(F.col("_metadata.file_name").alias("name"), F.col("value").alias("content"))


def retrieve_json(spark: SparkSession, root: str, zone: str, name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(zone_path(root, zone, name))


def _listing(spark: SparkSession, root: str, zone: str, pattern: str = "*") -> DataFrame:
    """Path, size and time of a zone's files; content is not read unless it is selected."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern)
    path = zone_path(root, zone)
    return reader.load(path).withColumn("zone", F.lit(zone)).withColumn("name", _name(path))


def _name(path: str) -> Column:
    """File path relative to its zone."""
    marker = "/" + "/".join(path.rstrip("/").split("/")[-2:]) + "/"
    return F.substring_index(F.col("path"), marker, -1)


#: Files up to so many bytes are hashed whole; Spark hands a task no file of 2 GB and more.
LARGEST_HASHED = 1 << 30


def file_manifest(spark: SparkSession, root: str, zone: str, largest: int = LARGEST_HASHED) -> DataFrame:
    """Size, readable size, MD5 and time of every file in a zone, its folders included.

    Files of more than ``largest`` bytes have no MD5; their content is not read.
    """
    files = _listing(spark, root, zone)
    known = ["zone", "name", "path", F.col("length").alias("size_bytes"), human_size(F.col("length")).alias("size_human")]
    time = F.col("modificationTime").alias("modified_at")
    hashed = files.where(F.col("length") <= largest).select(*known, F.md5("content").alias("md5"), time)
    large = files.where(F.col("length") > largest).select(*known, F.lit(None).cast("string").alias("md5"), time)
    return hashed.unionAll(large)


def list_files(spark: SparkSession, root: str, zone: str, pattern: str = "*") -> DataFrame:
    return _listing(spark, root, zone, pattern).select("name").orderBy("name")


def store_recorded(df: DataFrame, root: str, zone: str, name: str, version: int, fmt: str = "parquet") -> str:
    """Stores a document (a name without slashes) and records its files: sizes, MD5 and ``version``.

    Records are appended to the catalog and never changed; the greatest version of a name counts.
    """
    path = store_table(df, root, zone, name, fmt)
    files = file_manifest(df.sparkSession, root, zone).where(_document() == name)
    files.withColumn("version", F.lit(version).cast("bigint")).write.mode("append").parquet(f"{root.rstrip('/')}/catalog")
    return path


def _document() -> Column:
    """The stored name that a file belongs to: the first folder of its path in the zone."""
    return F.substring_index("name", "/", 1)


def recorded_files(spark: SparkSession, root: str) -> DataFrame:
    """The catalog's newest records: ``document`` and the columns of ``file_manifest``."""
    rows = spark.read.parquet(f"{root.rstrip('/')}/catalog").withColumn("document", _document())
    newest = rows.groupBy("zone", "document").agg(F.max("version").alias("version"))
    return rows.join(newest, ["zone", "document", "version"], "left_semi")


def file_metadata(spark: SparkSession, root: str, zone: str, names: Sequence[str]) -> DataFrame:
    """One row per name: ``status``, files, size and, for a single file, its MD5.

    What was recorded when a document was stored is ``recorded``; a document without records is
    ``listed`` by its files; any other name is ``missing``.
    """
    totals = [F.count("*").alias("files"), F.sum("size_bytes").alias("size_bytes")]
    recorded = recorded_files(spark, root).where(F.col("zone") == zone).withColumnRenamed("name", "file")
    one = F.when(F.count("*") == 1, F.max("md5")).alias("md5")
    recorded = recorded.groupBy(F.col("document").alias("name")).agg(*totals, one)
    files = _listing(spark, root, zone).select(_document().alias("name"), F.col("length").alias("size_bytes"))
    listed = files.groupBy("name").agg(*totals)
    wanted = spark.createDataFrame([(n,) for n in names], "name string")
    found = wanted.alias("w").join(recorded.alias("r"), "name", "left").join(listed.alias("l"), "name", "left")
    status = F.when(F.col("r.files").isNotNull(), "recorded").when(F.col("l.files").isNotNull(), "listed").otherwise("missing")
    size = F.coalesce(F.col("r.size_bytes"), F.col("l.size_bytes"))
    return found.select(
        "name", status.alias("status"), F.coalesce(F.col("r.files"), F.col("l.files")).alias("files"),
        size.alias("size_bytes"), F.when(size.isNotNull(), human_size(size)).alias("size_human"), F.col("r.md5").alias("md5"),
    )


def zone_stats(files: DataFrame, zones: Sequence[str] = fv.ZONES) -> DataFrame:
    """Files and bytes per zone of ``files(zone, name, size_bytes)``; zones without files have 0."""
    total = F.sum("size_bytes")
    held = files.groupBy("zone").agg(F.count("*").alias("file_count"), total.alias("total_size_bytes"))
    every = files.sparkSession.createDataFrame([(z,) for z in zones], "zone string")
    count, size = (F.coalesce(c, F.lit(0)) for c in ("file_count", "total_size_bytes"))
    return every.join(held, "zone", "left").select(
        "zone", count.alias("file_count"), size.alias("total_size_bytes"), human_size(size).alias("total_size_human")
    )


def _has_files(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def lake_files(spark: SparkSession, root: str, zones: tuple[str, ...] = fv.ZONES) -> DataFrame:
    """Names and sizes of all zones' files; a zone that does not exist yet has none."""
    files = spark.createDataFrame([], "zone string, name string, size_bytes bigint")
    for z in zones:
        if _has_files(spark, zone_path(root, z)):
            files = files.unionByName(_listing(spark, root, z).select("zone", "name", F.col("length").alias("size_bytes")))
    return files
