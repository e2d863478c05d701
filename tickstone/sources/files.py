"""Reading the stored layers: bronze files, typed tables, manifests, inventory."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import instant


# Responses are gzip files.  Manifests lie beside them, either by that name or
# as the text files ``write_manifests`` leaves.
BRONZE_FILES = "*.gz"
MANIFEST_FILES = "{manifest*.json,part-*.txt}"
# Up to so many datasets are read each by itself.
MOST_DATASETS = 50


def _or_none(make):
    """The frame ``make`` builds, or None where its path does not exist.

    Only a missing path counts as absent; any other failure is raised.
    """
    try:
        return make()
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _datasets(spark: SparkSession, root: str) -> list[str]:
    """The ``<source>/<dataset>`` folders below ``root``; none where there are many, or
    where what lies there is not folders alone or has a name that a listing skips or a
    path reads otherwise."""
    top = spark._jvm.org.apache.hadoop.fs.Path(root)
    store = top.getFileSystem(spark._jsc.hadoopConfiguration())
    if not store.exists(top):
        return []
    found = [top]
    for _ in range(2):
        inner = [x for folder in found for x in store.listStatus(folder)]
        found = [x.getPath() for x in inner]
        if len(found) > MOST_DATASETS or not all(x.isDirectory() for x in inner):
            return []
        if any(x.getName()[0] in "._" or set(x.getName()) & set("*?[]{}\\") for x in found):
            return []
    return [x.toString() for x in found]


def _files(
    spark: SparkSession, root: str, date: str | None, name: str, schema: T.StructType,
    folder: str | None = None,
):
    """JSON files anywhere below ``<root>/<source>/<dataset>/date=…``.

    With a day only that day's folders are listed, with a ``folder`` only those below it.
    """
    path = root.rstrip("/")
    if date or folder:
        path = f"{path}/{folder or '*/*'}" + (f"/date={date}" if date else "")
    reader = (
        spark.read.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", name)
        .option("columnNameOfCorruptRecord", "_corrupt_record")
    )
    return _or_none(lambda: reader.json(path))


def bronze_files(spark: SparkSession, root: str, date: str | None = None) -> DataFrame:
    """Landed responses as they lie in their files."""
    df = _files(spark, root, date, BRONZE_FILES, S.BRONZE)
    return spark.createDataFrame([], S.BRONZE) if df is None else df


def read_bronze(
    spark: SparkSession, root: str, date: str | None = None, source: str | None = None
) -> DataFrame:
    """Every landed response, with ``ingest_ts`` parsed and its ``input_file``.

    Folders may or may not have a ``symbol=`` or ``coin=`` level.  Lines that
    are not valid JSON keep their text in ``_corrupt_record``.  Of a source with a folder
    of its own (``schemas.SOURCE_FOLDERS``) only that one's files are listed and read.
    """
    folder = S.SOURCE_FOLDERS.get(source)
    # Files are dealt to tasks by their bytes, and a byte of one dataset holds many times the
    # rows that one of another does; so each dataset's are dealt by themselves.
    roots = _datasets(spark, root) if date is None and folder is None else []
    read = [_files(spark, at, date, BRONZE_FILES, S.BRONZE, folder) for at in roots or [root]]
    read = [df.withColumn("input_file", F.col("_metadata.file_path")) for df in read if df is not None]
    if read:
        df = reduce(DataFrame.unionAll, read)
    else:
        df = spark.createDataFrame([], S.BRONZE).withColumn("input_file", F.lit(""))
    df = df.withColumn("ingest_ts", instant(F.col("ingest_ts")))
    return df if source is None else df.filter(F.col("source") == source)


def read_table(spark: SparkSession, path: str, schema: T.StructType, date: str | None = None):
    """A stored table, or None if there is none.  A day prunes partitions."""
    df = _or_none(lambda: spark.read.schema(schema).parquet(path))
    if df is not None and date is not None:
        df = df.filter(F.col("date") == date)
    return df


def read_table_or_empty(spark, path, schema, date=None) -> DataFrame:
    """A stored table, or an empty frame of its schema."""
    df = read_table(spark, path, schema, date)
    return spark.createDataFrame([], schema) if df is None else df


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    """Stored predictions, one row per series; empty when there are none."""
    df = _or_none(lambda: spark.read.schema(S.PREDICTIONS).json(path))
    return spark.createDataFrame([], S.PREDICTIONS) if df is None else df


def read_predictions_document(spark: SparkSession, path: str) -> DataFrame:
    """Predictions kept as one ``{generated_at, predictions: […]}`` document."""
    reader = spark.read.schema(S.PREDICTIONS_DOCUMENT).option("multiLine", "true")
    df = _or_none(lambda: reader.json(path))
    if df is None:
        df = spark.createDataFrame([], S.PREDICTIONS_DOCUMENT)
    return df.select("generated_at", F.inline("predictions"))


def read_ledger(spark: SparkSession, root: str, date: str | None = None) -> DataFrame:
    """Manifests of successful runs."""
    df = _files(spark, root, date, MANIFEST_FILES, S.MANIFEST)
    if df is None:
        df = spark.createDataFrame([], S.MANIFEST)
    return df.filter(F.col("status") == "success")


def storage_inventory(df: DataFrame) -> DataFrame:
    """Files, bytes and rows per folder of a frame read from files."""
    file = F.col("_metadata.file_path").alias("_file")
    size = F.col("_metadata.file_size").alias("_size")
    per_file = df.select(file, size).groupBy("_file", "_size").agg(
        F.count(F.lit(1)).alias("_rows")
    )
    folder = F.regexp_replace("_file", "/[^/]*$", "").alias("folder")
    return per_file.groupBy(folder).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("_size").alias("bytes"),
        F.sum("_rows").alias("rows"),
    )


def file_inventory(spark: SparkSession, root: str, name: str = "*") -> DataFrame:
    """Files and bytes per folder below ``root``, from the listing alone.

    No file is opened, so files without rows count too.  Files of no bytes are not
    listed, nor are folders without files.  Empty when ``root`` does not exist.
    """
    reader = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        .option("pathGlobFilter", name)
    )
    df = _or_none(lambda: reader.load(root))
    if df is None:
        df = spark.createDataFrame([], "path string, length bigint, modificationTime timestamp")
    return df.groupBy(F.regexp_replace("path", "/[^/]*$", "").alias("folder")).agg(
        F.count(F.lit(1)).alias("files"),
        F.sum("length").alias("bytes"),
        F.max("modificationTime").alias("modified"),
    )
