"""Sources: CSV deliveries, pipe-delimited concept files, one-text-per-file folders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from notepairs import constants as C

NOTES = (
    "row_id long, subject_id long, hadm_id long, chartdate string, charttime string,"
    " category string, description string, text string"
)
ADMISSIONS = "subject_id long, hadm_id long"
PATIENTS = "subject_id long"
PAIRS = "pair_id string, document string, summary string"


def read_csv(
    spark: SparkSession, path: str, columns: str, *, header: bool = True, partitions: int | None = None
) -> DataFrame:
    """Columns of a quoted CSV or CSV.gz table picked by name, in any order and case.

    Quoted fields may hold newlines, so one file is one task; ``partitions`` spreads
    the rows again. Convert once to Parquet and read that afterwards.
    """
    raw = spark.read.csv(path, header=header, multiLine=True, quote='"', escape='"', inferSchema=False)
    wanted = spark.createDataFrame([], columns).schema
    by_name = {name.lower(): name for name in raw.columns}
    missing = [f.name for f in wanted if f.name not in by_name]
    if missing:
        raise ValueError(f"columns not found in {path}: {missing}")
    df = raw.select(*[F.col(f"`{by_name[f.name]}`").cast(f.dataType).alias(f.name) for f in wanted])
    return df.repartition(partitions) if partitions else df


def table_name(file: Column) -> Column:
    """Table a ``NAME.csv`` or ``NAME.csv.gz`` file holds; null for other files."""
    name = F.regexp_extract(file, r"\A(.*)\.csv(?:\.gz)?\z", 1)
    return F.when(name.isin(*C.EXPECTED_TABLES), name)


def missing_tables(files: DataFrame, *, by: str = "delivery", file: str = "file") -> DataFrame:
    """Expected tables each delivery lacks.

    At most one entry per expected table is kept per delivery, before the shuffle.
    """
    expected = F.array(*[F.lit(t) for t in C.EXPECTED_TABLES])
    found = files.select(by, table_name(F.col(file)).alias("table")).groupBy(by).agg(
        F.collect_set("table").alias("found")
    )
    return found.select(by, F.explode(F.array_except(expected, "found")).alias("missing"))


def folder_files(spark: SparkSession, folder: str) -> DataFrame:
    """File names of one delivery folder, empty files included; contents are not read.

    A delivery holds a few dozen tables, so its listing goes through the driver.
    """
    names = [(folder, path) for path in spark.read.format("binaryFile").load(folder).inputFiles()]
    files = spark.createDataFrame(names, "delivery string, path string")
    return files.select("delivery", F.url_decode(F.substring_index("path", "/", -1)).alias("file"))


def _is_folder(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def read_texts(spark: SparkSession, folder: str) -> DataFrame:
    """One text per file; the key is the file name up to its first dot.

    A scan skips empty files, and an empty text is a result too. A folder that
    ``export_texts`` wrote has a table of its keys with the sizes of their texts, which
    names the empty ones; each file is opened once. A folder from elsewhere has no such
    table: there the names of its empty files come from the listing that the scan holds.
    """
    key = lambda name: F.split(name, r"\.").getItem(0)
    if _is_folder(spark, f"{folder}/keys"):
        scan = spark.read.text(f"{folder}/texts", wholetext=True, recursiveFileLookup=True)
        empty = spark.read.parquet(f"{folder}/keys").where("bytes = 0").select(key(F.col("key")).alias("pair_id"), F.lit("").alias("text"))
        return scan.select(key(F.col("_metadata.file_name")).alias("pair_id"), F.col("value").alias("text")).unionByName(empty)
    scan = spark.read.text(folder, wholetext=True)
    texts = scan.select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))
    listed = spark.createDataFrame([(f,) for f in scan.inputFiles()], "path string").select(
        F.url_decode(F.substring_index("path", "/", -1)).alias("file")
    )
    empty = listed.join(texts.select("file"), "file", "left_anti").select("file", F.lit("").alias("text"))
    return texts.unionByName(empty).select(key(F.col("file")).alias("pair_id"), "text")


def read_concept_names(spark: SparkSession, path: str) -> DataFrame:
    """Concept id, source, code and name of a pipe-delimited MRCONSO file."""
    raw = spark.read.csv(path, sep="|", quote="")
    return raw.select(
        F.col("_c0").alias("cui"), F.col("_c11").alias("source"), F.col("_c13").alias("code"),
        F.col("_c14").alias("name"),
    )


def read_concept_types(spark: SparkSession, path: str) -> DataFrame:
    """Concept id and semantic type of a pipe-delimited MRSTY file."""
    raw = spark.read.csv(path, sep="|", quote="")
    return raw.select(F.col("_c0").alias("cui"), F.col("_c1").alias("type_id"))
