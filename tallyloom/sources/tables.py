"""Reading and writing: fact and lookup tables, feature layers, dossiers as JSON."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.sources import schemas


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def write_layers(layers: DataFrame, folder: str) -> None:
    """Layers (surname, year, features ...) by the names' first letters and year: few folders, and scans are pruned.

    Rows are clustered by folder first, so each folder gets few files; within a file they are sorted by name.
    """
    placed = layers.withColumn("prefix", F.substring("surname", 1, 2))
    placed.repartition("prefix", "year").sortWithinPartitions("prefix", "year", "surname").write.partitionBy("prefix", "year").json(folder)


#: Where a line that is no layer is kept.
BROKEN = "_broken"


def _layers(spark: SparkSession, folder: str) -> DataFrame:
    kind = f"surname string, {schemas.FEATURES}, prefix string, year int, {BROKEN} string"
    return spark.read.schema(kind).option("columnNameOfCorruptRecord", BROKEN).json(folder)


def read_layers(spark: SparkSession, folder: str, surname: str | None = None, years: list[int] | None = None) -> DataFrame:
    """Layers back, with the folders of one name or of some years only. Lines that are no layer are left out."""
    layers = _layers(spark, folder).filter(F.col(BROKEN).isNull()).drop(BROKEN)
    if surname is not None:
        layers = layers.filter((F.col("prefix") == surname[:2]) & (F.col("surname") == surname))
    return layers if years is None else layers.filter(F.col("year").isin(years))


#: Rows of wanted layers that are broadcast, at most.
WANTED_ROWS = 500_000


def read_wanted_layers(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """The layers of the wanted rows (surname, year) and other columns of these.

    While the wanted rows are few enough to be broadcast, which is counted, the folders of other names' letters and
    years aren't read: Spark prunes them by the rows as they come out. Layers that aren't there leave no row, nor do
    lines that are no layer; a wanted row given twice comes out twice.
    """
    asked = wanted.withColumn("prefix", F.substring("surname", 1, 2))
    small = wanted.limit(WANTED_ROWS + 1).count() <= WANTED_ROWS
    return read_layers(spark, folder).join(F.broadcast(asked) if small else asked, ["prefix", "year", "surname"])


def broken_layers(spark: SparkSession, folder: str) -> DataFrame:
    """(prefix, year, line) of the lines that are no layer."""
    lines = spark.read.schema("value string, prefix string, year int").text(folder)
    kind = f"surname string, {schemas.FEATURES}, {BROKEN} string"
    read = lines.withColumn("read", F.from_json("value", kind, {"columnNameOfCorruptRecord": BROKEN}))
    return read.filter(F.col("read")[BROKEN].isNotNull()).select("prefix", "year", F.col("value").alias("line"))


def read_mask(spark: SparkSession, path: str) -> DataFrame:
    """The features of a collection that is a file of its own, a row each: (feature)."""
    return spark.read.schema(schemas.FEATURES).option("multiLine", True).json(path).select(F.explode("features").alias("feature"))


def write_documents(dossiers: DataFrame, folder: str, compression: str = "gzip") -> None:
    """One JSON document a line, compressed."""
    dossiers.select(F.col("document").alias("value")).write.option("compression", compression).text(folder)
