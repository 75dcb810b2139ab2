"""Where packets and intermediate states come from. Schemas are always given, never inferred."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

STATES = T.StructType(
    [
        T.StructField("case_id", T.StringType()),
        T.StructField("stem", T.StringType()),
        T.StructField("shard", T.IntegerType()),
        T.StructField("gen", T.IntegerType()),
        T.StructField("line", T.LongType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("attempts", T.ArrayType(T.StructType([T.StructField(x, t) for x, t in (("attempt", T.IntegerType()), ("status", T.StringType()), ("failure_category", T.StringType()), ("error", T.StringType()))]))),
        T.StructField("_corrupt_record", T.StringType()),
    ]
)
PREDICTIONS = T.StructType([T.StructField(x, T.StringType()) for x in ("case_id", "applicant_name", "species_code", "home_world", "visa_class", "sponsor_id", "arrival_date", "declared_purpose", "risk_flags", "fee_status", "adjudication")] + [T.StructField("confidence", T.DoubleType())])
TRUTH = T.StructType(PREDICTIONS.fields[:-1])


def packets(spark: SparkSession, folder: str, pattern: str = "*.pdf") -> DataFrame:
    """path, stem, length, modificationTime, content, sha256 of the packets in a folder; order by length and path for
    the cheapest first."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(folder)
    return rows.withColumn("stem", F.regexp_extract("path", r"([^/]+)\.[^./]+$", 1)).withColumn("sha256", F.sha2("content", 256))


def states(spark: SparkSession, path: str) -> DataFrame:
    """Worker states from append-only JSON lines of several generations: torn lines are dropped, and the first complete
    row of each stem wins."""
    rows = spark.read.schema(STATES).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(path)
    good = rows.where("_corrupt_record is null and stem is not null").drop("_corrupt_record")
    first = F.row_number().over(Window.partitionBy("stem").orderBy("shard", "gen", "line"))
    return good.withColumn("_n", first).where("_n = 1").drop("_n")


def strict_rows(spark: SparkSession, path: str, schema: T.StructType, key: str = "case_id") -> DataFrame:
    """JSON lines that must be whole: a bad line, a missing or repeated key or an empty file is an error when read."""
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    if not rows.limit(1).count():
        raise ValueError(f"{path} has no rows")
    n = F.count(F.lit(1)).over(Window.partitionBy(key))
    fault = F.when(F.col(key).isNull(), F.raise_error(F.lit(f"a row without {key}"))).when(F.col("_n") > 1, F.raise_error(F.concat(F.lit(f"{key} repeats: "), F.col(key))))
    return rows.withColumn("_n", n).withColumn("_ok", F.coalesce(fault.cast("string"), F.lit(""))).where("_ok = ''").drop("_n", "_ok")


def table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV dimension with a header."""
    return spark.read.schema(schema).option("header", "true").option("mode", "FAILFAST").csv(path)


def artefact(spark: SparkSession, path: str, schema: T.StructType, default: list[tuple]) -> DataFrame:
    """A small JSON model table, or its documented default where the file doesn't exist."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)
    return spark.read.schema(schema).json(path) if there else spark.createDataFrame(default, schema)
