"""Reading and writing of tables as JSON, CSV, text and binary files."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from kbspark.plans.lineage import shared_folder

#: How files of a kind begin, in hex.
SIGNATURES = {"pdf": ("255044462D",), "docx": ("504B0304", "504B0506"), "pptx": ("504B0304", "504B0506"), "xlsx": ("504B0304", "504B0506"), "png": ("89504E470D0A1A0A",), "jpg": ("FFD8FF",), "zip": ("504B0304", "504B0506")}
#: What stands for null in CSV, where an empty text is empty.
_NULL = "\\N"


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p))


def read_rows(spark: SparkSession, path: str, schema: StructType, kind: str = "parquet") -> DataFrame:
    """Rows of one file or folder: ``parquet``, ``json`` (an array or one object a line), ``jsonl`` or ``csv`` with a header.

    A path that isn't there has no rows; fields that aren't there are null; broken JSON
    records have nulls only.
    """
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    reader = spark.read.schema(schema)
    if kind == "csv":
        return reader.options(header=True, multiLine=True, escape='"', nullValue=_NULL, emptyValue="", enforceSchema=False).csv(path)
    if kind in ("json", "jsonl"):
        return reader.options(multiLine=kind == "json", mode="PERMISSIVE").json(path)
    return reader.format(kind).load(path)


def fixed_columns(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema`` in its order and types; missing ones null, others dropped."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema])


def write_rows(df: DataFrame, path: str, kind: str = "parquet", append: bool = False) -> None:
    """Write rows in one commit; ``append`` adds to what is there (logs), else the path must be new or is replaced."""
    writer = df.write.mode("append" if append else "overwrite")
    if kind == "csv":
        # arrays and structs have no form in CSV: they go as JSON
        flat = df.select(*[F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else F.col(c) for c, t in df.dtypes])
        flat.write.mode("append" if append else "overwrite").options(header=True, escape='"', nullValue=_NULL, emptyValue="", quoteAll=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    elif kind in ("json", "jsonl"):
        writer.options(ignoreNullFields=False).json(path)
    else:
        writer.format(kind).save(path)


def read_texts(spark: SparkSession, path: str) -> DataFrame:
    """(source_id, text) of a folder of text files named by id."""
    rows = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.col("_metadata.file_name"), r"^(.*?)(\.[^.]*)?$", 1).alias("source_id"), F.col("value").alias("text"))
    return rows


def read_binaries(spark: SparkSession, path: str) -> DataFrame:
    """(source_id, extension, bytes, signature, valid): files of a folder and whether they begin as their extension says.

    An extension without known signatures is valid; Spark lists no empty files.
    """
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    name = F.regexp_extract("path", r"([^/]+)$", 1)
    rows = rows.select(F.regexp_extract(name, r"^(.*?)(\.[^.]*)?$", 1).alias("source_id"), F.lower(F.regexp_extract(name, r"\.([^.]*)$", 1)).alias("extension"), F.col("length").alias("bytes"), F.hex(F.substring("content", 1, 16)).alias("signature"))
    fits = F.lit(None).cast("boolean")
    for extension, starts in SIGNATURES.items():
        ok = F.lit(False)
        for s in starts:
            ok = ok | F.startswith(F.col("signature"), F.lit(s))
        fits = F.when(F.col("extension") == extension, ok).otherwise(fits)
    return rows.withColumn("valid", (F.col("bytes") > 0) & F.coalesce(fits, F.lit(True)))


def decoded(content: F.Column) -> F.Column:
    """Text of UTF-8 bytes, null where a zero byte among the first thousand says that it is binary."""
    text = F.decode(content, "UTF-8")
    return F.when(F.position(F.lit("\x00"), F.substring(text, 1, 1000)) == 0, text)


def round_trip(df: DataFrame, kind: str) -> DataFrame:
    """``df`` written as ``kind`` to the shared folder and read again; text columns only in CSV."""
    path = f"{shared_folder(df.sparkSession)}/kbspark/trip-{uuid.uuid4().hex}"
    plain = df if kind != "csv" else df.select(*[F.col(f.name).cast(StringType()) for f in df.schema])
    write_rows(plain, path, kind)
    return fixed_columns(read_rows(df.sparkSession, path, plain.schema, kind), df.schema)
