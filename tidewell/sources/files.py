"""File readers and writers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: the key is what lies between the first underscore and the last dot of a file name.
FILE_KEY = r"_(.*)\."


def keyed_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    key: str,
    pattern: str = FILE_KEY,
    part: str = "file_name",
) -> DataFrame:
    """All CSV files below ``path`` with a column taken from the file's name (or ``file_path``)."""
    df = spark.read.schema(schema).option("header", True).option("recursiveFileLookup", True).csv(path)
    return df.withColumn(key, F.regexp_extract(F.col(f"_metadata.{part}"), pattern, 1))


def csv_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


def json_dictionary(spark: SparkSession, path: str, key: str = "key", value: str = "value") -> DataFrame:
    """Flat JSON objects, one per file, to key/value rows."""
    text = spark.read.text(path, wholetext=True)
    entries = F.from_json("value", T.MapType(T.StringType(), T.StringType()))
    return text.select(F.explode(entries).alias(key, value))


def json_records(spark: SparkSession, path: str, fields: Sequence[str], array_file: bool = False) -> DataFrame:
    """Records whose fields are all text until cast.  ``array_file``: each file is one JSON list."""
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    return spark.read.schema(schema).option("multiLine", array_file).json(path)


def pushed_rows(df: DataFrame, condition: Column, order: Sequence[str], limit: int) -> DataFrame:
    """Filter at the source, then at most ``limit`` rows in a fixed order."""
    return df.where(condition).orderBy(*order).limit(limit)


_POINT = T.ArrayType(T.DoubleType())
_FEATURE = T.StructType(
    [
        T.StructField("properties", T.StructType([T.StructField("name", T.StringType())])),
        T.StructField(
            "geometry",
            # the nesting of the coordinates depends on the type, so they are read as text first
            T.StructType([T.StructField("type", T.StringType()), T.StructField("coordinates", T.StringType())]),
        ),
    ]
)


def geojson_polygons(spark: SparkSession, path: str, one_feature_per_line: bool = False) -> DataFrame:
    """(name, geometry): rings of points; the rings of all parts of a multi-polygon in one list.

    Any other geometry type is an error.

    A feature collection is one document per file; large collections should be
    written one feature per line so that they can be split.
    """
    if one_feature_per_line:
        f = spark.read.schema(_FEATURE).json(path)
    else:
        whole = T.StructType([T.StructField("features", T.ArrayType(_FEATURE))])
        f = spark.read.schema(whole).option("multiLine", True).json(path).select(F.inline("features"))
    ring = lambda r: F.transform(r, lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    kind, text = F.col("geometry.type"), F.col("geometry.coordinates")
    rings = (
        F.when(kind == "Polygon", F.from_json(text, T.ArrayType(T.ArrayType(_POINT))))
        .when(kind == "MultiPolygon", F.flatten(F.from_json(text, T.ArrayType(T.ArrayType(T.ArrayType(_POINT))))))
        .when(kind.isNotNull(), F.raise_error(F.concat(F.lit("geometry type "), kind)).cast(T.ArrayType(T.ArrayType(_POINT))))
    )
    return f.select(F.col("properties.name").alias("name"), F.transform(rings, ring).alias("geometry"))


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path)


# How the marker lines of a book begin.
MARKER_LINES = ["*** START OF", "*** END OF"]


def book_lines(spark: SparkSession, path: str) -> DataFrame:
    """``line``: one row per line of the files, trimmed, without marker lines."""
    lines = text_lines(spark, path)
    for marker in MARKER_LINES:
        lines = lines.where(~F.startswith("value", F.lit(marker)))
    return lines.select(F.regexp_replace("value", r"^[\s]+|[\s]+$", "").alias("line"))


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """One row per file."""
    df = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    return df.select(F.col("value").alias("text"), F.col("_metadata.file_path").alias("path"))


def row_range(df: DataFrame, order: Sequence[str], start: int, stop: int) -> DataFrame:
    """Rows ``[start, stop)`` in the order of columns of any type, nulls first."""
    from tidewell.operators.ordered import ranked

    p = ranked(df, order, name="_pos")
    return p.where((F.col("_pos") >= start) & (F.col("_pos") < stop)).drop("_pos")


def write_bounded(df: DataFrame, path: str, rows_per_file: int) -> None:
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)


def labelled_corpus(df: DataFrame, subset: str, categories: Sequence[str]) -> DataFrame:
    return df.where((F.col("split") == subset) & F.col("label").isin(*categories))
