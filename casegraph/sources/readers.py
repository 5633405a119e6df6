"""Table scans."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from casegraph.functions.scalars import integral_id, nan_to_null, parse_timestamp
from casegraph.sources.schemas import ENTITY_SCHEMA, SCHEMAS, DataLayout


def _typed(name: str, dtype: T.DataType, on_error: str) -> Column:
    raw = F.col(name)
    if isinstance(dtype, (T.LongType, T.IntegerType)):
        value = integral_id(raw).cast(dtype)
    elif isinstance(dtype, T.TimestampType):
        return parse_timestamp(raw, on_error).alias(name)
    elif isinstance(dtype, T.DoubleType):
        value = nan_to_null(raw.try_cast("double"))
    else:
        return raw.alias(name)
    if on_error == "raise":
        is_nan = F.lower(F.trim(raw)) == "nan"
        complaint = F.raise_error(F.concat(F.lit(f"bad value in {name}: "), raw))
        value = F.when(raw.isNotNull() & value.isNull() & ~is_nan, complaint).otherwise(value)
    return value.alias(name)


def _lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Every line of text files with its file, the start of its split, its order in that and its number of quotes."""
    text = spark.read.option("lineSep", "\n").text(path if isinstance(path, str) else list(path))
    return text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
        "value",
        (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).alias("quotes"),
    )


def _records(lines: DataFrame) -> DataFrame:
    """Lines put together to records, by the file and split in which a record starts.

    A record starts where the quotes before it in the file are even in number. The quotes of a split are summed where
    it is read; sums over the splits of a file are one row per split. Within a split only its own lines are ordered. The
    lines at the head of a split that belong to an earlier record are one fragment, joined to that record.
    """
    by_split = Window.partitionBy("file").orderBy("split")
    before = by_split.rowsBetween(Window.unboundedPreceding, -1)
    splits = lines.groupBy("file", "split").agg(F.sum("quotes").alias("quotes"))
    total = F.sum("quotes").over(Window.partitionBy("file"))
    unclosed = F.raise_error(F.concat(F.lit("a quoted cell is never closed in "), "file"))
    splits = splits.select(
        "file", "split", F.when(total % 2 == 1, unclosed.cast("long")).otherwise(F.coalesce(F.sum("quotes").over(before), F.lit(0))).alias("earlier")
    )
    in_split = Window.partitionBy("file", "split").orderBy("at")
    own = F.coalesce(F.sum("quotes").over(in_split.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    opens = F.when((F.col("earlier") + own) % 2 == 0, F.col("at"))
    placed = lines.join(splits, ["file", "split"]).withColumn("opens", opens)
    placed = placed.withColumn("record", F.last("opens", ignorenulls=True).over(in_split))
    in_order = F.array_sort(F.collect_list(F.struct("at", "value")))
    parts = placed.groupBy("file", "split", "record").agg(F.array_join(F.transform(in_order, lambda p: p["value"]), "\n").alias("text"))
    # the last record of each split, and of the splits before one without any start
    last = parts.groupBy("file", "split").agg(F.max("record").alias("record"), F.max(F.when(F.col("record").isNull(), F.col("text"))).alias("head"))
    owner = F.last(F.when(F.col("record").isNotNull(), F.struct("split", "record")), ignorenulls=True).over(before)
    heads = last.withColumn("owner", owner).where(F.col("head").isNotNull()).select("file", "split", "head", "owner.record", F.col("owner.split").alias("owner"))
    pieces = F.array_sort(F.collect_list(F.struct("split", "head")))
    tails = heads.groupBy("file", F.col("owner").alias("split"), "record").agg(
        F.array_join(F.transform(pieces, lambda p: p["head"]), "\n").alias("tail")
    )
    whole = parts.where(F.col("record").isNotNull()).join(tails, ["file", "split", "record"], "left")
    first = F.min("record").over(Window.partitionBy("file", "split"))
    text = F.regexp_replace(F.concat_ws("\n", "text", "tail"), r"\r$", "")
    return whole.select("file", "split", "record", ((F.col("split") == 0) & (F.col("record") == first)).alias("is_header"), text.alias("text"))


def scan_records(spark: SparkSession, path: str | Sequence[str], on_error: str = "raise") -> DataFrame:
    """All cells, as text, of CSV files whose quoted cells may hold line ends; large files are read in splits.

    * A quote stands only around a quoted cell or, doubled, in one. A file with an odd number of them is an error; other
      stray quotes show as records with another number of cells, which are errors, too (null cells with another ``on_error``).
    * Line ends are ``\\n`` or ``\\r\\n``, in cells as written; empty lines are no records; an empty cell, quoted or not, is null.
    * The columns are those of the first file's header; every file has one. The order of records is not kept.
    """
    one = path if isinstance(path, str) else list(path)
    names = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(one, inferSchema=False).columns
    if not names:
        return spark.createDataFrame([], T.StructType([]))
    broken = "_broken"
    while broken in names:
        broken += "_"
    quoted = {n: "`" + n.replace("`", "``") + "`" for n in [*names, broken]}
    options = {"escape": '"', "multiLine": "true", "mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken}
    records = _records(_lines(spark, one)).where(~F.col("is_header") & (F.col("text") != ""))
    schema = ", ".join(f"{n} string" for n in quoted.values())
    parsed = records.select("file", F.from_csv("text", schema, options).alias("cells"))
    cells = {n: F.col(f"cells.{quoted[n]}") for n in quoted}
    if on_error == "raise":
        complaint = F.raise_error(F.concat(F.lit("not as many cells as the header has, in "), "file", F.lit(": "), cells[broken]))
        return parsed.select(*(F.when(cells[broken].isNotNull(), complaint.cast("string")).otherwise(cells[n]).alias(n) for n in names))
    return parsed.select(*(cells[n].alias(n) for n in names))


def scan_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: T.StructType,
    null_tokens: Sequence[str] = (),
    on_error: str = "raise",
    multi_line: bool = False,
) -> DataFrame:
    """CSV with a header row, read by column name.

    Cells arrive as text and are converted here, because a typed CSV read turns an id
    written as ``1.0`` into null without a word. ``null_tokens`` are texts that mean a
    missing value besides the empty cell. Files with ``multi_line`` cells are read by
    ``scan_records``, in splits, too.
    """
    if multi_line:
        raw = scan_records(spark, path, on_error)
    else:
        header = spark.read.option("header", True).option("escape", '"')
        raw = header.csv(path if isinstance(path, str) else list(path), inferSchema=False)
    missing = [f.name for f in schema.fields if f.name not in raw.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {missing}")
    if null_tokens:
        tokens = list(null_tokens)
        raw = raw.select([F.when(~F.col(f.name).isin(tokens), F.col(f.name)).alias(f.name) for f in schema.fields])
    return raw.select([_typed(f.name, f.dataType, on_error) for f in schema.fields])


def scan_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Parquet scan; only ``columns`` reach the reader."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def scan_table(spark: SparkSession, layout: DataLayout, table: str, **options) -> DataFrame:
    """A clinical table of ``layout``, from CSV or from its Parquet twin by file name."""
    path = layout.path(table)
    if path.endswith(".parquet"):
        return scan_parquet(spark, path, SCHEMAS[table].names)
    return scan_csv(spark, path, SCHEMAS[table], multi_line=table == "notes", **options)


def scan_entities(spark: SparkSession, path: str) -> DataFrame:
    """Entity lists written by ``write_entities``."""
    return spark.read.schema(ENTITY_SCHEMA).json(path)
