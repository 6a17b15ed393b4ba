"""Readers. Production reads take a declared schema; nothing is inferred from data."""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import quote, urlsplit

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.functions.dates import year_in_name
from newsflow.schema import PRICE_DOC, PRICES
from newsflow.session import written


def read_parquet(spark: SparkSession, *paths: str, schema: T.StructType | None = None,
                 allow_empty: bool = False) -> DataFrame:
    """One table out of paths or globs; raises when they hold no row."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(*paths)
    if not allow_empty and df.isEmpty():
        raise FileNotFoundError(f"no rows in {', '.join(paths)}")
    return df


def read_increment(spark: SparkSession, path: str, day: str, schema: T.StructType,
                   prefix: str = "nyt_articles_") -> DataFrame:
    """The files of one day, `day` as yyyy_MM_dd, picked by the start of their name."""
    return (spark.read.schema(schema).option("recursiveFileLookup", True)
            .option("pathGlobFilter", f"{prefix}{day}*").parquet(path))


def read_history(spark: SparkSession, path: str, schema: T.StructType, years: Iterable[int],
                 tail_year: int, tail_months: Iterable[str]) -> DataFrame:
    """Whole year folders, plus what is named after `tail_months` in the folder `tail_year`.

    Folders may be named `2020` or `year=2020`, below `path`; years in `path` itself do not count. The
    predicate reads paths only, so other files are dropped before the scan.
    """
    root = quote(urlsplit(path).path.rstrip("/") if "://" in path or path.startswith("file:") else
                 path.rstrip("/"), safe="/=:@+,")
    whole = "|".join(map(str, years))
    part = "|".join(tail_months)
    below = F.substring_index(F.col("_metadata.file_path"), f"{root}/", -1)
    wanted = below.rlike(f"(?:^|/)(?:year=)?({whole})/") | below.rlike(
        f"(?:^|/)(?:year=)?{tail_year}/.*({part})")
    return (spark.read.schema(schema).option("recursiveFileLookup", True).parquet(path)
            .filter(wanted))


def read_years(spark: SparkSession, path: str, years: Iterable[int], schema: T.StructType,
               pattern: str = "*.parquet", folder: str = "") -> DataFrame:
    """One table out of one folder per year; missing years are left out, and so are unreadable files,
    which `unread_files` names.

    `folder` comes before the year in folder names, as in `year=2020`.
    """
    return (spark.read.schema(schema).option("ignoreMissingFiles", True)
            .option("ignoreCorruptFiles", True).parquet(_year_glob(path, years, pattern, folder)))


def _year_glob(path: str, years: Iterable[int], pattern: str, folder: str) -> str:
    return f"{path}/{{{','.join(f'{folder}{year}' for year in years)}}}/{pattern}"


def unread_files(spark: SparkSession, path: str, years: Iterable[int], schema: T.StructType,
                 pattern: str = "*.parquet", folder: str = "") -> DataFrame:
    """The files (`path`, `length`) that `read_years` gives no row of: unreadable or empty ones.

    The files are listed without their content, and only row positions of the table are read.
    """
    listed = (spark.read.format("binaryFile").load(_year_glob(path, years, pattern, folder))
              .select("path", "length"))
    seen = read_years(spark, path, years, schema, pattern, folder).select(
        F.col("_metadata.file_path").alias("path")).distinct()
    bare = lambda c: F.regexp_replace(c, "^file:/+", "/")
    return (listed.withColumn("path", bare("path"))
            .join(seen.withColumn("path", bare("path")), "path", "left_anti"))


def with_file_year(df: DataFrame, column: str | None = None) -> DataFrame:
    """Add the year in the file name (or in `column`); rows of files without one are dropped."""
    name = F.col(column) if column else F.col("_metadata.file_name")
    return df.withColumn("year", year_in_name(name)).filter("year IS NOT NULL")


def _with_breaks(col: Column) -> Column:
    """The escapes of `write_csv(flat=True)` as what they stand for."""
    parts = F.transform(F.split(col, r"\\\\"), lambda x: F.replace(
        F.replace(x, F.lit("\\n"), F.lit("\n")), F.lit("\\r"), F.lit("\r")))
    return F.array_join(parts, "\\")


def read_csv(spark: SparkSession, path: str, schema: T.StructType,
             bad_row: str | None = None, flat: bool = False) -> DataFrame:
    """CSV with a header; quotes inside values are doubled and values may hold line breaks.

    `flat` is for files of `write_csv(flat=True)`, or any without line breaks in values: a file is then cut into parts
    that tasks read on their own.

    A missing value is null and a quoted empty one is empty: the reader puts `nullValue` in the
    place of a missing value, so any text that occurs nowhere tells the two apart. A value that does
    not fit its type is null, and the raw row is then in the column `bad_row`, if one is named.
    """
    reader = (spark.read.option("header", True).option("multiLine", not flat).option("escape", '"')
              .option("nullValue", "\x00").option("mode", "PERMISSIVE"))
    if bad_row:
        schema = T.StructType([*schema.fields, T.StructField(bad_row, T.StringType())])
        reader = reader.option("columnNameOfCorruptRecord", bad_row)
    rows = reader.schema(schema).csv(path)
    if not flat:
        return rows
    texts = [f.name for f in schema if f.dataType.typeName() == "string" and f.name != bad_row]
    return rows.withColumns({name: _with_breaks(F.col(name)) for name in texts})


def load_csv(spark: SparkSession, path: str, schema: T.StructType, quarantine: str, flat: bool = False) -> DataFrame:
    """The rows of a CSV that fit `schema`; the raw text of all others replaces the folder `quarantine`.

    The parsed rows are written once: whether a row fits would else depend on the columns a query reads.
    """
    rows = written(read_csv(spark, path, schema, "bad_row", flat), "parsed")
    rows.filter("bad_row IS NOT NULL").select("bad_row").write.mode("overwrite").text(quarantine)
    return rows.filter("bad_row IS NULL").drop("bad_row")


def read_json(spark: SparkSession, path: str, schema: T.StructType,
              multi_line: bool = True) -> DataFrame:
    """JSON objects: one array or object per file, or with `multi_line=False` one per line.

    Columns the file lacks come out null.
    """
    return spark.read.schema(schema).option("multiLine", multi_line).json(path)


def read_price_json(spark: SparkSession, path: str) -> DataFrame:
    """Daily prices out of column-oriented JSON, `{column: {index: value}}`, one file per symbol.

    Column names may look like `('Close', 'AAPL')`. The symbol is the folder `symbol=...`, or the
    start of the file name up to its first underscore. A file holds the days of one symbol.
    """
    source = F.col("_metadata.file_path")
    symbol = F.coalesce(
        F.nullif(F.regexp_extract(source, r"/symbol=([^/]+)/", 1), F.lit("")),
        F.nullif(F.regexp_extract(source, r"/([^/_]+)_[^/]*$", 1), F.lit("")))
    docs = (spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(path)
            .select(symbol.alias("symbol"), F.from_json("value", PRICE_DOC).alias("doc")))
    columns = docs.select("symbol", F.explode("doc").alias("name", "values"))
    clean = F.coalesce(F.nullif(F.regexp_extract("name", r"^\('([^']*)'", 1), F.lit("")), F.col("name"))
    cells = columns.select("symbol", F.lower(clean).alias("name"),
                           F.explode("values").alias("idx", "value"))
    wide = (cells.groupBy("symbol", "idx")
            .pivot("name", ["date", "open", "high", "low", "close", "volume"])
            .agg(F.first("value")))
    millis = F.timestamp_millis(F.col("date").try_cast("bigint"))
    day = F.when(F.col("date").rlike("^-?[0-9]+$"), F.to_date(millis)).otherwise(
        F.col("date").try_cast("date"))
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in PRICES.fields[2:]]
    return wide.select("symbol", day.alias("date"), *typed)
