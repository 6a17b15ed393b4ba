"""Writers. Files are sized by row count and by adaptive rebalancing, never by one task."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.operators.filters import drop_sentinel_dates, split_undated
from newsflow.schema import NEWS_COLUMNS, NEWS_DAYS, NEWS_MONTHS, PRICES

FILE_ROWS = 1_000_000


def write_staging(df: DataFrame, path: str, file_rows: int = FILE_ROWS) -> str:
    """Replace a staging folder."""
    df.write.mode("overwrite").option("maxRecordsPerFile", file_rows).parquet(path)
    return path


def write_feeds(df: DataFrame, path: str, keys: list[str] = ["feed"]) -> str:
    """Replace the staging folders of the feeds in `df`, each its own partition."""
    (df.hint("rebalance", *keys).write.mode("overwrite").partitionBy(*keys)
     .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", FILE_ROWS).parquet(path))
    return path


def write_months(df: DataFrame, path: str, file_rows: int = FILE_ROWS) -> str:
    """Replace the months that occur in `df`; other months stay.

    One job. The rebalance hint gathers the rows of a month and lets adaptive execution cut a
    month that is too large for a task.
    """
    months = df.select(*NEWS_COLUMNS, "year", "month").hint("rebalance", "year", "month")
    (months.write.mode("overwrite").partitionBy("year", "month")
     .option("partitionOverwriteMode", "dynamic")
     .option("maxRecordsPerFile", file_rows).parquet(path))
    return path


def read_months(spark: SparkSession, path: str, months: list[tuple[int, int]] | None = None,
                days: bool = False) -> DataFrame:
    """The analytic table, or some (year, month) of it; other folders are not read. `days` for a table
    of `write_days`, which has the feed and the staged day as well."""
    df = spark.read.schema(NEWS_DAYS if days else NEWS_MONTHS).parquet(path)
    if months is not None:
        wanted = F.lit(False)
        for year, month in months:
            wanted |= (F.col("year") == year) & (F.col("month") == month)
        df = df.filter(wanted)
    return df


def land_by_year(df: DataFrame, path: str, quarantine: str, date: str = "date",
                 sort: str = "keyword") -> str:
    """Land crawled rows in one folder per year, without rows dated by the sentinel.

    Rows whose date is missing or has no year replace the folder `quarantine`. Years that do not occur
    in `df` stay as they are.
    """
    rows = drop_sentinel_dates(df, date).withColumn("year", F.substring(date, 1, 4).try_cast("int"))
    dated, undated = split_undated(rows, "year")
    (dated.hint("rebalance", "year").sortWithinPartitions("year", sort)
     .write.mode("overwrite").partitionBy("year")
     .option("partitionOverwriteMode", "dynamic").parquet(path))
    write_staging(undated.drop("year"), quarantine)
    return path


def write_days(df: DataFrame, path: str, file_rows: int = FILE_ROWS) -> str:
    """Replace what the staged days (`feed`, `day`) in `df` have in their months; all else stays.

    A month is a folder with a folder per feed and staged day, so that adding a day reads and rewrites
    nothing of the month, and a write that is repeated changes nothing.
    """
    keys = ["year", "month", "feed", "day"]
    (df.select(*NEWS_COLUMNS, *keys).hint("rebalance", *keys).write.mode("overwrite").partitionBy(*keys)
     .option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", file_rows).parquet(path))
    return path


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """The paths of the folders that a path with wildcards names."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return [str(status.getPath()) for status in found if status.isDirectory()]


def remove_folders(spark: SparkSession, pattern: str) -> int:
    """Delete the folders that a path with wildcards names; returns how many."""
    found = folders(spark, pattern)
    for name in found:
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return len(found)


def folder_keys(path: str, keys: list[str]) -> tuple[str, ...]:
    """The values that the last folders of `path` give `keys`, as in `year=2025/month=3`."""
    named = dict(part.split("=", 1) for part in path.split("/")[-len(keys):])
    return tuple(unquote(named[k]) for k in keys)


def _on_one_line(col: Column) -> Column:
    """Line breaks and backslashes written as escapes."""
    for char, escape in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r")):
        col = F.replace(col, F.lit(char), F.lit(escape))
    return col


def write_csv(df: DataFrame, path: str, file_rows: int = FILE_ROWS, flat: bool = False) -> str:
    """CSV with a header that `read_csv` reads back to equal values, blanks included.

    With `flat` line breaks inside values are written as escapes, so that a file may be read by many tasks.
    """
    if flat:
        df = df.withColumns({f.name: _on_one_line(F.col(f.name)) for f in df.schema if f.dataType.typeName() == "string"})
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
     .option("maxRecordsPerFile", file_rows).csv(path))
    return path


def write_json(df: DataFrame, path: str) -> str:
    """One JSON object per line; null fields are left out."""
    df.write.mode("overwrite").json(path)
    return path


def write_formats(df: DataFrame, path: str) -> dict[str, str]:
    """The same table as parquet, CSV and JSON.

    The text forms are made from the written parquet, so `df` is computed once.
    """
    paths = {kind: f"{path}/{kind}" for kind in ("parquet", "csv", "json")}
    write_staging(df, paths["parquet"])
    saved = df.sparkSession.read.schema(df.schema).parquet(paths["parquet"])
    write_csv(saved, paths["csv"])
    write_json(saved, paths["json"])
    return paths


def write_price_json(prices: DataFrame, path: str) -> str:
    """Daily prices as column-oriented JSON, one folder per symbol; inverse of `read_price_json`."""
    columns = [f for f in PRICES.fields if f.name != "symbol"]

    def column(field) -> list:
        title = field.name.capitalize()
        name = F.lit("Date") if title == "Date" else F.concat(
            F.lit(f"('{title}', '"), F.col("symbol"), F.lit("')"))
        cells = F.transform("days", lambda d: F.struct(
            d["idx"].cast("string"), d[field.name].cast("string")))
        return [name, F.map_from_entries(cells)]

    row = F.struct("idx", *[f.name for f in columns])
    numbered = prices.withColumn("idx", F.date_diff("date", F.lit("1970-01-01").cast("date")))
    days = numbered.groupBy("symbol").agg(F.array_sort(F.collect_list(row)).alias("days"))
    doc = F.create_map(*[x for f in columns for x in column(f)])
    (days.select("symbol", F.to_json(doc).alias("value"))
     .write.mode("overwrite").option("maxRecordsPerFile", 1).partitionBy("symbol").text(path))
    return path


def create_table(spark: SparkSession, name: str, path: str, days: bool = False) -> None:
    """A catalog table over the files of `write_months` at `path`, or with `days` over those of `write_days`.

    It is partitioned like the files and belongs to the catalog, not to this session's views. Call it again for
    folders that came since.
    """
    keys = ["year", "month", *(["feed", "day"] if days else [])]
    columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in (NEWS_DAYS if days else NEWS_MONTHS))
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
              f"PARTITIONED BY ({', '.join(keys)}) LOCATION '{path}'")
    spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
    spark.catalog.refreshTable(name)


def register_table(spark: SparkSession, name: str, path: str) -> None:
    """Expose the analytic layer to SQL as `name`."""
    read_months(spark, path).createOrReplaceTempView(name)
