"""Delimited files as landed by the data providers: plain text columns, snake_case names, typed later by rule."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ladderweek.functions.expressions import clean_names


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path or glob matches anything, on whichever file system it names."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    found = fs.globStatus(hadoop_path)
    return bool(found)


def read_text_table(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """CSV with a header, every column a string: no inference pass over the data."""
    return clean_names(spark.read.option("header", True).option("mode", "PERMISSIVE").csv(paths))


def read_each(spark: SparkSession, sources: dict[str, str], parse) -> tuple[DataFrame | None, DataFrame]:
    """Reads every source on its own and unites those that work.

    Returns the united rows (None if no source worked) and ``source, path, status``. Columns a source lacks are
    NULL. A missing or unreadable source is reported and does not stop the others.
    """
    parts, report = [], []
    for name, path in sources.items():
        if not path_exists(spark, path):
            report.append((name, path, "missing"))
            continue
        try:
            parts.append(parse(read_text_table(spark, path)))
            report.append((name, path, "read"))
        except (AnalysisException, ValueError) as problem:
            report.append((name, path, f"unusable: {str(problem).splitlines()[0]}"))
    united = parts[0] if parts else None
    for part in parts[1:]:
        united = united.unionByName(part, allowMissingColumns=True)
    return united, spark.createDataFrame(report, "source string, path string, status string")


def trap_rate_files(folder: str, years: Iterable[int], species_code: int) -> dict[str, str]:
    """Reported-rate files of the given years, one per year and species code."""
    return {
        f"{year}-{species_code}": f"{folder.rstrip('/')}/pit_adult_valid_{year}_{species_code}.csv"
        for year in sorted(set(years))
    }


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def scan_folder(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """Every CSV file below ``folder`` in one scan: the columns of ``schema``, ``file`` and ``rejected``.

    A row whose fields do not fit the schema, in number or in kind, is rejected; what could be read of it is there.
    """
    with_text = f"{schema}, raw_text string"
    rows = (
        spark.read.schema(with_text)
        .option("header", True)
        .option("recursiveFileLookup", True)
        .option("columnPruning", False)  # else only the columns asked for would be checked
        .option("columnNameOfCorruptRecord", "raw_text")
        .csv(folder)
    )
    fields = [F.col(c).cast("string") for c in rows.columns if c != "raw_text"]
    parsed = F.length(F.concat_ws(",", *fields)) >= 0  # always so; the reader refuses to be asked for the raw text alone
    return rows.select("*", F.col("_metadata.file_path").alias("file"), (F.col("raw_text").isNotNull() & parsed).alias("rejected"))


def source_report(scanned: DataFrame, source: Column, expected: DataFrame) -> DataFrame:
    """``source, status, n_files, rows_read, rows_rejected`` of every expected source, by one aggregation of the scan.

    ``expected`` has a column ``source``. The status is ``read``, ``partly`` where some rows were rejected, ``broken`` where
    all were, ``missing`` where there was no row.
    """
    seen = scanned.groupBy(source.alias("source")).agg(
        F.count_distinct("file").alias("n_files"),
        F.count_if(~F.col("rejected")).alias("rows_read"),
        F.count_if("rejected").alias("rows_rejected"),
    )
    every = expected.join(seen, "source", "left").fillna(0, ["n_files", "rows_read", "rows_rejected"])
    status = (
        F.when(F.col("n_files") == 0, "missing")
        .when(F.col("rows_read") == 0, "broken")
        .when(F.col("rows_rejected") > 0, "partly")
        .otherwise("read")
    )
    return every.select("source", status.alias("status"), "n_files", "rows_read", "rows_rejected")


#: Where a row stands in files that ``write_ordered`` wrote: the file, and the row in it, both from 0.
FILE_NO, ROW_IN_FILE = "file_no", "row_in_file"


def write_ordered(df: DataFrame, path: str, order: list[str], files: int) -> None:
    """Parquet files that hold ``df`` in one order throughout: every row of a file comes before those of the next.

    Rows are dealt by ranges of the order columns and sorted within a file, so no task holds more than a file.
    """
    dealt = df.repartitionByRange(files, *order).sortWithinPartitions(*order)
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    dealt.select("*", F.spark_partition_id().alias(FILE_NO), row.alias(ROW_IN_FILE)).write.mode("overwrite").parquet(path)


def read_ordered(spark: SparkSession, path: str, position: str = "position") -> DataFrame:
    """The rows of ``write_ordered`` with their position from 1, which follows from the number of rows in each file."""
    rows = spark.read.parquet(path)
    sizes = rows.groupBy(FILE_NO).agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy(FILE_NO)) - F.col("n")  # one row per file
    placed = rows.join(sizes.select(FILE_NO, before.alias("before")), FILE_NO)
    return placed.withColumn(position, F.col("before") + F.col(ROW_IN_FILE) + 1).drop(FILE_NO, ROW_IN_FILE, "before")
