"""Records of delimited files whose quoted fields may hold line breaks, read by many tasks.

A file is read as lines, so it is split like any text. What a line does to the state at its start
(outside or inside quotes) is one of four functions: it keeps the state, ends outside, ends inside, or turns
it round. Functions of lines are combined to those of runs of lines, runs are scanned per file, and
so every line learns its state. Runs that hold whole lines only stay where they are; the lines of others
are put together to records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Lines of a run. Only runs with a record of several lines, and the first of each file, are shuffled.
RUN = 10_000


def _open_at_end(line: Column, state: str) -> Column:
    """Whether a field in quotes is open at the end of ``line``, whose start is S(tart of a field) or I(n quotes).

    Between two quotes the state is S, F (in a field that doesn't start with a quote, where quotes are
    characters), I, or Q (after a quote inside quotes, which ends the field unless another follows at once).
    """
    parts = F.split(line, '"')
    before_quotes = F.slice(parts, F.lit(1), F.size(parts) - 1)

    def step(now: Column, part: Column) -> Column:
        return (F.when(now == "I", "Q").when((now == "Q") & (part == ""), "I").when((now == "S") & (part == ""), "I")
                .when(F.endswith(part, F.lit(",")), "I").otherwise("F"))

    return F.aggregate(before_quotes, F.lit(state), step) == "I"


def _odd(n: Column) -> Column:
    return n % 2 == 1


def _lines(spark: SparkSession, path: str | list[str], run: int) -> DataFrame:
    """Lines in order of (``start``, ``line``) within a ``file``, what they do, and the run they are in.

    ``a`` and ``b`` tell whether quotes are open after the line if they were closed, and if they were open, before it.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("name"), F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("line"), "value")
    quoted = F.instr("value", '"') > 0
    return lines.select("file", "name", "start", F.floor(F.col("line") / run).alias("run"), "line", "value",
                        F.when(quoted, _open_at_end(F.col("value"), "S")).otherwise(F.lit(False)).alias("a"),
                        F.when(quoted, _open_at_end(F.col("value"), "I")).otherwise(F.lit(True)).alias("b"))


def _sets() -> Column:
    return F.col("a") == F.col("b")


def _turns() -> Column:
    return F.col("a") & ~F.col("b")


def _runs(lines: DataFrame) -> DataFrame:
    """The runs that need their lines put together: (``file``, ``start``, ``run``, ``open`` at their start, ``head`` line of the file or null).

    A run's last line that sets the state, turned by the lines after it, tells the state at its end; without
    such a line the state at its start is turned. There is one row for a run, so a file's runs are scanned in one go.
    """
    runs = lines.groupBy("file", "start", "run").agg(
        F.max(F.when(_sets(), F.struct("line", "a"))).alias("last"), F.collect_list(F.when(_turns(), F.col("line"))).alias("turning"),
        F.max("a").alias("opens"), F.min("line").alias("first"))
    after = F.size(F.filter("turning", lambda t: F.col("last").isNull() | (t > F.col("last.line"))))
    runs = runs.select("file", "start", "run", "first", "opens", F.col("last.a").alias("sets"), _odd(after).alias("turns"))
    in_file = Window.partitionBy("file").orderBy("start", "first")
    runs = runs.withColumn("turned", F.sum(F.col("turns").cast("long")).over(in_file))
    setter = F.struct("start", "first", (F.col("sets") != F.col("turns")).alias("open"), "turned")
    runs = runs.withColumn("known", F.max(F.when(F.col("sets").isNotNull(), setter)).over(in_file))
    ends_open = F.when(F.col("known").isNull(), _odd(F.col("turned"))).otherwise(
        F.col("known.open") != _odd(F.col("turned") - F.col("known.turned")))
    runs = runs.select("file", "start", "run", "opens", F.coalesce(F.lag(ends_open).over(in_file), F.lit(False)).alias("open"),
                       F.when(F.row_number().over(in_file) == 1, F.col("first")).alias("head"))
    return runs.where(F.col("open") | F.col("opens") | F.col("head").isNotNull()).drop("opens")


def csv_records(spark: SparkSession, path: str | list[str], run: int = RUN) -> DataFrame:
    """(``name``, ``record``, ``first``): a row for each record of the files at ``path``, with the name of its file;
    ``first`` marks the first record of each file.

    Fields are quoted by double quotes, which are doubled inside; a quote inside an unquoted field is a
    character. Lines end in a line feed, with or without a carriage return; blank lines are no records. A
    field that is still open at the end of a file ends there. Empty files have no records.
    """
    lines = _lines(spark, path, run)
    key = ["file", "start", "run"]
    mixed = _runs(lines)
    whole = lines.join(mixed, key, "left_anti").select("name", F.col("value").alias("record"), F.lit(False).alias("first"))

    # the state before each line of the other runs, and the line with which its record starts
    in_run = Window.partitionBy(*key).orderBy("line")
    before, upto = in_run.rowsBetween(Window.unboundedPreceding, -1), in_run.rowsBetween(Window.unboundedPreceding, 0)
    parts = lines.join(mixed, key).withColumn("turned", F.sum(_turns().cast("long")).over(upto))
    parts = parts.withColumns({"last": F.max(F.when(_sets(), F.struct("line", "a", "turned"))).over(before),
                               "before": F.coalesce(F.max("turned").over(before), F.lit(0))})
    inside = F.when(F.col("last").isNull(), F.col("open") != _odd(F.col("before"))).otherwise(
        F.col("last.a") != _odd(F.col("before") - F.col("last.turned")))
    parts = parts.withColumn("start_of", F.when(~inside, F.struct("start", "line")))
    parts = parts.withColumn("begun", F.max("start_of").over(upto))
    # lines that go on with a record of an earlier run: the last start before them
    carried = parts.groupBy(*key).agg(F.min("line").alias("first_line"), F.max("start_of").alias("latest"))
    earlier = Window.partitionBy("file").orderBy("start", "first_line").rowsBetween(Window.unboundedPreceding, -1)
    carried = carried.select(*key, F.max("latest").over(earlier).alias("carried"))
    joined = (parts.join(carried, key).withColumn("begun", F.coalesce("begun", "carried")).groupBy("file", "begun")
              .agg(F.array_sort(F.collect_list(F.struct("start", "line", "value"))).alias("v"), F.max(F.col("head") == F.col("line")).alias("first"), F.max("name").alias("name"))
              .select("name", F.array_join("v.value", "\n").alias("record"), F.coalesce("first", F.lit(False)).alias("first")))
    records = whole.unionByName(joined).withColumn("record", F.regexp_replace("record", "\r$", ""))
    return records.where(F.col("first") | (F.trim("record") != ""))
