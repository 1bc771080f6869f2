"""Nested JSON: paged API dumps and dated drops."""

from __future__ import annotations

from collections.abc import Collection, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from funnelspark.session import scratch_dir
from funnelspark.sources.json_values import read_values, split_values, text_lines

PATH_DATE = r"/(\d{4}-\d{2}-\d{2})/"


def parse_values(values: DataFrame, schema: StructType | str) -> DataFrame:
    """(path, value, bad) of (path, text, broken): nothing is dropped, what does not parse is a row with its text in ``bad``."""
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    marked = StructType([*schema.fields, StructField("_bad", StringType())])
    parsed = values.withColumn("value", F.from_json("text", marked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    bad = F.when(F.col("broken") | F.col("value").isNull(), F.col("text")).otherwise(F.col("value._bad"))
    return parsed.select("path", F.struct(*[F.col(f"value.`{f.name}`").alias(f.name) for f in schema.fields]).alias("value"), bad.alias("bad"))


def _values(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str) -> DataFrame:
    """(path, value, bad) of every JSON value of every file, however values and lines lie (:mod:`json_values`)."""
    return parse_values(read_values(spark, paths if isinstance(paths, str) else list(paths)), schema)


def infer_schema(spark: SparkSession, paths: str | Sequence[str]) -> StructType:
    """Schema of all values that parse, from one pass that writes them a line each to the shared folder."""
    values = read_values(spark, paths if isinstance(paths, str) else list(paths)).where(~F.col("broken"))
    path = scratch_dir(spark, "json-lines")
    values.select(F.translate("text", "\r\n", "  ").alias("value")).write.text(path)
    return spark.read.json(path).schema


def dead_letters(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str) -> DataFrame:
    """(path, text) of everything in the files that is not a JSON value of the schema."""
    return _values(spark, paths, schema).where(F.col("bad").isNotNull()).select("path", F.col("bad").alias("text"))


def unreadable(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str, records: str | None = None) -> DataFrame:
    """(path, values): files with values that do not parse, or without ``records`` where that is named."""
    rows = _values(spark, paths, schema)
    bad = F.col("bad").isNotNull()
    if records:
        bad = bad | F.col(f"value.{records}").isNull()
    return rows.where(bad).groupBy("path").agg(F.count(F.lit(1)).alias("values"))


def _checked(rows: DataFrame, on_bad: str) -> DataFrame:
    if on_bad == "skip":  # the caller lists them by unreadable()
        return rows.where(F.col("bad").isNull())
    if on_bad != "raise":
        raise ValueError("on_bad is 'raise' or 'skip'")
    message = F.concat(F.lit("unreadable JSON in "), F.col("path"))
    value = F.when(F.col("bad").isNotNull(), F.raise_error(message).cast(rows.schema["value"].dataType)).otherwise(F.col("value"))
    return rows.withColumn("value", value)


def read_with_path(spark: SparkSession, paths: str | Sequence[str], schema: StructType | str, on_bad: str = "raise") -> DataFrame:
    """Every value of the files with the ``path`` it stands in."""
    return _checked(_values(spark, paths, schema), on_bad).select("path", "value.*")


def read_pages(
    spark: SparkSession,
    path: str | Sequence[str],
    records: str,
    schema: StructType | str | None = None,
    date_pattern: str = PATH_DATE,
    date_format: str = "yyyy-MM-dd",
    on_bad: str = "raise",
) -> DataFrame:
    """One row per record of paged JSON files, with ``snapshot_date`` taken from the file path.

    Every value of every file is read. A value that does not parse fails the job, or is left out with ``on_bad="skip"``;
    :func:`unreadable` lists such files. Pass ``schema`` for large drops: inferring it reads every file once more.
    """
    if schema is None:
        schema = infer_schema(spark, path)
    text = F.regexp_extract("path", date_pattern, 1)
    raw = _checked(_values(spark, path, schema), on_bad).select(
        F.try_to_timestamp(text, F.lit(date_format)).cast("date").alias("snapshot_date"), F.explode(f"value.{records}").alias("rec")
    )
    return raw.select("snapshot_date", "rec.*")


def read_roots(
    spark: SparkSession, roots: Mapping[str, str], schema: StructType | str | None = None, tag: str = "_root", on_bad: str = "raise",
    required: Collection[str] = (),
) -> tuple[DataFrame, list[tuple[str, str]]]:
    """Union by name of several roots; roots that are not there are skipped and reported, none there or a ``required`` one missing is an error.

    Only a path that does not exist is skipped: any other failure (a store that does not answer, a broken file, a failed job) fails the read.
    Values that do not parse fail the job (``on_bad="skip"`` leaves them out; :func:`unreadable` lists their files).
    """
    frames, skipped = [], []
    for name, path in roots.items():
        try:
            source = spark.read.text(path)
        except AnalysisException as err:  # a missing root must not stop the others
            if err.getCondition() != "PATH_NOT_FOUND":
                raise
            skipped.append((name, type(err).__name__))
            continue
        own = schema if schema is not None else infer_schema(spark, path)
        frames.append(_checked(parse_values(split_values(text_lines(source)), own), on_bad).select("value.*").withColumn(tag, F.lit(name)))
    if not frames:
        raise RuntimeError(f"no root could be read: {skipped}")
    if missing := sorted({*required} - ({*roots} - {n for n, _ in skipped})):
        raise RuntimeError(f"roots that must be there are not: {missing}")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out, skipped


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """Path, modification time and length of files; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .load(path)
        .select("path", "modificationTime", "length")
    )


def newest_per_day(
    files: DataFrame, source: Column, day_pattern: str, loaded: DataFrame | None = None, day_format: str = "yyyyMMdd", drop_pattern: str | None = None
) -> DataFrame:
    """All files of the newest drop per source and day, days not after the source's loaded maximum left out.

    A drop is what ``drop_pattern`` extracts from the path (its greatest value is the newest); without one each file is a drop.
    ``loaded`` holds (source, last_day).
    """
    day = F.try_to_timestamp(F.regexp_extract("path", day_pattern, 1), F.lit(day_format)).cast("date")
    drop = F.regexp_extract("path", drop_pattern, 1) if drop_pattern else F.col("path")
    named = files.select("path", source.alias("source"), day.alias("day"), drop.alias("_drop")).where("day is not null")
    if loaded is not None:
        marks = loaded.select(F.col("source").alias("_s"), F.col("last_day").alias("_d"))
        named = named.join(
            marks, (F.col("source") == F.col("_s")) & (F.col("day") <= F.col("_d")), "left_anti"
        )
    newest = named.groupBy("source", "day").agg(F.max("_drop").alias("_newest"))
    same = named["source"].eqNullSafe(newest["source"]) & (named["day"] == newest["day"]) & (named["_drop"] == newest["_newest"])
    return named.join(newest, same, "left_semi").select("source", "day", "path")


def read_selected(spark: SparkSession, chosen: DataFrame, schema: StructType | str, on_bad: str = "raise") -> DataFrame:
    """Every value of the chosen files, with their ``path``. The list holds the files of one drop per source and day, the size of a file index."""
    paths = [r.path for r in chosen.select("path").toLocalIterator()]
    schema = StructType.fromDDL(schema) if isinstance(schema, str) else schema
    if not paths:
        return spark.createDataFrame([], StructType([StructField("path", StringType()), *schema.fields]))
    return _checked(_values(spark, paths, schema), on_bad).select("path", "value.*")
