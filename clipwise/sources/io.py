"""Sources and sinks: manifests, reports, JSON arrays, texts and directories."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .files import file_names

MANIFEST = "audio string, text string, duration double, align_mean double, align_min double, ref_audio string"
LOCAL_REPORT = "clip int, dur double, words int, wps double, lead_sil double, status string, reasons string"
ASR_REPORT = "clip int, dur double, align_min double, align_mean double, cer_raw double, cer_core double, wer double, sanskrit_load double, lead double, trail double, status string, reasons string"
REVIEW = "idx int, cer_gate string, align_min double, cer_core double, note string"
SEGMENTS = "id int, start double, end double, dur double"
SEGMENTS_EXPORT = "clip int, start double, end double, dur double, decision string, text string"
SCORES = "ckpt string, sent string, seed int, seen boolean, ecapa double, f0 double, mcd double, f0rmse double"
#: Columns of the reports in which -1 stands for "not measured".
MEASURED = ("cer_raw", "cer_core", "wer", "sanskrit_load", "lead", "trail", "lead_sil")


def read_jsonl(spark: SparkSession, path: str, schema: str = MANIFEST) -> DataFrame:
    """JSON lines with an explicit schema; blank lines are skipped, absent keys are null."""
    return spark.read.schema(schema).json(path)


def read_tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Tab-separated with a header; quotes are ordinary characters; -1 in a measured column becomes null."""
    df = spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", "").csv(path)
    return df.withColumns({c: F.when(F.col(c) >= -0.5, F.col(c)) for c in df.columns if c in MEASURED and c != "sanskrit_load"})


def read_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """path and value, a row for each file."""
    return spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("path"), "value")


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines that are neither blank nor comments."""
    return spark.read.text(path).where("trim(value) <> '' AND NOT ltrim(value) LIKE '#%'")


def _absent(e: AnalysisException) -> bool:
    return "PATH_NOT_FOUND" in str(e)


def read_words(spark: SparkSession, path: str) -> DataFrame:
    """Distinct words; a missing file is an empty list."""
    try:
        lines = spark.read.text(path)
    except AnalysisException as e:
        if not _absent(e):
            raise
        return spark.range(0).select(F.lit("").alias("word"))
    return lines.select(F.explode(F.split(F.trim("value"), r"\s+")).alias("word")).where("word <> ''").distinct()


def cached(spark: SparkSession, path: str, make: Callable[[], DataFrame], *, refresh: bool = False) -> DataFrame:
    """The table at ``path``; it is made and written first where it is absent, or to be made anew."""
    if not refresh:
        try:
            return spark.read.parquet(path)
        except AnalysisException as e:
            if not _absent(e):
                raise
    df = make()
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def converted(spark: SparkSession, rows: DataFrame, path: str, key: str, convert: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The table at ``path`` after appending the conversion of those rows whose key it lacks."""
    try:
        todo = rows.join(spark.read.parquet(path).select(key).distinct(), key, "left_anti")
    except AnalysisException as e:
        if not _absent(e):
            raise
        todo = rows
    convert(todo).write.mode("append").parquet(path)
    return spark.read.parquet(path)


def from_name(name: Column, pattern: str, groups: dict[str, str]) -> list[Column]:
    """Columns named by ``groups`` (name to type) from a file name's regex groups in order; null where it doesn't match."""
    found = [F.regexp_extract(name, pattern, i) for i in range(1, len(groups) + 1)]
    return [F.when(name.rlike(pattern), c).cast(t).alias(g) for c, (g, t) in zip(found, groups.items(), strict=True)]


def list_files(spark: SparkSession, path: str, pattern: str, groups: dict[str, str]) -> DataFrame:
    """Files whose names match, empty ones too, with the parts of their names; tasks list folders, and no file is opened."""
    files = file_names(spark, path)
    return files.where(F.col("name").rlike(pattern)).select("path", *from_name(F.col("name"), pattern, groups))


def manifests(spark: SparkSession, root: str, schema: str = MANIFEST) -> DataFrame:
    """Manifests of all lectures under a root, each row with its lecture, the folder's name; an error if there are none."""
    df = spark.read.schema(schema).json(f"{root}/*/train.jsonl")
    return df.withColumn("lecture", F.regexp_extract("_metadata.file_path", r"([^/]+)/[^/]+$", 1))


def write_jsonl(df: DataFrame, path: str) -> None:
    """JSON lines, with keys left out where they are null; earlier output goes."""
    df.write.mode("overwrite").json(path)


def write_tsv(df: DataFrame, path: str) -> None:
    """Tab-separated with a header; tabs in texts become blanks and a null measure -1."""
    clean = {c: F.regexp_replace(c, "\t", " ") for c, t in df.dtypes if t == "string"}
    clean |= {c: F.coalesce(F.col(c), F.lit(-1.0)) for c, t in df.dtypes if c in MEASURED and t == "double"}
    df.withColumns(clean).write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").option("emptyValue", "").csv(path)


def write_lines(df: DataFrame, path: str, column: str = "value") -> None:
    """A line for each row; line ends inside become blanks."""
    df.select(F.regexp_replace(column, r"[\r\n]+", " ").alias("value")).write.mode("overwrite").text(path)


def tsv_lines(df: DataFrame, *columns: str) -> Column:
    """A row as tab-separated text, tabs inside as blanks and nulls empty."""
    return F.concat_ws("\t", *[F.regexp_replace(F.coalesce(F.col(c).cast("string"), F.lit("")), "\t", " ") for c in columns])


def subset_yaml(template: str, sizes: list[int]) -> dict[int, str]:
    """A training configuration for each subset size: the template with ``{n}`` filled in."""
    return {n: template.replace("{n}", str(n)) for n in sizes}


def json_array(df: DataFrame, *order: str) -> DataFrame:
    """One row with the table as a JSON array: for exports that a reviewer loads, not for whole corpora."""
    rows = F.array_sort(F.collect_list(F.struct(*order, *[c for c in df.columns if c not in order])))
    return df.agg(F.to_json(rows).alias("json"))


def lint_digits(lines: DataFrame, column: str = "value") -> DataFrame:
    return lines.where(F.col(column).rlike("[0-9]"))


def looks_like_header(c: Column) -> Column:
    return c.rlike(r"^\s*[A-Z][A-Za-z .]{1,30}:")
