"""File listings: wildcards, newest file, allowed roots and format resolution."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.text import basename, dirname, extension, glob_to_regex, normalize_path
from ..operators.ordered import BLOCK_ROWS, OrderedRows


def list_files(spark: SparkSession, path: str) -> DataFrame:
    """``path, modificationTime, length`` below a folder; file contents are not read."""
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return listed.select("path", "modificationTime", "length")


def has_wildcard(path: Column) -> Column:
    return basename(path).rlike(r"[*?\[]")


def resolve_paths(
    requests: DataFrame,
    listing: DataFrame,
    pick: str = "latest",
    allowed_roots: tuple[str, ...] = (),
    block_rows: int = BLOCK_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """(resolved ``file_seq_id, file_ord, path``, rejected ``file_seq_id, error``).

    ``requests(file_seq_id, path, file_name, sub_path)``. A path without wildcard names one file. Otherwise
    files of the folder (``sub_path``, else that of the path) match the wildcard of the path, else the file
    name, else ``*``; the newest one (``latest``) or all of them by time (``all``) are taken. Requests meet
    files by folder; the wildcard is a residual condition.
    """
    given = F.coalesce("path", F.lit("")) != ""
    explicit = given & ~has_wildcard(F.col("path"))
    asked = requests.withColumns(
        {
            "__explicit": explicit,
            "__dir": F.coalesce(
                F.nullif("sub_path", F.lit("")), F.when(given, dirname(F.col("path")))
            ),
            "__glob": F.when(given & has_wildcard(F.col("path")), basename(F.col("path"))).otherwise(
                F.coalesce(F.nullif("file_name", F.lit("")), F.lit("*"))
            ),
        }
    )
    files = listing.select(
        F.col("path").alias("__file"), dirname(F.col("path")).alias("__fdir"),
        basename(F.col("path")).alias("__name"), F.col("modificationTime").alias("__mtime"),
    )
    one = asked.filter("__explicit").join(files, F.col("path") == F.col("__file"), "left").select(
        "file_seq_id", F.col("path").alias("__asked"), "__file", "__mtime"
    )
    visible = ~F.col("__name").startswith(".") | F.col("__glob").startswith(".")
    many = asked.filter(~F.col("__explicit")).join(
        files,
        (F.rtrim("__dir", F.lit("/")) == F.col("__fdir"))
        & visible
        & F.regexp_like(F.col("__name"), glob_to_regex(F.col("__glob"))),
        "left",
    )
    label = F.concat_ws("/", F.rtrim("__dir", F.lit("/")), "__glob")
    found = one.unionByName(many.select("file_seq_id", label.alias("__asked"), "__file", "__mtime"))
    if pick == "latest":
        chosen = (
            found.groupBy("file_seq_id", "__asked")
            .agg(F.max(F.struct("__mtime", "__file")).alias("f"))
            .select("file_seq_id", "__asked", F.col("f.__file").alias("__file"), F.lit(0).alias("file_ord"))
        )
    else:
        chosen = (
            OrderedRows.of(found, ["file_seq_id"], ["__mtime", "__file"], block_rows)
            .number("file_ord")
            .rows()
            .withColumn("file_ord", (F.col("file_ord") - 1).cast("int"))
        )
    real = normalize_path(F.col("__file"))
    inside = F.lit(not allowed_roots)
    for root in allowed_roots:
        inside = inside | real.startswith(root.rstrip("/") + "/")
    # the guard looks at the path asked for as well: a path outside the roots is not even looked up
    asked_inside = F.lit(not allowed_roots)
    for root in allowed_roots:
        asked_inside = asked_inside | normalize_path(F.col("__asked")).startswith(root.rstrip("/") + "/")
    error = (
        F.when(F.coalesce("__asked", F.lit("")).rlike("^[^/]*$"), "no path / subPath provided")
        .when(~asked_inside | ~F.coalesce(inside, F.lit(True)), F.concat(F.lit("path "), F.coalesce("__file", "__asked"), F.lit(" outside allowed roots")))
        .when(F.col("__file").isNull() & F.col("__asked").rlike(r"[*?\[][^/]*$"), F.concat(F.lit("no file matches "), F.col("__asked")))
        .when(F.col("__file").isNull(), F.concat(F.lit("file not found: "), F.col("__asked")))
    )
    judged = chosen.withColumn("error", error)
    bad = judged.filter(F.col("error").isNotNull()).select("file_seq_id", "error")
    good = judged.filter(F.col("error").isNull()).select("file_seq_id", "file_ord", real.alias("path"))
    # one bad file rejects its request
    return good.join(bad.select("file_seq_id").distinct(), "file_seq_id", "left_anti"), bad


def resolved_format(path: Column, declared: Column, is_chart: Column | None = None) -> Column:
    """``superset``, ``excel``, ``csv`` or ``pdf``: a chart request, then the extension, then the declared
    format; null when none of them tells."""
    ext, f = extension(F.coalesce(path, F.lit(""))), F.lower(F.coalesce(declared, F.lit("")))
    return (
        F.when(F.coalesce(is_chart, F.lit(False)) if is_chart is not None else F.lit(False), "superset")
        .when(ext.isin("xlsx", "xlsm", "xls"), "excel")
        .when(ext.isin("csv", "txt", "tsv"), "csv")
        .when(ext == "pdf", "pdf")
        .when(f.isin("excel", "xlsx", "xls"), "excel")
        .when(f.isin("csv", "delimited"), "csv")
        .when(f == "pdf", "pdf")
    )
