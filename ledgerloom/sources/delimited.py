"""Delimited files as rows of cells with source row numbers; one large file is read and numbered by many tasks.

Lines are read as text in one scan and written with their input block and place, so that nothing read later can
number them differently. A quoted cell may hold line breaks, so a line may go on the record before it. Whether it
does depends on whether a quote is open at its start: each line maps the state at its start (no quote open, quote
open) to that at its end, and such maps can be combined, first within chunks of an input block, then over the chunks
of a file (one slim row per chunk), then back. Records are numbered the same way. Two numbers are kept: the physical record (the
header is record N) and the kept row (blank rows are not counted).
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions.text import local_path, quote_regex, strip
from ..session import write_once


def delimiter_of(details_delimiter: Column, request_delimiter: Column) -> Column:
    """The delimiter of the file details beats that of the request; the tab may be spelled ``\\t`` or ``tab``."""
    none = F.lit("")
    chosen = F.coalesce(F.nullif(details_delimiter, none), F.nullif(request_delimiter, none), F.lit(","))
    return F.when(chosen.isin("\\t", "tab"), "\t").otherwise(chosen)


def header_row_of(headers_row: Column) -> Column:
    """1-based header record of a request; missing or zero means the first."""
    return F.greatest(F.coalesce(headers_row, F.lit(1)), F.lit(1))


#: What may stand between the quotes of a cell. All repeats are possessive: the matcher neither goes back nor recurses.
_INSIDE = '[^"]*+(?:""[^"]*+)*+'


def split_line(line: Column, delimiter: Column) -> Column:
    """Cells of one record: quoted cells may hold delimiters and line breaks, doubled quotes stand for one.

    What follows a closing quote up to the next delimiter belongs to the cell as it is; a quote that is never closed
    takes the rest of the record.
    """
    sep = quote_regex(delimiter)
    # each match consumes the delimiter in front of its cell
    pattern = F.concat(sep, F.lit(f'("{_INSIDE}(?:"[^'), sep, F.lit(']*+|\\z)|(?!")[^'), sep, F.lit("]*+)"))
    quoted = F.transform(
        F.regexp_extract_all(F.concat(delimiter, line), pattern, F.lit(1)),
        lambda c: F.when(
            c.startswith('"'),
            F.concat(
                F.replace(F.regexp_extract(c, f'^"({_INSIDE})', 1), F.lit('""'), F.lit('"')),
                F.regexp_extract(c, f'(?s)^"{_INSIDE}"(.*+)', 1),
            ),
        ).otherwise(c),
    )
    plain = F.split(line, sep, F.lit(-1))
    return F.when(line.contains('"'), quoted).otherwise(plain)


def read_lines(spark: SparkSession, paths) -> DataFrame:
    """``path, block, size, line`` of text files, line ends included; ``__id`` counts the lines of a scan task.

    A line ends with a line feed, a carriage return or both. What stands after a carriage return in the bytes between
    two line feeds is a line of its own. The last line of a file gets a line feed, whether it has one or not.
    """
    raw = spark.read.option("lineSep", "\n").text(paths).select(
        local_path(F.col("_metadata.file_path")).alias("path"),
        F.col("_metadata.file_block_start").alias("block"),
        F.col("_metadata.file_size").alias("size"),
        F.concat("value", F.lit("\n")).alias("line"),
    )
    # as binary text in Latin-1 every byte is a character, so that no byte changes
    latin = F.decode(F.col("line").cast("binary"), "ISO-8859-1")
    several = F.transform(F.split(latin, "(?<=\r)(?!\n)"), lambda x: F.encode(x, "ISO-8859-1").cast("string"))
    lines = F.when(F.instr(F.regexp_replace("line", "\r\n$", ""), "\r") > 0, several).otherwise(F.array("line"))
    return raw.select("path", "block", "size", F.explode(lines).alias("line")).withColumn("__id", F.monotonically_increasing_id())


def _open_at_end(line: Column, delimiter: Column) -> tuple[Column, Column]:
    """Whether a quote is open at the end of a line: (if none is open at its start, if one is).

    A quote opens only at the start of a cell and closes at the first quote that is not doubled.
    """
    sep, other = quote_regex(delimiter), F.concat(F.lit("[^"), quote_regex(delimiter), F.lit("]*+"))
    inside = F.lit(_INSIDE)
    cell = F.concat(F.lit('(?:"'), inside, F.lit('"'), other, F.lit('|(?!")'), other, F.lit(")"))
    opens = F.concat(F.lit("(?:"), cell, sep, F.lit(')*+"'), inside, F.lit("$"))
    def hit(*parts):
        return F.regexp_like(line, F.concat(F.lit("(?s)^"), *parts))
    quoted = line.contains('"')
    fresh = quoted & hit(opens)
    held = ~quoted | hit(inside, F.lit("$")) | hit(inside, F.lit('"'), other, sep, opens)
    return fresh.cast("int"), held.cast("int")


def _states(rows: DataFrame, keys: list[str], order: list[str], before: Column) -> DataFrame:
    """``rows``(fresh, held) in order within ``keys``: ``state`` is 1 where a quote is open at the start of the row.

    ``before`` is the state at the start of the group. A row that maps both states to one fixes the state; after
    the last such row only the number of rows that swap the states counts.
    """
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    fixed, swaps = F.col("fresh") == F.col("held"), F.col("fresh") > F.col("held")
    counted = rows.withColumn("__swaps", F.coalesce(F.sum(swaps.cast("int")).over(w), F.lit(0)))
    last = F.last(F.when(fixed, F.struct("fresh", "__swaps")), ignorenulls=True).over(w)
    counted = counted.withColumn("__last", last)
    since = F.col("__swaps") - F.coalesce("__last.__swaps", F.lit(0))
    return counted.withColumn("state", (F.coalesce("__last.fresh", before) + since) % 2).drop("__swaps", "__last")


#: Lines of a scan task whose quotes are settled together.
CHUNK = 1 << 16


def _records(lines: DataFrame) -> DataFrame:
    """Lines with the number of their ``record`` (from 1 within the file), whether a quote is ``open`` at their end, and
    whether they are ``whole`` records."""
    # a window keeps the lines of its group, so that a whole input block of short lines would be too many
    block = ["path", "block", "__chunk"]
    lines = lines.withColumn("__chunk", F.floor(F.col("__id") / CHUNK))
    inner = _states(lines, block, ["__id"], F.lit(0)).withColumn("__if0", F.col("state"))
    inner = _states(inner, block, ["__id"], F.lit(1)).withColumn("__if1", F.col("state")).drop("state")
    end = [F.max_by(F.when(F.col(x) == 1, F.col("held")).otherwise(F.col("fresh")), "__id").alias(n) for x, n in (("__if0", "fresh"), ("__if1", "held"))]
    starts = [F.sum(1 - F.col(x)).alias(n) for x, n in (("__if0", "__starts0"), ("__if1", "__starts1"))]
    blocks = _states(inner.groupBy(*block).agg(*end, *starts), ["path"], ["block", "__chunk"], F.lit(0))
    begun = F.when(F.col("state") == 0, F.col("__starts0")).otherwise(F.col("__starts1"))
    w = Window.partitionBy("path").orderBy("block", "__chunk").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(*block, "state", F.coalesce(F.sum(begun).over(w), F.lit(0)).alias("__before"))
    known = inner.join(blocks, block).withColumn("__goes_on", F.when(F.col("state") == 0, F.col("__if0")).otherwise(F.col("__if1")))
    count = F.sum(1 - F.col("__goes_on")).over(Window.partitionBy(*block).orderBy("__id"))
    open_at_end = F.when(F.col("__goes_on") == 1, F.col("held")).otherwise(F.col("fresh"))
    known = known.select(
        "path", "block", "__id", "line", "end", "delimiter", (F.col("__before") + count).alias("record"),
        (open_at_end == 1).alias("open"), ((F.col("__goes_on") == 0) & (open_at_end == 0)).alias("whole"))
    return write_once(known, "known-lines")


def _too_long(known: DataFrame, limit: int) -> DataFrame:
    """``path, record, length`` of the first record of each file that several lines make longer than ``limit`` characters."""
    several = known.filter("not whole").groupBy("path", "record").agg(F.sum(F.length("line") + F.length("end")).alias("length"))
    return several.filter(F.col("length") > limit).groupBy("path").agg(F.min(F.struct("record", "length")).alias("first")).select("path", "first.*")


def _joined(known: DataFrame) -> DataFrame:
    """``path, record, line, delimiter``: the lines of each record with the line ends between them.

    The last line's own end belongs to the record only where its quote is never closed.
    """
    pieces = F.sort_array(F.collect_list(F.struct("block", "__id", "open", "line", "end")))
    text = F.array_join(F.transform(pieces, lambda x: F.concat(x["line"], F.when(x["open"], x["end"]).otherwise(F.lit("")))), "")
    several = known.filter("not whole").groupBy("path", "record", "delimiter").agg(text.alias("line"))
    return known.filter("whole").select("path", "record", "line", "delimiter").unionByName(several)


#: Records of a file that are counted together.
COUNTED = 1 << 16
#: Characters of a record of several lines; a file with a longer one (a quote left open, as a rule) is rejected.
RECORD_CHARS = 1 << 24


@dataclass(frozen=True)
class Delimited:
    """``tables`` and ``cells`` of the files that could be read, and ``rejected(path, error)``."""

    tables: DataFrame
    cells: DataFrame
    rejected: DataFrame


def number_lines(lines: DataFrame, requests: DataFrame, limit: int = RECORD_CHARS) -> tuple[DataFrame, DataFrame]:
    """Non-blank records with ``record`` (physical, 1-based) and ``kept`` (counting non-blank ones), and rejected files.

    Whether a record is blank depends on the delimiter of its file. A file with any line that is not valid UTF-8 is
    read as Latin-1 as a whole; a byte order mark at the start of the others is dropped.
    """
    asked = requests.select("path", "delimiter").distinct()
    lines = write_once(lines.join(asked, "path"), "lines")
    place = F.struct("block", "__id")
    files = lines.groupBy("path").agg(
        F.max(~F.is_valid_utf8("line")).alias("latin1"), F.min(place).alias("first"), F.max(place).alias("last"),
        (F.sum(F.octet_length("line")) > F.max("size")).alias("cut"))  # a line feed more than the file has bytes
    lines = lines.join(files, "path")
    text = F.when(F.col("latin1"), F.decode(F.col("line").cast("binary"), "ISO-8859-1")).otherwise(
        F.when(place == F.col("first"), F.regexp_replace("line", "^\ufeff", "")).otherwise(F.col("line")))
    unfinished = F.col("cut") & (place == F.col("last"))
    lines = lines.withColumn("text", F.when(unfinished, F.regexp_replace(text, "\n\\z", "")).otherwise(text))
    line = F.rtrim("text", F.lit("\r\n"))
    end = F.substr("text", F.length(line) + 1)
    lines = lines.select("path", "block", "__id", "delimiter", line.alias("line"), end.alias("end"))
    fresh, held = _open_at_end(F.col("line"), F.col("delimiter"))
    known = _records(lines.withColumns({"fresh": fresh, "held": held}))
    rejected = write_once(_too_long(known, limit), "too-long")
    records = _joined(known.join(rejected, "path", "left_anti"))
    quotes = F.concat(F.lit("["), quote_regex(F.col("delimiter")), F.lit('"]'))
    # what only looks blank is cut into cells: a quoted delimiter or a doubled quote is something
    blank = F.when(strip(F.regexp_replace("line", quotes, F.lit(""))) != "", False).when(~F.col("line").contains('"'), True).otherwise(
        ~F.exists(split_line(F.col("line"), F.col("delimiter")), lambda c: strip(c) != ""))
    group = ["path", "__group"]
    records = records.withColumns({"__kept": (~blank).cast("int"), "__group": F.floor(F.col("record") / COUNTED)})
    groups = records.groupBy(*group).agg(F.sum("__kept").alias("__n"))
    w = Window.partitionBy("path").orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    before = groups.select(*group, F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__before"))
    within = F.sum("__kept").over(Window.partitionBy(*group).orderBy("record"))
    numbered = records.withColumn("__within", within).filter("__kept = 1").join(before, group)
    numbered = numbered.select("path", "record", (F.col("__before") + F.col("__within")).alias("kept"), "line")
    error = F.format_string("record %d has %d characters, more than a record of several lines may have", "record", "length")
    return write_once(numbered, "numbered"), rejected.select("path", error.alias("error"))


def read_delimited(spark: SparkSession, requests: DataFrame, paths, limit: int = RECORD_CHARS) -> Delimited:
    """The delimited files of ``requests(file_seq_id, file_ord, path, delimiter, headers_row)``.

    The header is physical record ``headers_row``; records above it and blank rows are dropped. ``src_row`` is
    ``headers_row + i`` for the i-th kept row below the header. A file in which a record of several lines has more than
    ``limit`` characters is rejected; the others are read all the same.
    """
    requests = requests.withColumn("path", local_path(F.col("path")))
    numbered, rejected = number_lines(read_lines(spark, paths), requests, limit)
    numbered = numbered.join(requests, ["path"], "inner")
    at = F.col("headers_row")
    parts = numbered.withColumn("cells", split_line(F.col("line"), F.col("delimiter")))
    # the records down to the header: a handful per file; the cells are matched with what they say, so they are written
    heads = (
        numbered.filter(F.col("record") <= at)
        .groupBy("file_seq_id", "file_ord", "path", "delimiter", "headers_row")
        .agg(
            F.max("kept").alias("__above"),
            F.max(F.when(F.col("record") == at, F.struct("record", "line"))).alias("__head"),
        )
    )
    tables = write_once(heads.filter(F.col("__head").isNotNull()).select(
        "file_seq_id", "file_ord", F.lit(0).alias("table_no"), "path",
        split_line(F.col("__head.line"), F.col("delimiter")).alias("headers"),
        (at + 1).cast("bigint").alias("first_row_no"), "__above",
    ), "heads")
    body = parts.filter(F.col("record") > at).join(tables.select("file_seq_id", "file_ord", "table_no", "__above"), ["file_seq_id", "file_ord"], "inner")
    cells = body.filter(F.exists("cells", lambda c: strip(c) != "")).select(
        "file_seq_id", "file_ord", "table_no", "path",
        (at + F.col("kept") - F.col("__above")).cast("bigint").alias("src_row"), "cells",
    )
    return Delimited(tables.drop("__above"), cells, rejected)


def scan_delimited(spark: SparkSession, requests: DataFrame, paths) -> tuple[DataFrame, DataFrame]:
    """(tables, cells) of ``read_delimited``."""
    read = read_delimited(spark, requests, paths)
    return read.tables, read.cells
