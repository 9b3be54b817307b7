"""Contract mapping: dirty headers to target columns and types, many contracts in one plan.

A contract is one row of ``contracts``::

    file_seq_id, column_details ARRAY<STRUCT<columnName, columnType>>,
    positions ARRAY<STRUCT<source_column, source_display_column, field_type>>,
    fetch_by_name BOOLEAN, by_column_number BOOLEAN,
    include_exclude ARRAY<STRING>, is_exclude BOOLEAN

Headers and contracts are short lists, so a table is mapped inside its own row with array expressions:
no explode, no shuffle of headers. The result is ``mapping ARRAY<STRUCT<pos, header, target, type, keep,
mapped>>``, one entry per source column.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import header_key, let

DETAILS_TYPE = "array<struct<columnName:string,columnType:string>>"
POSITIONS_TYPE = "array<struct<source_column:string,source_display_column:string,field_type:string>>"


def _or_empty(name: str, type_name: str) -> Column:
    return F.coalesce(F.col(name), F.array().cast(type_name))


def with_lookup(contracts: DataFrame) -> DataFrame:
    """Add ``aliases`` (key, target; later entries win) and ``types`` (name, type; contract before position)."""
    details = _or_empty("column_details", DETAILS_TYPE)
    positions = _or_empty("positions", POSITIONS_TYPE)

    def alias(header, target):
        return F.struct(header_key(header).alias("key"), target.alias("target"))

    def of_position(p):
        source = alias(p["source_column"], p["source_column"])
        shown = F.coalesce(p["source_display_column"], F.lit("")) != ""
        return F.when(
            shown, F.array(source, alias(p["source_display_column"], p["source_column"]))
        ).otherwise(F.array(source))

    def typed(name, kind):
        return F.struct(name.alias("name"), F.lower(kind).alias("type"))

    declared = F.transform(
        details, lambda c: typed(c["columnName"], F.coalesce(c["columnType"], F.lit("varchar")))
    )
    extra = F.transform(
        F.filter(positions, lambda p: F.coalesce(p["field_type"], F.lit("")) != ""),
        lambda p: typed(p["source_column"], p["field_type"]),
    )
    return contracts.withColumns(
        {
            "column_details": details,
            "positions": positions,
            "aliases": F.concat(
                F.transform(details, lambda c: alias(c["columnName"], c["columnName"])),
                F.flatten(F.transform(positions, of_position)),
            ),
            # looked up front to back: the last contract entry, then the first position entry
            "types": F.concat(F.reverse(declared), extra),
        }
    )


def type_of(types: Column, name: Column) -> Column:
    return F.get(F.filter(types, lambda t: t["name"] == name), F.lit(0))["type"]


def _target(aliases: Column, key: Column, pos: Column) -> Column:
    hit = F.get(F.reverse(F.filter(aliases, lambda a: a["key"] == key)), F.lit(0))["target"]
    generated = F.concat(F.lit("col_"), (pos + 1).cast("string"))
    return F.coalesce(F.nullif(hit, F.lit("")), F.nullif(key, F.lit("")), generated)


def map_headers(tables: DataFrame, contracts: DataFrame) -> DataFrame:
    """Add ``mapping`` to each table (columns of ``tables`` plus the looked-up contract)."""
    joined = tables.join(with_lookup(contracts), ["file_seq_id"], "left")
    # few contracts put many tables into few tasks, and such rows compress so well that their bytes do not tell
    joined = joined.repartition(tables.sparkSession.sparkContext.defaultParallelism)
    by_position = (F.col("fetch_by_name") == F.lit(False)) | F.coalesce(F.col("by_column_number"), F.lit(False))

    def positional(details, pos):
        return F.coalesce(F.get(details, pos)["columnName"], F.concat(F.lit("col_"), (pos + 1).cast("string")))

    def earlier(names, name, i):
        return F.size(F.filter(F.slice(names, F.lit(1), i), lambda m: m == name))

    # a repeated name gets _1, _2, ...; the generated name is not registered, so it may collide
    def unique(names):
        return F.transform(names, lambda n, i: let(
            earlier(names, n, i), lambda before: F.when(before == 0, n).otherwise(F.concat(n, F.lit("_"), before.cast("string")))))

    def keep(listed, name):
        return (F.size(listed) == 0) | (
            F.array_contains(listed, name) != F.coalesce(F.col("is_exclude"), F.lit(False))
        )

    def entries(names, keys, aliases, types, listed):
        return F.transform(
            names,
            lambda n, i: F.struct(
                i.alias("pos"),
                F.get("headers", i).alias("header"),
                n.alias("target"),
                F.coalesce(type_of(types, n), F.lit("varchar")).alias("type"),
                keep(listed, n).alias("keep"),
                let(F.get(keys, i), lambda key: F.exists(aliases, lambda a: a["key"] == key)).alias("mapped"),
            ),
        )

    def of_keys(keys, aliases):
        names = F.transform(
            keys,
            lambda key, i: F.when(F.coalesce(by_position, F.lit(False)), positional(F.col("column_details"), i)).otherwise(
                _target(aliases, key, i)
            ),
        )
        listed = F.coalesce(F.col("include_exclude"), F.array().cast("array<string>"))
        return let(names, lambda ns: let(unique(ns), lambda us: let(
            F.col("types"), lambda types: let(listed, lambda chosen: entries(us, keys, aliases, types, chosen)))))

    # Spark copies expressions to where they are read, also into lambdas and into filters it infers. Everything that is
    # read more than once is bound here, so that it is worked out once for a table and not once for each header.
    mapping = let(F.transform("headers", header_key), lambda keys: let(F.col("aliases"), lambda aliases: of_keys(keys, aliases)))
    return joined.withColumn("mapping", mapping)


def contract_drift(contracts: DataFrame) -> DataFrame:
    """Positions whose source column is missing from the contract; nothing when either side is empty."""
    missing = F.filter(
        "positions",
        lambda p: ~F.exists("column_details", lambda c: c["columnName"] == p["source_column"]),
    )
    return (
        with_lookup(contracts)
        .filter(F.size("column_details") > 0)
        .select("file_seq_id", F.explode(missing).alias("p"))
        .select(
            "file_seq_id",
            F.lit("contract_drift").alias("kind"),
            F.concat(
                F.lit("the contract has a position but no detail for column '"),
                F.col("p.source_column"),
                F.lit("'"),
            ).alias("detail"),
        )
    )


def unmapped_headers(mapped: DataFrame) -> DataFrame:
    """One warning for each header of a table that no alias knows (also in position mode)."""
    unknown = F.filter("mapping", lambda m: ~m["mapped"])
    return (
        mapped.filter(F.size("aliases") > 0)
        # the outer form, as for the other Spark infers a filter that maps every header a second time
        .select("file_seq_id", F.explode_outer(unknown).alias("m"))
        .filter(F.col("m").isNotNull())
        .select(
            "file_seq_id",
            F.lit("unmapped_headers").alias("kind"),
            F.concat(F.lit("no column of the contract for header '"), F.coalesce("m.header", F.lit("")), F.lit("'")).alias("detail"),
        )
    )


def resolve_options(
    requests: DataFrame, defaults: DataFrame, keys: list[str], options: list[str], nested: tuple[str, ...] = ()
) -> DataFrame:
    """Per-request options over the configured ones: the request's value wins, field by field.

    Options in ``nested`` are JSON texts, merged level by level (:func:`merge_options`).
    """
    names = [*options, *nested]
    base = defaults.select(*keys, *(F.col(o).alias(f"__{o}") for o in names))
    joined = requests.join(base, keys, "left")
    if nested:  # few keys put many requests into few tasks, and merging JSON is the work
        joined = joined.repartition(requests.sparkSession.sparkContext.defaultParallelism)
    values = {o: F.coalesce(F.col(o), F.col(f"__{o}")) for o in options}
    values |= {o: merge_options(F.col(f"__{o}"), F.col(o)) for o in nested}
    return joined.withColumns(values).drop(*(f"__{o}" for o in names))


#: Levels of nested options that are merged; below, the request's value replaces the whole.
OPTION_LEVELS = 8


def merge_options(base: Column, overrides: Column, levels: int = OPTION_LEVELS) -> Column:
    """JSON text of nested options: the request's over the configured ones, level by level.

    Where both have an object under a name, the two are merged; anything else the request says, null and lists too,
    replaces what was there. No overrides, or none that are an object, leave ``base``. Names come out sorted.
    """
    kind = "map<string,variant>"

    def fields(v: Column) -> Column:
        return F.try_variant_get(v, "$", kind)

    def is_object(v: Column) -> Column:
        return F.coalesce(F.schema_of_variant(v).startswith("OBJECT"), F.lit(False))

    def as_variant(m: Column) -> Column:
        return F.parse_json(F.to_json(m, {"ignoreNullFields": "false"}))

    def merged(a: Column, b: Column, left: int) -> Column:
        def value(k: Column, x: Column, y: Column) -> Column:
            chosen = F.when(~F.map_contains_key(b, k), x)
            if left > 1:
                chosen = chosen.when(is_object(x) & is_object(y), merged(fields(x), fields(y), left - 1))
            return chosen.otherwise(y)

        return as_variant(F.map_zip_with(a, b, value))

    a, b = F.try_parse_json(base), F.try_parse_json(overrides)
    return F.to_json(F.when(~is_object(b), a).when(~is_object(a), b).otherwise(merged(fields(a), fields(b), levels)))
