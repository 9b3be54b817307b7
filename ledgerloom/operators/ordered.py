"""Order-dependent columns (carry, running count, neighbour) that survive a huge group.

Repairing tables and reading statements needs, for each row, values of the rows before it in the same
file. A plain window per file does that with one exchange and one sort, but puts a whole file on one task.
:class:`OrderedRows` therefore looks at the sizes first:

* groups of ordinary size: plain windows partitioned by the group;
* a group above ``block_rows`` is set apart and split into blocks of about that many rows at evenly spaced
  places of its whole order tuple. Windows run per block, each block is reduced to one summary row, the
  summaries (one row per block) are scanned, and what a block inherits from the blocks before it is joined
  back. Only the rows of such groups are checkpointed, so that passes do not multiply.

Both ways give the same columns; a large group changes nothing for the others.
"""
from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut

BLOCK_ROWS = 1_000_000
#: Order tuples looked at for each block of a large group.
SAMPLED = 64
_BLOCK = "__blk"


@dataclass(frozen=True)
class Carry:
    """One order-dependent column.

    ``last``: latest non-null value so far; ``first``: earliest non-null value so far; ``sum``: running
    total; ``prev`` / ``next``: value of the neighbouring row. ``inclusive`` tells whether the row itself
    counts (it never does for the neighbours).
    """

    kind: str
    value: Column
    inclusive: bool = True


def last(value: Column, inclusive: bool = True) -> Carry:
    return Carry("last", value, inclusive)


def first(value: Column) -> Carry:
    return Carry("first", value)


def running(value: Column, inclusive: bool = True) -> Carry:
    return Carry("sum", value, inclusive)


def previous(value: Column) -> Carry:
    return Carry("prev", value, False)


def following(value: Column) -> Carry:
    return Carry("next", value, False)


@dataclass(frozen=True)
class OrderedRows:
    """``df`` holds the groups of ordinary size, ``hot`` the rows of large groups with their block, if there are any."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    hot: DataFrame | None = None

    @property
    def split(self) -> bool:
        return self.hot is not None

    @staticmethod
    def of(
        df: DataFrame, keys, order, block_rows: int = BLOCK_ROWS, size_of: DataFrame | None = None
    ) -> "OrderedRows":
        """Order ``df`` by ``order`` within ``keys``; groups above ``block_rows`` rows are split.

        ``size_of`` may name a cheaper frame whose groups are at least as large as those of ``df``; where it has a column
        ``__rows``, that is how many rows one of its rows stands for, and groups it lacks are of ordinary size.
        """
        keys, order = tuple(keys), tuple(order)
        counted = df if size_of is None else size_of
        size = F.sum("__rows") if "__rows" in counted.columns else F.count(F.lit(1))
        sizes = counted.groupBy(*keys).agg(size.alias("__n"))
        large = sizes.filter(F.col("__n") > block_rows)
        if large.isEmpty():
            return OrderedRows(df, keys, order)
        # a row per large group and a place per block are few by what they are; joined by a sort, a group would be one task
        large = F.broadcast(cut(large.withColumn("__parts", F.floor(F.col("__n") / block_rows) + 1)))
        place = F.struct(*order)
        # the hash of a row's place decides whether it is looked at, so that every evaluation sees the same ones
        seen = df.join(large, [df[k].eqNullSafe(large[k]) for k in keys]).filter(
            F.pmod(F.xxhash64(*(df[o] for o in order)), F.col("__n")) < SAMPLED * F.col("__parts")
        ).select(*(df[k] for k in keys), F.struct(*(df[o] for o in order)).alias("__at"), "__parts")
        bounds = seen.groupBy(*keys).agg(F.sort_array(F.collect_list("__at")).alias("__seen"), F.max("__parts").alias("__parts"))
        step = F.size("__seen") / (F.col("__parts") + 1)
        bounds = F.broadcast(cut(bounds.select(*keys, F.transform(
            F.sequence(F.lit(1), F.col("__parts")), lambda i: F.get("__seen", F.floor(i * step).cast("int"))).alias("__bounds"))))
        apart = [df[k].eqNullSafe(large[k]) for k in keys]
        hot = df.join(large, apart, "left_semi")
        hot = hot.join(bounds, [hot[k].eqNullSafe(bounds[k]) for k in keys], "left").select(*(hot[c] for c in df.columns), "__bounds")
        block = F.coalesce(F.size(F.filter("__bounds", lambda b: b < place)), F.lit(0))
        hot = cut(hot.withColumn(_BLOCK, block).drop("__bounds"))
        return OrderedRows(df.join(large, apart, "left_anti"), keys, order, hot)

    # ------------------------------------------------------------------------------------------------
    def select(self, *columns) -> "OrderedRows":
        hot = None if self.hot is None else self.hot.select(*columns, _BLOCK)
        return replace(self, df=self.df.select(*columns), hot=hot)

    def with_columns(self, **columns: Column) -> "OrderedRows":
        hot = None if self.hot is None else self.hot.withColumns(columns)
        return replace(self, df=self.df.withColumns(columns), hot=hot)

    def carry(self, **carries: Carry) -> "OrderedRows":
        """Add one column per carry; all of them see only columns that exist already."""
        plain = self._local(self.df, carries, self.keys)
        return replace(self, df=plain, hot=None if self.hot is None else self._carry_blocks(carries))

    def _carry_blocks(self, carries: dict[str, Carry]) -> DataFrame:
        ord_ = F.struct(*self.order)
        keys = list(self.keys)
        inputs = self.hot.withColumns({f"__in_{n}": c.value for n, c in carries.items()})
        local = self._local(
            inputs, {n: replace(c, value=F.col(f"__in_{n}")) for n, c in carries.items()}, (*keys, _BLOCK)
        )
        # one summary row per block
        aggregates = []
        for name, c in carries.items():
            v = F.col(f"__in_{name}")
            boxed = F.struct(v.alias("v"))
            known = F.when(v.isNotNull(), ord_)
            aggregates.append(
                {
                    "last": lambda: F.max_by(boxed, known),
                    "first": lambda: F.min_by(boxed, known),
                    "sum": lambda: F.sum(v),
                    "prev": lambda: F.max_by(boxed, ord_),
                    "next": lambda: F.min_by(boxed, ord_),
                }[c.kind]().alias(f"__sum_{name}")
            )
        summary = inputs.groupBy(*keys, _BLOCK).agg(*aggregates)
        w = Window.partitionBy(*keys).orderBy(_BLOCK)
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        seeds = summary.select(
            *keys,
            _BLOCK,
            *(
                {
                    "last": lambda n: F.last(f"__sum_{n}", ignorenulls=True).over(before),
                    "first": lambda n: F.first(f"__sum_{n}", ignorenulls=True).over(before),
                    "sum": lambda n: F.sum(f"__sum_{n}").over(before),
                    "prev": lambda n: F.lag(f"__sum_{n}").over(w),
                    "next": lambda n: F.lead(f"__sum_{n}").over(w),
                }[c.kind](n).alias(f"__seed_{n}")
                for n, c in carries.items()
            ),
        )
        names = local.columns
        on = [local[k].eqNullSafe(seeds[k]) for k in (*keys, _BLOCK)]
        joined = local.join(seeds, on, "left").select(*(local[c] for c in names), *(f"__seed_{n}" for n in carries))
        edge = Window.partitionBy(*keys, _BLOCK).orderBy(*self.order)
        if any(c.kind in ("prev", "next") for c in carries.values()):
            joined = joined.withColumns(
                {
                    "__edge_first": F.row_number().over(edge) == 1,
                    "__edge_last": F.lead(F.lit(1)).over(edge).isNull(),
                }
            )
        final = {}
        for n, c in carries.items():
            seed = F.col(f"__seed_{n}")
            mine = F.col(n)
            if c.kind == "last":
                final[n] = F.coalesce(mine, seed["v"])
            elif c.kind == "first":
                final[n] = F.coalesce(seed["v"], mine)
            elif c.kind == "sum":
                final[n] = F.when(
                    mine.isNotNull() | seed.isNotNull(), F.coalesce(mine, F.lit(0)) + F.coalesce(seed, F.lit(0))
                )
            elif c.kind == "prev":
                final[n] = F.when(F.col("__edge_first"), seed["v"]).otherwise(mine)
            else:
                final[n] = F.when(F.col("__edge_last"), seed["v"]).otherwise(mine)
        done = joined.withColumns(final)
        scratch = [x for x in done.columns if x.startswith(("__in_", "__seed_", "__edge_"))]
        return cut(done.drop(*scratch))

    def number(self, name: str) -> "OrderedRows":
        """1-based row number within the group."""
        return self.carry(**{name: running(F.lit(1).cast("bigint"))})

    def rows(self) -> DataFrame:
        return self.df if self.hot is None else self.df.unionByName(self.hot.drop(_BLOCK))

    # ------------------------------------------------------------------------------------------------
    def _local(self, df: DataFrame, carries: dict[str, Carry], partition) -> DataFrame:
        w = Window.partitionBy(*partition).orderBy(*self.order)
        upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        out = {}
        for name, c in carries.items():
            frame = upto if c.inclusive else before
            if c.kind == "last":
                out[name] = F.last(c.value, ignorenulls=True).over(frame)
            elif c.kind == "first":
                out[name] = F.first(c.value, ignorenulls=True).over(frame)
            elif c.kind == "sum":
                out[name] = F.sum(c.value).over(frame)
            elif c.kind == "prev":
                out[name] = F.lag(c.value).over(w)
            else:
                out[name] = F.lead(c.value).over(w)
        return df.withColumns(out)
