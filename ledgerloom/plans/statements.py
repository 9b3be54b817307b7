"""Driver queries: statements rendered from orders and line items, read back and checked."""
from __future__ import annotations

from pyspark.sql import Window, functions as F

from ..functions.money import dbcr_by_sign, sign_label
from ..operators.ordered import BLOCK_ROWS, OrderedRows, first, last, previous, running
from ..operators.statement import read_statements, reference_of, tags_of, value_date
from ..operators.txn_table import read_transaction_tables
from ..operators.validate import (
    account_day_checks,
    drop_failed,
    run_summary as summary_of,
    transaction_checks,
    unparsed_report as report_of,
    warning_table,
)
from ..sources.profiles import BankProfile, TableProfile, detect_profile as detect
from ..session import write_once
from .common import money2, printed, table, text

BANK = BankProfile()
ORDER = ("page", "o_orderkey", "step", "k1", "k2", "k3", "k4", "part")
#: Lines that are rendered and read by one task.
TASK_LINES = 50_000


# --- rendering -----------------------------------------------------------------------------------------
def _word(x0, value):
    return F.struct(F.lit(x0).cast("double").alias("x0"), value.alias("text"))


def _row(step, words, k=(0, 0, 0, 0), part=0):
    """One rendered row; ``k`` orders rows of one step, ``part`` the rows of one transaction."""
    return F.struct(
        F.lit(step).alias("step"),
        *(F.lit(v).cast("bigint").alias(f"k{i + 1}") if isinstance(v, int) else v.cast("bigint").alias(f"k{i + 1}") for i, v in enumerate(k)),
        F.lit(part).alias("part"),
        F.array(*words).alias("words"),
    )


def _rows(df, *rows):
    listed = F.filter(F.array(*rows), lambda r: r.isNotNull())
    return df.select("o_custkey", "page", "o_orderkey", F.explode(listed).alias("r")).select(
        F.col("o_custkey").alias("file_id"), "page", "o_orderkey", "r.*"
    )


def _printed(lines, printed_rows):
    """The rows each line prints. They are put into a column first: an explode alone would interpret their expressions."""
    printed_by = lines.select(F.col("o_custkey").alias("file_id"), "page", F.array_compact(F.array(*printed_rows)).alias("rs"))
    return printed_by.select("file_id", "page", F.explode("rs").alias("r")).select("file_id", "page", "r.row_no", "r.words")


def _lines(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("d"))
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_linestatus", money2(F.col("l_extendedprice")).alias("price")
    )
    page = F.datediff(F.col("d"), F.lit("1990-01-01").cast("date")).alias("page")
    return li.join(o, F.col("l_orderkey") == F.col("o_orderkey")).select("*", page).drop("l_orderkey")


def statement_rows(lines, altered=False):
    """Statement rows: one file per customer, one page per day, one repeated header per order of that day.

    With ``altered``, the credit control amount of every customer divisible by 10 and the closing balance of
    every customer divisible by 7 are wrong on purpose.

    The slim lines move once, by page, and are sorted there; each then prints its own rows and the headings and totals
    that stand before or after it. Rows are numbered by what the lines before print, so no rendered row is sorted.
    """
    credit = F.col("l_linestatus") == "O"
    lines = lines.withColumns({"__section": F.when(credit, 11).when(~credit, 21), "__cents": (F.col("price") * 100).cast("bigint")})
    item = ["__section", "l_linenumber", "l_partkey", "l_suppkey", "__cents"]
    in_order = Window.partitionBy("o_custkey", "page", "o_orderkey").orderBy(*item)
    on_page = Window.partitionBy("o_custkey", "page").orderBy("o_orderkey", *item)  # bounded by what a page holds
    whole_page = on_page.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    section, before = F.col("__section"), F.lag("__section").over(in_order)
    at, peers = F.row_number().over(in_order), in_order.rangeBetween(Window.currentRow, Window.currentRow)
    seen = lines.withColumns(
        {
            "__order": at == 1,
            "__memo": (at == 1) & (F.col("o_orderkey") % 11 == 0),
            "__credits": (section == 11) & ~before.eqNullSafe(F.lit(11)),
            "__debits": (section == 21) & ~before.eqNullSafe(F.lit(21)),
            # equal lines print all their first rows before their second ones
            "__nth": at - F.rank().over(in_order), "__equal": F.count(F.lit(1)).over(peers),
        }
    )
    flag = {x: F.coalesce(F.col(f"__{x}"), F.lit(False)).cast("int") for x in ("order", "memo", "credits", "debits", "page")}
    own = F.when(section.isNotNull(), 2).otherwise(0)
    headings = 2 * flag["order"] + flag["memo"] + 3 * flag["page"] + flag["credits"] + flag["debits"]
    seen = seen.withColumns(
        {
            "__page": F.row_number().over(on_page) == 1,
            "__last": F.lead(F.lit(1)).over(on_page).isNull(),
            **{n: F.coalesce(F.sum(F.when(c, F.col("price"))).over(whole_page), F.lit(0)).cast("decimal(18,2)") for n, c in (("credits", credit), ("debits", ~credit))},
            **{n: F.count(F.when(c, 1)).over(whole_page) for n, c in (("n_cr", credit), ("n_db", ~credit))},
        }
    ).withColumn("__headings", headings)
    seen = seen.withColumn("__before", F.coalesce(F.sum(F.col("__headings") + own).over(on_page.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))

    day = F.date_format("d", "MMMM d, yyyy")
    account = F.lpad(text(F.col("o_custkey")), 8, "0")
    named = F.concat(F.lit("Customer"), text(F.col("o_custkey")))
    first_seen = F.col("o_orderkey") % 2 == 0  # the currency is printed on some headers only
    header = F.concat(
        F.lit("BANK: NTRS "), named, F.lit(" ACCOUNT: "), account, F.when(first_seen, " USD").otherwise("")
    )
    wrong = lambda n: F.when(F.lit(altered) & (F.col("o_custkey") % n == 0), F.lit(1)).otherwise(F.lit(0))
    opening = (F.lit(1000) + F.col("o_custkey") % 100).cast("decimal(18,2)")
    closing = (opening + F.col("credits") - F.col("debits") + wrong(7)).cast("decimal(18,2)")
    balance = F.when(closing < 0, F.concat(F.lit("("), F.format_number(-closing, 2), F.lit(")"))).otherwise(
        F.format_number(closing, 2)
    )
    control = F.col("credits") + wrong(10)
    code = text(F.when(credit, F.lit(100)).otherwise(400) + F.col("l_partkey") % 300)
    shown = F.format_number("price", 2)
    right = F.col("l_partkey") % 2 == 1  # the amount stands on the code row or on the row below
    about = _word(0.1, F.concat(F.lit("Part "), text(F.col("l_partkey")), F.lit(" TRN"), F.lpad(text(F.col("o_orderkey")), 10, "0")))
    more = _word(
        0.1,
        F.concat(
            F.lit("ORG=S"), text(F.col("l_suppkey")), F.lit(" BNF=C"), text(F.col("o_custkey")),
            F.when(
                F.col("l_linenumber") == 3,
                F.concat(F.lit(" Value Date Of "), F.date_format(F.date_add("d", 1), "MM-dd-yyyy")),
            ).otherwise(""),
        ),
    )
    amount = _word(0.85, shown)

    def row(place, words):
        return F.struct((F.col("__before") + place).cast("bigint").alias("row_no"), words.alias("words"))

    order, memo, page, heads = F.col("__order"), flag["memo"], F.col("__page"), F.col("__headings")
    opened, end = 2 * flag["order"] + memo, heads + own
    nth, equal = F.col("__nth"), F.col("__equal")
    some_cr, some_db = F.col("__last") & (F.col("n_cr") > 0), F.col("__last") & (F.col("n_db") > 0)
    debits_at = end + F.when(F.col("n_cr") > 0, 2).otherwise(0)
    printed_rows = [
        F.when(order, row(F.lit(1), F.array(_word(0.1, day)))),
        F.when(order, row(F.lit(2), F.array(_word(0.1, header)))),
        F.when(memo == 1, row(F.lit(3), F.array(_word(0.1, F.concat(F.lit("Memo "), text(F.col("o_orderkey"))))))),
        F.when(page, row(opened + 1, F.array(_word(0.05, F.concat(F.lit("010 OPENING LEDGER BALANCE "), F.format_number(opening, 2)))))),
        F.when(page, row(opened + 2, F.array(_word(0.05, F.lit("015 CLOSING LEDGER BALANCE")), _word(0.85, balance)))),
        F.when(page, row(opened + 3, F.array(_word(0.05, F.concat(F.lit("100 TOTAL CREDITS "), F.format_number("credits", 2)))))),
        F.when(flag["credits"] == 1, row(heads, F.array(_word(0.3, F.lit("ACCOUNT CREDITS"))))),
        F.when(flag["debits"] == 1, row(heads, F.array(_word(0.3, F.lit("ACCOUNT DEBITS"))))),
        F.when(section.isNotNull(), row(heads + 1 - nth, F.when(right, F.array(_word(0.05, code), about, amount)).otherwise(F.array(_word(0.05, code), about)))),
        F.when(section.isNotNull(), row(heads + 1 - nth + equal, F.when(~right, F.array(more, amount)).otherwise(F.array(more)))),
        F.when(some_cr, row(end + 1, F.array(_word(0.1, F.lit("TOTALS FOR ACCOUNT:"))))),
        F.when(some_cr, row(end + 2, F.array(_word(0.1, F.concat(F.lit("CREDIT COUNT: "), text(F.col("n_cr")))), _word(0.85, F.format_number(control, 2))))),
        F.when(some_db, row(debits_at + 1, F.array(_word(0.1, F.concat(F.lit("TOTALS FOR ACCOUNT: DEBIT COUNT: "), text(F.col("n_db"))))))),
        F.when(some_db, row(debits_at + 2, F.array(_word(0.5, F.format_number("debits", 2))))),
    ]
    return _printed(seen, printed_rows)


def _placed(rows):
    """Rendered rows as the input table of a parser: a row number on each page instead of the rendering order."""
    page = Window.partitionBy("file_id", "page").orderBy(*ORDER[1:])  # bounded by what a page holds
    return rows.select("file_id", "page", F.row_number().over(page).cast("bigint").alias("row_no"), "words")


def _large_files(spark, sf_dir):
    """Files that may print more than a block of rows, with the most they may print, from their lines and orders."""
    printed_rows = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg((3 * F.count(F.lit(1)) + 11).alias("__rows"))
    sizes = printed_rows.join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return sizes.groupBy(F.col("o_custkey").alias("file_id")).agg(F.sum("__rows").alias("__rows")).filter(F.col("__rows") > BLOCK_ROWS)


def _read(spark, sf_dir, altered=False):
    """The statements, read from rendered rows.

    The slim lines of a file come together before they are rendered, so that its rows are read where they are printed and
    neither move nor are written. Where files are too large for a task, lines come together by page instead, and the rendered
    rows are written, as such files are read in several passes.
    """
    lines, large = _lines(spark, sf_dir), write_once(_large_files(spark, sf_dir), "large-files")
    if large.isEmpty():
        # a slim line prints several rows with their texts, so tasks are cut by lines, not by the bytes that move
        tasks = max(spark.sparkContext.defaultParallelism, table(spark, sf_dir, "lineitem").count() // TASK_LINES + 1)
        return read_statements(statement_rows(lines.repartition(tasks, "o_custkey"), altered), BANK, size_of=large)
    return read_statements(write_once(statement_rows(lines, altered), "statement_rows"), BANK)


def statement_end_to_end(spark, sf_dir):
    t = _read(spark, sf_dir).transactions
    tags = F.col("tags")
    return t.select(
        "file_id", "posting_date", "bank", "account_number", "account_name", "currency", "seq", "type_code", "section",
        "dbcr", text(F.col("amount")).alias("amount"), "reference", "value_date", "description", "page",
        text(F.col("opening_ledger")).alias("opening_ledger"), text(F.col("closing_ledger")).alias("closing_ledger"),
        "closing_ledger_dbcr", F.array_join(tags["ORG"], ",").alias("org"), F.array_join(tags["BNF"], ",").alias("bnf"),
    )


def statement_days(spark, sf_dir):
    """Every account-day with its totals (balance records in mode ``all``)."""
    s = _read(spark, sf_dir).account_days
    return s.select(
        "file_id", "posting_date", "account_number", "currency",
        *(text(F.col(c)).alias(c) for c in ("total_credits", "total_debits", "opening_ledger", "closing_ledger")),
        "credit_count", "debit_count", "opening_ledger_dbcr",
    )


def control_totals(spark, sf_dir):
    checks = _read(spark, sf_dir, altered=True).checks.filter("check <> 'type_direction'")
    return checks.select("file_id", "posting_date", "check", "kind", "stated", "parsed", "ok", "counted")


def run_summary(spark, sf_dir):
    s = _read(spark, sf_dir, altered=True)
    return summary_of(s.checks, s.unparsed)


def unparsed_report(spark, sf_dir):
    s = _read(spark, sf_dir, altered=True)
    failed = s.checks.filter("check = 'balance_roll' and not ok").select(
        "file_id", F.lit("validation").alias("kind"), F.lit(0).cast("bigint").alias("rank"),
        F.concat(F.lit("VALIDATION: "), "detail").alias("detail"),
    )
    report = report_of(s.unparsed)
    return warning_table(report.limit(0), failed.unionByName(report)).select("file_id", "kind", "rank", "detail", "source_ord")


def strict_files(spark, sf_dir):
    """Transactions per file when a failed check aborts the file."""
    s = _read(spark, sf_dir, altered=True)
    kept = drop_failed(s.transactions, s.checks, BankProfile(fail_on_error=True))
    return kept.groupBy("file_id").agg(F.count(F.lit(1)).alias("n"), text(F.sum("amount")).alias("total"))


def _brokerage_lines(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag",
        money2(F.col("l_extendedprice")).alias("price"), F.col("l_shipdate").cast("date").alias("d"),
    ).withColumns(
        {
            "o_custkey": F.concat(F.lit("S"), text(F.col("l_suppkey")), F.lit("-"), F.date_format("d", "yyyyMM")),
            "page": F.dayofmonth("d") + 1,
            "o_orderkey": F.col("l_orderkey"),
        }
    )


def _brokerage_edges(li):
    """First and last page of a file, which hold no line items."""
    last_day = F.date_format(F.last_day("d"), "d")
    files = li.select(
        "o_custkey", F.lit(1).alias("page"), F.lit(0).cast("bigint").alias("o_orderkey"), "l_suppkey",
        F.date_format("d", "MMMM").alias("m"), last_day.alias("e"), F.date_format("d", "yyyy").alias("y"),
    ).distinct()
    first_page = _rows(
        files,
        _row(0, [_word(0.1, F.lit("Charles Schwab One")), _word(0.7, F.concat(F.lit("1234-"), F.lpad(text(F.col("l_suppkey") % 10000), 4, "0")))]),
        _row(1, [_word(0.7, F.concat("m", F.lit(" 1-"), "e", F.lit(", "), "y"))]),
        _row(2, [_word(0.02, F.lit("Transactions - Summary"))]),
        _row(3, [_word(0.02, F.lit("Beginning")), _word(0.86, F.lit("Ending"))]),
        _row(4, [_word(0.05, F.lit("$1,000.25")), _word(0.3, F.lit("7.00")), _word(0.9, F.lit("(2,000.50)"))]),
        _row(5, [_word(0.02, F.lit("Transaction Details"))]),
        _row(6, [_word(0.02, F.lit("Date")), _word(0.06, F.lit("Category")), _word(0.12, F.lit("Action"))]),
    )
    ends = _rows(
        files.withColumns({"page": F.lit(40), "o_orderkey": F.lit(0).cast("bigint")}),
        _row(1, [_word(0.02, F.lit("Transaction Details (continued)"))]),
        _row(2, [_word(0.02, F.lit("Total Transactions")), _word(0.8, F.lit("55.00"))]),
        _row(3, [_word(0.06, F.lit("Other")), _word(0.8, F.lit("77.00"))]),
    )
    return _placed(first_page.unionByName(ends))


def _brokerage_days(li):
    """A page per day: its headings at order key -1, then a row or more per line item.

    The slim lines move and are sorted, and print their rows afterwards; rows are numbered by what the lines before
    print. Equal lines print all their first rows before their second ones.
    """
    flag = F.coalesce("l_returnflag", F.lit(""))
    # lines without a file have pages of several dates; a row per page tells which one is printed
    days = li.groupBy("o_custkey", "page").agg(F.first("d").alias("__day"), F.max("o_custkey").alias("__file"))
    stray = days.filter(F.col("__file").isNull()).select(F.col("page").alias("__of"), "__day")
    li = li.join(F.broadcast(stray), F.col("page").eqNullSafe(F.col("__of")) & F.col("o_custkey").isNull(), "left").drop("__of")
    dated = F.when(F.col("o_custkey").isNull(), F.col("__day")).otherwise(F.col("d"))
    li = li.withColumns({"__cents": (F.col("price") * 100).cast("bigint"), "__0": (flag == "A").cast("int"), "__1": F.lit(1), "__2": flag.isin("R", "N").cast("int")})
    on_page = Window.partitionBy("o_custkey", "page").orderBy("o_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "__cents")  # bounded by what a page holds
    start, here, end = Window.unboundedPreceding, Window.currentRow, Window.unboundedFollowing
    early = F.col("o_orderkey").isNull() | (F.col("o_orderkey") < -1)
    rows = F.col("__0") + F.col("__1") + F.col("__2")
    peers, before = on_page.rangeBetween(here, here), {}
    for p in ("__0", "__1", "__2"):
        equal = F.sum(p).over(peers)
        before[f"{p}_equal"] = equal
        before[f"{p}_nth"] = F.sum(p).over(on_page.rowsBetween(start, here)) - F.sum(p).over(on_page.rangeBetween(start, here)) + equal
    seen = li.withColumns(
        {
            **before, "__first": F.row_number().over(on_page) == 1,
            "__before": F.sum(rows).over(on_page.rangeBetween(start, here)) - F.sum(rows).over(peers) + F.when(early, 0).otherwise(3),
            "__head": F.coalesce(F.sum(F.when(early, rows)).over(on_page.rowsBetween(start, end)), F.lit(0)),
        }
    )

    def row(place, *words):
        return F.struct(place.cast("bigint").alias("row_no"), F.array(*words).alias("words"))

    head, at0 = F.col("__head"), F.col("__before") + F.col("__0_nth")
    at1 = F.col("__before") + F.col("__0_equal") + F.col("__1_nth")
    at2 = F.col("__before") + F.col("__0_equal") + F.col("__1_equal") + F.col("__2_nth")
    amount = F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.lit("("), F.format_number("price", 2), F.lit(")"))).otherwise(
        F.format_number("price", 2)
    )
    about = F.concat(F.lit("Part "), text(F.col("l_partkey")))
    symbol = F.concat(F.lit("SY"), text(F.col("l_partkey") % 50))
    printed_rows = [
        F.when(F.col("__first"), row(head + 1, _word(0.1, F.lit("Charles Schwab One")), _word(0.8, F.lit("99.99")))),
        F.when(F.col("__first"), row(head + 2, _word(0.02, F.lit("Transaction Details")), _word(0.2, F.lit("(continued)")))),
        # a dated row without amount: dropped, but its date stays in force
        F.when(F.col("__first"), row(head + 3, _word(0.02, F.date_format(dated, "MM/dd")))),
        F.when(flag == "A", row(at0, _word(0.06, F.lit("Reinvested")))),
        F.when(flag == "R", row(at1, _word(0.06, F.lit("Other")), _word(0.31, about), _word(0.8, amount)))
        .when(flag == "A", row(at1, _word(0.06, F.lit("Shares")), _word(0.22, symbol), _word(0.31, about), _word(0.8, amount)))
        .otherwise(row(at1, _word(0.06, F.lit("Sale")), _word(0.12, F.lit("Sold")), _word(0.22, symbol), _word(0.31, about))),
        F.when(flag == "R", row(at2, _word(0.06, F.lit("Activity")), _word(0.31, F.lit("**MATURED**")))),
        F.when(flag == "N", row(at2, _word(0.22, F.lit("lot")), _word(0.31, text(F.col("l_suppkey"))), _word(0.8, amount))),
    ]
    return _printed(seen, printed_rows)


def _brokerage_rows(spark, sf_dir):
    """One file per supplier and month of shipping, one page per day, a row or more per line item."""
    li = _brokerage_lines(spark, sf_dir)
    return _brokerage_edges(li).unionByName(_brokerage_days(li))


def brokerage_end_to_end(spark, sf_dir):
    rows = write_once(_brokerage_rows(spark, sf_dir), "brokerage_rows")
    t = read_transaction_tables(rows, TableProfile()).transactions
    return t.select(
        "file_id", "account_number", "statement_period", "period_start_date", "period_end_date", "currency", "seq",
        "posting_date", "category", "action", "symbol", "description", text(F.col("amount")).alias("amount"), "dbcr",
        "page", text(F.col("opening_balance")).alias("opening_balance"), text(F.col("closing_balance")).alias("closing_balance"),
    )


# --- parts on their own ------------------------------------------------------------------------------------
def carry_forward(spark, sf_dir):
    """Date and section in force at each event of a user: a sign-up prints the date, clicks and views headings."""
    e = table(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type")
    kind = F.col("event_type")
    seq = OrderedRows.of(e, ["user_id"], ["event_id"]).carry(
        day=last(F.when(kind == "signup", F.date_format("ts", "yyyy-MM-dd"))),
        section=last(F.when(kind == "signup", "").when(kind == "click", "CREDITS").when(kind == "view", "DEBITS")),
        first_error=first(F.when(kind == "error", F.col("event_id"))),
        before=previous(kind),
    )
    return seq.rows().select("event_id", "day", "section", "first_error", "before")


def account_days(spark, sf_dir):
    """Account-day sessions: account rows open one unless they repeat the open account on the same date."""
    e = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.concat(F.lit("A"), text(F.floor(F.col("value") / 20) % 2)).alias("account"),
        F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("C"), text(F.col("event_id") % 3))).alias("own_currency"),
    )
    seq = OrderedRows.of(e, ["user_id"], ["event_id"]).carry(
        __acct=previous(F.col("account")), __day=previous(F.col("day"))
    )
    opened = ~(F.col("account").eqNullSafe(F.col("__acct")) & F.col("day").eqNullSafe(F.col("__day")))
    rows = seq.with_columns(opened=opened).carry(ctx_id=running(opened.cast("bigint"))).rows()
    known = OrderedRows.of(rows, ["user_id", "account"], ["event_id"]).carry(currency=last(F.col("own_currency")))
    return known.rows().select("event_id", "ctx_id", "account", "currency", "opened")


def _islands(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value")
    starts = F.col("event_type") == "signup"
    ends = F.col("event_type") == "error"
    return OrderedRows.of(e, ["user_id"], ["event_id"]).carry(
        txn=running(starts.cast("bigint")),
        open=last(F.when(starts, F.lit(True)).when(ends, F.lit(False))),
    ).rows().filter("open")


def txn_islands(spark, sf_dir):
    """Transactions opened by a sign-up and closed by an error: members, first large amount, sequence."""
    large = F.when(F.col("value") >= 20, money2(F.col("value")))
    return _islands(spark, sf_dir).groupBy("user_id", "txn").agg(
        F.min("event_id").alias("first_event"), F.count(F.lit(1)).alias("n_lines"),
        text(F.min_by(large, F.when(large.isNotNull(), F.col("event_id")))).alias("amount"),
    )


def txn_descriptions(spark, sf_dir):
    line = F.struct("event_id", F.concat_ws(":", "event_type", text(money2(F.col("value")))).alias("t"))
    return _islands(spark, sf_dir).groupBy("user_id", "txn").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(line)), lambda x: x["t"]), " ").alias("description")
    )


def tags_and_refs(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    key = text(F.col("o_orderkey"))
    ref = F.lpad(key, 9, "0")
    described = o.select(
        "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("posting_date"),
        F.concat(
            F.lit("Wire "),
            F.when(F.col("o_orderkey") % 4 == 0, F.concat(F.lit("FUND TRF#"), ref))
            .when(F.col("o_orderkey") % 4 == 1, F.concat(F.lit("TRN"), ref))
            .when(F.col("o_orderkey") % 4 == 2, F.concat(F.lit("Our TRN Number - A"), ref))
            .otherwise("TRN12"),
            F.lit(" ORG=Acme "), F.col("o_orderpriority"), F.lit(" BNF="), text(F.col("o_custkey")),
            F.when(F.col("o_orderkey") % 3 == 0, F.lit(" ORG=Second  ID=7")).otherwise(""),
            F.when(
                F.col("o_orderkey") % 5 == 0,
                F.concat(F.lit(" Value Date Of "), F.date_format(F.date_add("o_orderdate", 2), "MM-dd-yyyy")),
            ).otherwise(""),
        ).alias("description"),
    )
    d = F.col("description")
    t = tags_of(d, BANK.tags)
    return described.select(
        "o_orderkey", reference_of(d, BANK).alias("reference"), value_date(d, F.col("posting_date"), BANK).alias("value_date"),
        F.array_join(t["ORG"], ";").alias("org"), F.array_join(t["BNF"], ";").alias("bnf"),
        F.array_join(t["ID"], ";").alias("id"),
    )


def balance_roll(spark, sf_dir):
    """Opening + credits - debits against closing, per user and day of events; some closings altered."""
    e = table(spark, sf_dir, "events").select(
        "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "event_id", money2(F.col("value")).alias("v"),
        (F.col("event_type") == "purchase").alias("debit"),
    )
    zero = F.lit(0).cast("decimal(18,2)")
    days = e.groupBy("user_id", "day").agg(
        F.sum(F.when(~F.col("debit"), F.col("v")).otherwise(zero)).cast("decimal(38,2)").alias("total_credits"),
        F.sum(F.when(F.col("debit"), F.col("v")).otherwise(zero)).cast("decimal(38,2)").alias("total_debits"),
        F.min("event_id").alias("at"),
    )
    net = (F.col("total_credits") - F.col("total_debits")).cast("decimal(38,2)")
    rolled = OrderedRows.of(days, ["user_id"], ["at"]).carry(
        __before=running(net, inclusive=False)
    ).with_columns(opening_ledger=F.coalesce("__before", F.lit(0)).cast("decimal(38,2)")).rows()
    closing = (F.col("opening_ledger") + net + F.when(F.col("at") % 7 == 0, 1).otherwise(0)).cast("decimal(38,2)")
    table_ = rolled.select(
        F.col("user_id").alias("file_id"), F.col("at").alias("ctx_id"), F.col("day").alias("posting_date"),
        text(F.col("user_id")).alias("account_number"), F.lit("USD").alias("currency"), "opening_ledger",
        closing.alias("closing_ledger"), "total_credits", "total_debits",
    )
    checks = account_day_checks(table_, BankProfile(control_totals=False))
    return checks.select(
        "file_id", "posting_date", "stated", "parsed", "ok",
        sign_label(F.col("stated").cast("decimal(38,2)")).alias("label"),
        dbcr_by_sign(F.col("parsed").cast("decimal(38,2)"), "DB", "CR").alias("dbcr"),
    )


def code_direction(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    t = li.select(
        F.col("l_orderkey").alias("file_id"), F.col("l_linenumber").alias("ctx_id"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("posting_date"), text(F.col("l_suppkey")).alias("account_number"),
        text(F.col("l_partkey") % 700 + 100).alias("type_code"),
        F.when(F.col("l_linestatus") == "O", "CREDITS").otherwise("DEBITS").alias("section"),
        F.when(F.col("l_partkey") % 50 > 0, money2(F.col("l_extendedprice"))).alias("amount"),
        F.lit("x").alias("description"),
    )
    return transaction_checks(t, BANK).groupBy("file_id", "check", "kind", "ok").agg(
        F.count(F.lit(1)).alias("n"), F.min("detail").alias("detail")
    )


def no_activity_days(spark, sf_dir):
    """Days of a user, from the first to the last event, on which nothing was bought."""
    e = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("date").alias("day"), "event_type")
    span = e.groupBy("user_id").agg(F.min("day").alias("a"), F.max("day").alias("b"))
    calendar = span.select("user_id", F.explode(F.sequence("a", "b")).alias("day"))
    bought = e.filter("event_type = 'purchase'").select("user_id", "day").distinct()
    return calendar.join(bought, ["user_id", "day"], "left_anti").select(
        "user_id", F.date_format("day", "yyyy-MM-dd").alias("day")
    )


def detect_profile(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    patterns = [("bank", r"THING\s+the"), ("broker", "und die"), ("card", "q[uo]e? la")]
    return detect(d, patterns).select("doc_id", "profile")


QUERIES = {
    "statement_end_to_end": statement_end_to_end,
    "statement_days": statement_days,
    "control_totals": control_totals,
    "run_summary": run_summary,
    "unparsed_report": unparsed_report,
    "strict_files": strict_files,
    "brokerage_end_to_end": brokerage_end_to_end,
    "carry_forward": carry_forward,
    "account_days": account_days,
    "txn_islands": txn_islands,
    "txn_descriptions": txn_descriptions,
    "tags_and_refs": tags_and_refs,
    "balance_roll": balance_roll,
    "code_direction": code_direction,
    "no_activity_days": no_activity_days,
    "detect_profile": detect_profile,
}

_L = """l AS (SELECT o_custkey AS c, CAST(o_orderdate AS DATE) AS d, o_orderkey AS o, l_partkey AS p, l_suppkey AS s,
                     l_linenumber AS n, l_linestatus = 'O' AS cr, CAST(l_extendedprice AS DECIMAL(18, 2)) AS price
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""
_D = """day AS (SELECT c, d, min(o) AS o1, coalesce(sum(price) FILTER (cr), 0.00) AS credits,
                       coalesce(sum(price) FILTER (NOT cr), 0.00) AS debits,
                       count(*) FILTER (cr) AS n_cr, count(*) FILTER (NOT cr) AS n_db
                FROM l GROUP BY c, d),
       ctx AS (SELECT *, CAST(1000 + c % 100 AS DECIMAL(18, 2)) AS op,
                      CASE WHEN min(CASE WHEN o1 % 2 = 0 THEN d END) OVER (PARTITION BY c) <= d THEN 'USD'
                           WHEN EXISTS (SELECT 1 FROM l WHERE l.c = day.c AND l.o % 2 = 0 AND l.d < day.d) THEN 'USD' END AS ccy
               FROM day)"""
_ISLANDS = """
    WITH e AS (SELECT *, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER o AS txn,
                      last_value(CASE event_type WHEN 'signup' THEN true WHEN 'error' THEN false END IGNORE NULLS) OVER o AS open
               FROM events WINDOW o AS (PARTITION BY user_id ORDER BY event_id))"""
_CHECKS = f"""{_L}, {_D},
    k AS (SELECT *, credits + CASE WHEN c % 10 = 0 THEN 1 ELSE 0 END AS ctl,
                 op + credits - debits + CASE WHEN c % 7 = 0 THEN 1 ELSE 0 END AS cl, op + credits - debits AS roll FROM ctx),
    checks AS (
      SELECT c AS file_id, d, 'total_line' AS "check", 'CREDITS' AS kind, CAST(credits AS VARCHAR) AS stated,
             CAST(credits AS VARCHAR) AS parsed, true AS ok, 1 AS counted FROM k
      UNION ALL SELECT c, d, 'control_count', 'CREDITS', CAST(n_cr AS VARCHAR), CAST(n_cr AS VARCHAR), true, 1 FROM k WHERE n_cr > 0
      UNION ALL SELECT c, d, 'control_count', 'DEBITS', CAST(n_db AS VARCHAR), CAST(n_db AS VARCHAR), true, 1 FROM k WHERE n_db > 0
      UNION ALL SELECT c, d, 'control_amount', 'CREDITS', CAST(ctl AS VARCHAR), CAST(credits AS VARCHAR), ctl = credits, 0 FROM k WHERE n_cr > 0
      UNION ALL SELECT c, d, 'control_amount', 'DEBITS', CAST(debits AS VARCHAR), CAST(debits AS VARCHAR), true, 0 FROM k WHERE n_db > 0
      UNION ALL SELECT c, d, 'balance_roll', NULL, CAST(cl AS VARCHAR), CAST(roll AS VARCHAR), cl = roll, 1 FROM k)"""

ORACLE = {
    "statement_end_to_end": f"""
        WITH {_L}, {_D},
        t AS (SELECT *, row_number() OVER (PARTITION BY c, d ORDER BY o, cr DESC, n, p, s, price) AS seq FROM l)
        SELECT c AS file_id, strftime(d, '%Y-%m-%d') AS posting_date, 'NTRS' AS bank, lpad(CAST(c AS VARCHAR), 8, '0') AS account_number,
               'Customer' || c AS account_name, ccy AS currency, seq,
               CAST(CASE WHEN cr THEN 100 ELSE 400 END + p % 300 AS VARCHAR) AS type_code,
               CASE WHEN cr THEN 'CREDITS' ELSE 'DEBITS' END AS section, CASE WHEN cr THEN 'CR' ELSE 'DB' END AS dbcr,
               CAST(price AS VARCHAR) AS amount, lpad(CAST(o AS VARCHAR), 10, '0') AS reference,
               strftime(CASE WHEN n = 3 THEN d + 1 ELSE d END, '%Y-%m-%d') AS value_date,
               'Part ' || p || ' TRN' || lpad(CAST(o AS VARCHAR), 10, '0') || ' ORG=S' || s || ' BNF=C' || c
                 || CASE WHEN n = 3 THEN ' Value Date Of ' || strftime(d + 1, '%m-%d-%Y') ELSE '' END AS description,
               CAST(d - DATE '1990-01-01' AS INTEGER) AS page, CAST(op AS VARCHAR) AS opening_ledger,
               CAST(op + credits - debits AS VARCHAR) AS closing_ledger,
               CASE WHEN op + credits - debits < 0 THEN 'DR' ELSE 'CR' END AS closing_ledger_dbcr,
               'S' || s AS org,
               'C' || c || CASE WHEN n = 3 THEN ' Value Date Of ' || strftime(d + 1, '%m-%d-%Y') ELSE '' END AS bnf
        FROM t JOIN ctx USING (c, d)""",
    "statement_days": f"""
        WITH {_L}, {_D}
        SELECT c AS file_id, strftime(d, '%Y-%m-%d') AS posting_date, lpad(CAST(c AS VARCHAR), 8, '0') AS account_number,
               ccy AS currency, CAST(credits AS VARCHAR) AS total_credits, CAST(debits AS VARCHAR) AS total_debits,
               CAST(op AS VARCHAR) AS opening_ledger, CAST(op + credits - debits AS VARCHAR) AS closing_ledger,
               n_cr AS credit_count, n_db AS debit_count, 'CR' AS opening_ledger_dbcr
        FROM ctx""",
    "control_totals": f"""
        WITH {_CHECKS}
        SELECT file_id, strftime(d, '%Y-%m-%d') AS posting_date, "check", kind, stated, parsed, ok, counted FROM checks""",
    "run_summary": f"""
        WITH {_CHECKS},
        a AS (SELECT file_id, CAST(sum(counted) AS BIGINT) AS n, count(*) FILTER (NOT ok) AS bad FROM checks GROUP BY 1),
        t AS (SELECT c AS file_id, count(*) AS n FROM l GROUP BY 1),
        u AS (SELECT c AS file_id, count(*) AS n FROM day WHERE o1 % 11 = 0 GROUP BY 1)
        SELECT a.file_id, a.n + t.n AS checks, bad AS failed, coalesce(u.n, 0) AS unparsed
        FROM a JOIN t USING (file_id) LEFT JOIN u USING (file_id)""",
    "unparsed_report": f"""
        WITH {_CHECKS}
        SELECT c AS file_id, 'unparsed_row' AS kind, row_number() OVER (PARTITION BY c ORDER BY d) AS rank,
               'unparsed row p' || (d - DATE '1990-01-01') || ': Memo ' || o1 AS detail, 2 AS source_ord
        FROM day WHERE o1 % 11 = 0
        UNION ALL
        SELECT c, 'validation', 0, 'VALIDATION: ' || strftime(d, '%Y-%m-%d') || ' acct ' || lpad(CAST(c AS VARCHAR), 8, '0')
               || ' (' || coalesce(ccy, 'None') || '): opening ' || op || ' + credits ' || credits || ' - debits ' || debits
               || ' = ' || roll || ' != closing ' || cl, 2
        FROM k WHERE cl <> roll""",
    "strict_files": f"""
        WITH {_CHECKS}
        SELECT c AS file_id, count(*) AS n, CAST(sum(price) AS VARCHAR) AS total
        FROM l WHERE c NOT IN (SELECT file_id FROM checks WHERE NOT ok) GROUP BY c""",
    "brokerage_end_to_end": """
        WITH t AS (SELECT *, CAST(l_extendedprice AS DECIMAL(18, 2)) * CASE WHEN l_linenumber % 2 = 0 THEN -1 ELSE 1 END AS amount,
                          CAST(l_shipdate AS DATE) AS d, l_returnflag AS f FROM lineitem)
        SELECT 'S' || l_suppkey || '-' || strftime(d, '%Y%m') AS file_id, '1234-' || lpad(CAST(l_suppkey % 10000 AS VARCHAR), 4, '0') AS account_number,
               strftime(d, '%B') || ' 1-' || day(last_day(d)) || ', ' || year(d) AS statement_period,
               strftime(date_trunc('month', d), '%Y-%m-%d') AS period_start_date, strftime(last_day(d), '%Y-%m-%d') AS period_end_date,
               '$' AS currency,
               row_number() OVER (PARTITION BY l_suppkey, date_trunc('month', d)
                   ORDER BY day(d), l_orderkey, l_linenumber, l_partkey, l_extendedprice) AS seq,
               strftime(d, '%Y-%m-%d') AS posting_date,
               CASE f WHEN 'A' THEN 'Reinvested Shares' WHEN 'R' THEN 'Other Activity' ELSE 'Sale' END AS category,
               CASE WHEN f = 'N' THEN 'Sold' END AS action, CASE WHEN f <> 'R' THEN 'SY' || (l_partkey % 50) END AS symbol,
               'Part ' || l_partkey || CASE f WHEN 'R' THEN ' **MATURED**' WHEN 'N' THEN ' lot ' || l_suppkey ELSE '' END AS description,
               CAST(amount AS VARCHAR) AS amount, CASE WHEN amount < 0 THEN 'DB' ELSE 'CR' END AS dbcr,
               CAST(day(d) + 1 AS INTEGER) AS page, '1000.25' AS opening_balance, '-2000.50' AS closing_balance
        FROM t""",
    "carry_forward": """
        SELECT event_id, last_value(CASE WHEN event_type = 'signup' THEN strftime(ts, '%Y-%m-%d') END IGNORE NULLS) OVER o AS day,
               last_value(CASE event_type WHEN 'signup' THEN '' WHEN 'click' THEN 'CREDITS' WHEN 'view' THEN 'DEBITS' END
                          IGNORE NULLS) OVER o AS section,
               min(CASE WHEN event_type = 'error' THEN event_id END) OVER o AS first_error, lag(event_type) OVER o AS before
        FROM events WINDOW o AS (PARTITION BY user_id ORDER BY event_id)""",
    "account_days": """
        WITH e AS (SELECT event_id, user_id, CAST(ts AS DATE) AS day, 'A' || (CAST(floor(value / 20) AS BIGINT) % 2) AS account,
                          CASE WHEN event_id % 4 = 0 THEN 'C' || (event_id % 3) END AS own
                   FROM events),
             n AS (SELECT *, coalesce(lag(account) OVER o <> account OR lag(day) OVER o <> day, true) AS opened,
                          last_value(own IGNORE NULLS) OVER (PARTITION BY user_id, account ORDER BY event_id) AS currency
                   FROM e WINDOW o AS (PARTITION BY user_id ORDER BY event_id))
        SELECT event_id, account, currency, opened,
               CAST(sum(CAST(opened AS INTEGER)) OVER (PARTITION BY user_id ORDER BY event_id) AS BIGINT) AS ctx_id
        FROM n""",
    "txn_islands": f"""
        {_ISLANDS}
        SELECT user_id, CAST(txn AS BIGINT) AS txn, min(event_id) AS first_event, count(*) AS n_lines,
               CAST(arg_min(CAST(value AS DECIMAL(18, 2)), event_id) FILTER (value >= 20) AS VARCHAR) AS amount
        FROM e WHERE open GROUP BY user_id, txn""",
    "txn_descriptions": f"""
        {_ISLANDS}
        SELECT user_id, CAST(txn AS BIGINT) AS txn,
               string_agg(event_type || ':' || CAST(CAST(value AS DECIMAL(18, 2)) AS VARCHAR), ' ' ORDER BY event_id) AS description
        FROM e WHERE open GROUP BY user_id, txn""",
    "tags_and_refs": """
        SELECT o_orderkey, CASE o_orderkey % 4 WHEN 3 THEN NULL WHEN 2 THEN 'A' || lpad(CAST(o_orderkey AS VARCHAR), 9, '0')
                           ELSE lpad(CAST(o_orderkey AS VARCHAR), 9, '0') END AS reference,
               strftime(CASE WHEN o_orderkey % 5 = 0 THEN o_orderdate + INTERVAL 2 DAY ELSE o_orderdate END, '%Y-%m-%d') AS value_date,
               'Acme ' || o_orderpriority || CASE WHEN o_orderkey % 3 = 0 THEN ';Second' ELSE '' END AS org,
               o_custkey || CASE WHEN o_orderkey % 3 > 0 AND o_orderkey % 5 = 0
                                 THEN ' Value Date Of ' || strftime(o_orderdate + INTERVAL 2 DAY, '%m-%d-%Y') ELSE '' END AS bnf,
               CASE WHEN o_orderkey % 3 = 0 THEN '7' || CASE WHEN o_orderkey % 5 = 0
                    THEN ' Value Date Of ' || strftime(o_orderdate + INTERVAL 2 DAY, '%m-%d-%Y') ELSE '' END END AS id
        FROM orders""",
    "balance_roll": """
        WITH d AS (SELECT user_id, CAST(ts AS DATE) AS day, min(event_id) AS e1,
                          sum(CASE WHEN event_type = 'purchase' THEN -1 ELSE 1 END * CAST(value AS DECIMAL(18, 2))) AS net
                   FROM events GROUP BY 1, 2),
             r AS (SELECT *, sum(net) OVER (PARTITION BY user_id ORDER BY e1) AS roll FROM d)
        SELECT user_id AS file_id, strftime(day, '%Y-%m-%d') AS posting_date, CAST(roll + bad AS VARCHAR) AS stated,
               CAST(roll AS VARCHAR) AS parsed, bad = 0 AS ok, CASE WHEN roll + bad < 0 THEN 'DR' ELSE 'CR' END AS label,
               CASE WHEN roll < 0 THEN 'DB' ELSE 'CR' END AS dbcr
        FROM (SELECT *, CASE WHEN e1 % 7 = 0 THEN 1 ELSE 0 END AS bad FROM r)""",
    "code_direction": """
        WITH t AS (SELECT l_orderkey AS file_id, l_partkey % 700 + 100 AS code, l_partkey % 50 = 0 AS bare,
                          CASE WHEN l_linestatus = 'O' THEN 'CREDITS' ELSE 'DEBITS' END AS kind,
                          strftime(l_shipdate, '%Y-%m-%d') || ' acct ' || l_suppkey AS who FROM lineitem),
             k AS (SELECT file_id, 'type_direction' AS "check", kind,
                          CASE WHEN code < 400 THEN kind = 'CREDITS' WHEN code < 700 THEN kind = 'DEBITS' ELSE true END AS ok,
                          who || ': type ' || code || ' in ' || kind || ' section' AS detail FROM t
                   UNION ALL SELECT file_id, 'no_amount', kind, false, who || ': transaction ''x'' has no amount' FROM t WHERE bare)
        SELECT file_id, "check", kind, ok, count(*) AS n, min(detail) AS detail FROM k GROUP BY ALL""",
    "no_activity_days": """
        WITH s AS (SELECT user_id, min(CAST(ts AS DATE)) AS a, max(CAST(ts AS DATE)) AS b FROM events GROUP BY 1),
             c AS (SELECT user_id, CAST(unnest(range(a, b + INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE) AS day FROM s)
        SELECT user_id, strftime(day, '%Y-%m-%d') AS day FROM c
        WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = c.user_id AND CAST(e.ts AS DATE) = c.day
                                                   AND event_type = 'purchase')""",
    "detect_profile": r"""
        SELECT doc_id, CASE WHEN regexp_matches(text, '(?i)THING\s+the') THEN 'bank'
                            WHEN regexp_matches(text, '(?i)und die') THEN 'broker'
                            WHEN regexp_matches(text, '(?i)q[uo]e? la') THEN 'card' END AS profile
        FROM documents""",
}
