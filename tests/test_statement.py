"""Bank statements: facts about layouts, injected faults, and random files against a plain interpreter."""
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerloom.operators.statement import read_statements
from ledgerloom.operators.validate import run_summary
from ledgerloom.sources.profiles import BankProfile

SCHEMA = "file_id string, page int, row_no int, words array<struct<x0:double,text:string>>"
ALL = BankProfile(balance_records="all")


def line(*cells):
    return [(float(x), t) for x, t in cells]


def frame(spark, files):
    """files: {file_id: [(page, words)]}"""
    rows = [(f, p, i, w) for f, lines in files.items() for i, (p, w) in enumerate(lines)]
    return spark.createDataFrame(rows, SCHEMA)


DATE = line((0.1, "July 14, 2026"))
HEAD = line((0.1, "BANK: NTRS Holdco ACCOUNT: 123 USD"))


def sample(amount="35,000.00", total="35,000.00", closing="36,000.00"):
    return [
        (1, line((0.1, "Northern Trust Treasury Passport"))),
        (1, line((0.1, "Information Reported On: Aug 1, 2026 As Of: Jul 1, 2026 - Jul 31, 2026"))),
        (1, DATE), (1, HEAD),
        (1, line((0.05, "010 OPENING LEDGER BALANCE 1,000.00"))),
        (1, line((0.05, "015 CLOSING LEDGER BALANCE"), (0.9, closing))),
        (1, line((0.05, f"100 TOTAL CREDITS {total}"))),
        (1, line((0.1, "ACCOUNT CREDITS"))),
        (1, line((0.05, "195"), (0.1, "Incoming TRN2026071401879778"), (0.9, amount))),
        (1, line((0.1, "ORG=SOME ORG"))),
        # the page breaks inside the transaction: headers repeat, then its description goes on
        (2, line((0.1, "Page 2 of 3"))), (2, DATE), (2, HEAD),
        (2, line((0.1, "header noise"))),
        (2, line((0.1, "ACCOUNT CREDITS"))),
        (2, line((0.1, "ORG=SHOLDCO FINANCING LIMITED Value Date Of 07-15-2026"))),
        (2, line((0.1, "TOTALS FOR ACCOUNT:"))),
        (2, line((0.1, "CREDIT COUNT: 1"), (0.9, total))),
        (2, line((0.1, "July 15, 2026"))),
        (2, line((0.1, "BANK: NTRS ACCOUNT: 123"))),
        (2, line((0.05, "015 CLOSING LEDGER BALANCE (85.00)"))),
    ]


def test_page_split_and_balances(spark):
    s = read_statements(frame(spark, {"f": sample()}))
    (t,) = s.transactions.collect()
    assert t.description == (
        "Incoming TRN2026071401879778 ORG=SOME ORG ORG=SHOLDCO FINANCING LIMITED Value Date Of 07-15-2026"
    )
    assert (t.amount, t.dbcr, t.reference, t.value_date) == (Decimal("35000.00"), "CR", "2026071401879778", "2026-07-15")
    assert t.tags["ORG"] == ["SOME ORG", "SHOLDCO FINANCING LIMITED Value Date Of 07-15-2026"]
    assert (t.period_start_date, t.period_end_date) == ("Jul 1, 2026", "Jul 31, 2026")
    (b,) = s.balances.collect()  # only the day without activity
    assert (b.posting_date, b.closing_ledger, b.closing_ledger_dbcr) == ("2026-07-15", Decimal("-85.00"), "DR")
    assert (b.currency, b.account_name, b.opening_ledger, b.opening_ledger_dbcr) == ("USD", "Holdco", None, None)
    assert s.checks.filter("not ok").count() == 0 and s.unparsed.count() == 0
    assert s.records(BankProfile()).count() == 2


@pytest.mark.parametrize(
    "change, check",
    [
        ({"amount": "35,000.01"}, {"total_line", "control_amount", "balance_roll"}),
        ({"total": "1.00"}, {"total_line", "control_amount"}),
        ({"closing": "36,000.01"}, {"balance_roll"}),
    ],
)
def test_altered_figures_are_caught(spark, change, check):
    s = read_statements(frame(spark, {"f": sample(**change), "good": sample()}))
    bad = s.checks.filter("not ok").collect()
    assert {b["check"] for b in bad} == check and {b.file_id for b in bad} == {"f"}
    summary = {r.file_id: (r.checks, r.failed) for r in run_summary(s.checks, s.unparsed).collect()}
    assert summary == {"f": (4, len(check)), "good": (4, 0)}


def test_other_failures(spark):
    rows = [
        (1, line((0.1, "before any account"))), (1, DATE), (1, HEAD),
        (1, line((0.05, "010 OPENING LEDGER BALANCE"))),
        (1, line((0.1, "ACCOUNT DEBITS"))),
        (1, line((0.05, "195"), (0.1, "wrong side"), (0.9, "5.00"))),
        (1, line((0.05, "495"), (0.1, "no amount"))),
    ]
    s = read_statements(frame(spark, {"f": rows}))
    bad = sorted(r["check"] for r in s.checks.filter("not ok").collect())
    assert bad == ["balance_no_value", "missing_control", "no_amount", "type_direction"]
    assert [r.full for r in s.unparsed.collect()] == ["before any account"]


# --- random files ------------------------------------------------------------------------------------------
def rendered(kind, n):
    return {
        "D": line((0.1, f"July {n % 2 + 1}, 2026")),
        "A": line((0.1, f"BANK: B ACCOUNT: {n % 2 + 7}")),
        "S": line((0.1, "ACCOUNT CREDITS" if n % 2 else "ACCOUNT DEBITS")),
        "T": line((0.1, f"TOTALS FOR ACCOUNT: {'CREDIT' if n % 3 else 'DEBIT'} COUNT: {n}")),
        "N": line((0.1, f"{n}.00")),
        "X": line((0.05, f"{100 + n}"), (0.1, f"about {n}"), (0.9, f"{n}.50")) if n % 3 else line((0.05, f"{100 + n}"), (0.1, f"about {n}")),
        "O": line((0.1, f"text {n}")) if n % 2 else line((0.1, f"text {n}"), (0.9, f"{n}.25")),
        "B": line((0.05, f"010 OPENING LEDGER BALANCE {n}.75")),
    }[kind]


def interpret(rows):
    """Row by row, with the meaning of each kind written down once."""
    day = acct = section = txn = None
    mode, ctx, seq, opening = "idle", 0, 0, None
    closed, lost, control, figures = [], [], {}, None

    def close():
        nonlocal txn
        if txn:
            closed.append((*txn[:5], " ".join(txn[5]), txn[6], opening))
        txn = None

    def settle():
        nonlocal figures
        if figures:
            kind, count, amounts = figures
            control[(ctx, kind)] = (count, amounts[-1] if amounts else None)
        figures = None

    def reset():
        nonlocal acct, section, mode, opening
        close(), settle()
        acct, section, mode, opening = None, None, "idle", None

    for kind, n in rows:
        if kind == "D":
            if day != n % 2:
                reset()
                day = n % 2
        elif kind == "A":
            if acct == n % 2:
                mode = "header"
            else:
                reset()
                acct, ctx, seq = n % 2, ctx + 1, 0
        elif acct is None:
            lost.append(n)
        elif kind == "B":
            opening = Decimal(f"{n}.75")
        elif kind == "S":
            name = "CREDITS" if n % 2 else "DEBITS"
            if mode == "header" and txn and txn[4] == name:
                mode = "txn"
            else:
                close(), settle()
                mode = "idle"
            section = name
        elif kind == "T":
            close(), settle()
            figures, mode = ("CREDITS" if n % 3 else "DEBITS", n, []), "totals"
        elif kind == "N" and mode == "totals":
            figures[2].append(Decimal(f"{n}.00"))
        else:
            if mode == "totals":
                settle()
                mode = "idle"
            if kind == "X" and section:
                close()
                seq += 1
                txn = [ctx, seq, None, f"{100 + n}", section, [f"about {n}"], Decimal(f"{n}.50") if n % 3 else None]
                mode = "txn"
            elif mode == "txn":
                words = rendered(kind, n)
                txn[5].append(" ".join(t for x, t in words if x < 0.78))
                money = [t for x, t in words if x >= 0.78]
                if money and txn[6] is None:
                    txn[6] = Decimal(money[0])
            elif mode != "header":
                lost.append(n)
    reset()
    return [(c, s, code, sec, d, a, o) for c, s, _, code, sec, d, a, o in closed], lost, control


@pytest.mark.parametrize("block_rows", [1_000_000, 12])
def test_random_files(spark, block_rows):
    rnd = random.Random(11)
    files = {
        f"f{i}": [(rnd.choice("DAASSTTNNXXXXOOOOB"), rnd.randint(1, 60)) for _ in range(rnd.choice([10, 30, 60]))]
        for i in range(120 if block_rows > 12 else 40)
    }
    # rows are unique by number, so that lost rows can be told apart
    files = {f: [(k, n + 60 * (i % 2)) for i, (k, n) in enumerate(r)] for f, r in files.items()}
    df = frame(spark, {f: [(i // 7, rendered(k, n)) for i, (k, n) in enumerate(r)] for f, r in files.items()})
    s = read_statements(df, block_rows=block_rows)
    got = {}
    for r in s.transactions.collect():
        got.setdefault(r.file_id, []).append(
            (r.ctx_id, r.seq, r.type_code, r.section, r.description, r.amount, r.opening_ledger)
        )
    lost = {r.file_id: r.n for r in s.unparsed.groupBy("file_id").agg(F.count("*").alias("n")).collect()}
    control = {}
    for r in s.account_days.collect():
        for kind, c in (("CREDITS", r.control_credits), ("DEBITS", r.control_debits)):
            if c:
                control.setdefault(r.file_id, {})[(r.ctx_id, kind)] = c["count"]
    for f, rows in files.items():
        want, dropped, ctl = interpret(rows)
        assert sorted(got.get(f, [])) == sorted(want), f
        assert lost.get(f, 0) == len(dropped), f
        assert control.get(f, {}) == {k: v[0] for k, v in ctl.items()}, f


def test_shuffle_files_go_with_their_execution(spark):
    """The shuffle files of every step used to stay until the driver collected its garbage, and filled the disk."""
    import time
    from pathlib import Path

    from ledgerloom.session import tune, write_once

    tune(spark)
    folders = [d.getPath() for d in spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]

    def files():
        return {p for f in folders for p in Path(f).rglob("shuffle_*.data")}

    before = files()
    assert write_once(spark.range(1000).repartition(7).groupBy("id").count(), "gone").count() == 1000
    for _ in range(50):  # they are removed in the background
        if not files() - before:
            break
        time.sleep(0.2)
    assert not files() - before


def test_rendered_rows_need_no_sort_of_their_own(spark):
    """Rows are numbered by what the lines before print; equal lines print their first rows before their second ones."""
    from ledgerloom.plans.statements import statement_rows

    lines = spark.sql("""
        select o_custkey, 7L o_orderkey, date'2024-01-02' d, 12420 page, p l_partkey, 5L l_suppkey, n l_linenumber, s l_linestatus, cast(1.5 as decimal(18,2)) price
        from values (1L, 2L, 1, 'O'), (1L, 2L, 1, 'O'), (1L, 3L, 2, 'F'), (null, 2L, 1, null) as v(o_custkey, p, n, s)""")
    rows = statement_rows(lines)
    assert "Union" not in rows._jdf.queryExecution().optimizedPlan().toString()
    got = {}
    for r in rows.collect():
        got.setdefault(r.file_id, []).append((r.row_no, " ".join(w.text or "-" for w in r.words)))
    texts = [t for _, t in sorted(got[1])]
    assert [n for n, _ in sorted(got[1])] == list(range(1, 18))
    assert texts[5:12] == ["ACCOUNT CREDITS", *2 * ["102 Part 2 TRN0000000007"], *2 * ["ORG=S5 BNF=C1 1.50"], "ACCOUNT DEBITS", "403 Part 3 TRN0000000007 1.50"]
    assert texts[13:] == ["TOTALS FOR ACCOUNT:", "CREDIT COUNT: 2 3.00", "TOTALS FOR ACCOUNT: DEBIT COUNT: 1", "1.50"]
    assert [n for n, _ in sorted(got[None])] == list(range(1, 6))


def test_brokerage_days_number_rows_as_sorted(spark):
    """Rows are numbered on slim lines as if all were sorted: equal lines, null and low keys; no rendered row is moved."""
    import datetime as dt

    from ledgerloom.plans.statements import _brokerage_days

    day = dt.date(2024, 3, 5)
    keys = [(5, 1, "A"), (5, 1, "A"), (5, 1, "R"), (5, 2, "N"), (None, 1, "N"), (-4, 1, "A"), (-1, 1, None), (7, None, "R")]
    lines = spark.createDataFrame(
        [("f", 6, k, n, 3, 4, flag, 2, day) for k, n, flag in keys],
        "o_custkey string, page int, o_orderkey bigint, l_linenumber int, l_partkey bigint, l_suppkey bigint, l_returnflag string, cents int, d date",
    ).selectExpr("*", "cast(cents as decimal(18,2)) price").drop("cents")
    out = _brokerage_days(lines)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Window") and plan.index("Generate") < plan.index("Window") < plan.index("Exchange")
    rows = out.orderBy("row_no").collect()
    assert [r.row_no for r in rows] == list(range(1, len(rows) + 1))
    said = [r.words[0].text for r in rows]
    assert said[:7] == ["Sale", "lot", "Reinvested", "Shares", "Charles Schwab One", "Transaction Details", "03/05"]
    assert said[7] == "Sale" and said[8:10] == ["Reinvested"] * 2
    assert sorted(said[10:13]) == ["Other", "Shares", "Shares"] and said[13:] == ["Activity", "Sale", "lot", "Other", "Activity"]


def test_rows_are_read_where_they_are_printed(spark, tmp_path, monkeypatch):
    """Rendered rows and classified rows used to be written as tables, several times what the lines take."""
    from pathlib import Path

    from ledgerloom.plans import statements

    spark.sql("select id o_orderkey, if(id = 9, null, id % 3) o_custkey, date_add(date'2024-01-02', cast(id % 4 as int)) o_orderdate from range(12)").write.parquet(
        f"{tmp_path}/orders.parquet")
    spark.sql("""
        select id % 12 l_orderkey, 250 + id % 7 l_partkey, id % 5 l_suppkey, cast(id % 4 as int) l_linenumber, if(id % 2 = 0, 'O', 'F') l_linestatus,
               10.25 * id l_extendedprice from range(60)""").write.parquet(f"{tmp_path}/lineitem.parquet")
    work = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:")) / "work"

    def written(query):
        before = set(work.iterdir()) if work.exists() else set()
        rows = sorted(map(str, query(spark, str(tmp_path)).collect()))
        return rows, sorted(p.name.rsplit("-", 1)[0] for p in set(work.iterdir()) - before)

    for query in (statements.statement_end_to_end, statements.unparsed_report):
        rows, tables = written(query)
        assert rows and tables == ["large-files", "pieces"]
        # files above a block of rows are rendered page by page, as before, with the same result
        with monkeypatch.context() as m:
            m.setattr(statements, "BLOCK_ROWS", 5)
            again, tables = written(query)
        assert again == rows and tables == ["large-files", "pieces", "statement_rows"]


def test_groups_are_folded_once(spark):
    """Rows whose keys are together were grouped twice, in hash maps, before and after an exchange that is not there."""
    from ledgerloom.session import folding

    rows = spark.range(100).selectExpr("id % 7 as f", "id as x").repartition(3, "f").sortWithinPartitions("f")
    out = rows.groupBy("f").agg(F.sort_array(F.collect_list("x")).alias("xs"))
    with folding(spark):
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = {r.f: r.xs for r in out.collect()}
    assert got == {f: list(range(f, 100, 7)) for f in range(7)}
    assert plan.count("SortAggregate") == 1 and "ObjectHashAggregate" not in plan
    assert spark.conf.get("spark.sql.execution.replaceHashWithSortAgg") == "false"
