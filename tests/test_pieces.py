"""Smaller pieces: coercion edge cases, contracts, the 10,000-row file, sheets, stitching, messages, sinks."""
import json
import math
import random
from decimal import Decimal, InvalidOperation

import pytest
from pyspark.sql import functions as F

from ledgerloom.functions.coerce import CoercionOptions, coerce_text, with_numeric
from ledgerloom.functions.dates import date_text, parse_format
from ledgerloom.operators import sheets, tables as T
from ledgerloom.operators.batches import build_batches, job_totals
from ledgerloom.operators.contract import contract_drift, map_headers, unmapped_headers
from ledgerloom.operators.geometry import visual_rows
from ledgerloom.operators.records import fill_system_columns, records_mixed, records_wide
from ledgerloom.sinks import tables as store
from ledgerloom.sources.delimited import scan_delimited
from ledgerloom.streaming import requests as R

NUMBERS = {
    "(1,234.00)": "-1234.00", "1,234.00-": "-1234.00", "1,234.00 CR": "1234.00", "$ 5": "5", "-": None, "--": None,
    "": None, "abc": "abc", "(0)": "0", "(0.00)": "0.00", "-5-": "5", "(5-)": "-5", "D": "D", "$-": "$-",
    "£1.50DR": "1.50", "-0": "-0", "(5) D": "-5", "0.0000001": "1E-7", " x ": " x ",
}


def test_numbers(spark):
    df = spark.createDataFrame([(k,) for k in NUMBERS], "v string")
    out = with_numeric(df, "v", "wide").withColumn("inline", coerce_text(F.col("v"), "Numeric"))
    for r in out.collect():
        assert r.wide == r.inline == NUMBERS[r.v], r.v
    for k, want in NUMBERS.items():  # the same digits, by another route
        try:
            assert want is None or Decimal(want) is not None
        except InvalidOperation:
            assert want == k
    strict = with_numeric(df, "v", "n", CoercionOptions(on_error="null")).filter("v = 'abc'").first()
    assert strict.n is None
    with pytest.raises(Exception, match="cannot coerce"):
        with_numeric(df, "v", "n", CoercionOptions(on_error="fail")).collect()


def test_dates(spark):
    want = {
        "1/2/2026": "2026-02-01", "12/31/2026": "2026-12-31", "23-JAN-2026": "2026-01-23", "20260123": "2026-01-23",
        "2026123": "2026-12-03", "2026-1-2": "2026-01-02", "2026-01-02 10:00:00": "2026-01-02", "garbage": None,
        "2026-02-30": None, "March 5, 2026": "2026-03-05", "05.03.2026": "2026-03-05",
    }
    from ledgerloom.functions.coerce import DATE_FORMATS

    df = spark.createDataFrame([(k,) for k in want], "v string")
    assert {r.v: r.d for r in df.select("v", date_text(F.col("v"), DATE_FORMATS).alias("d")).collect()} == want
    custom = df.select(date_text(F.lit("26|01|2026 07:08"), (), True, "%d|%m|%Y %H:%M").alias("d")).first().d
    assert custom == "2026-01-26T07:08:00"
    assert df.select(parse_format(F.lit("5 feb 99"), "%d %b %y").cast("string").alias("d")).first().d == "1999-02-05 00:00:00"


CONTRACT = """file_seq_id string, column_details array<struct<columnName:string,columnType:string>>,
    positions array<struct<source_column:string,source_display_column:string,field_type:string>>,
    fetch_by_name boolean, by_column_number boolean, include_exclude array<string>, is_exclude boolean"""
TABLES = "file_seq_id string, file_ord int, table_no int, headers array<string>"


def test_contract_names_and_drift(spark):
    contracts = spark.createDataFrame(
        [("r", [("amount", "numeric"), ("itemdate", "date")],
          [("amount", "Amount", "Numeric"), ("closingbalancedbcr_7", "Closing Balance DB/CR", "String"),
           ("openingbalancedbcr_5", "Opening Balance DB/CR", "String")], True, False, [], False)], CONTRACT)
    tables = spark.createDataFrame([("r", 0, 0, ["a", "a", "a_1", "", "Écran", "AMOUNT "])], TABLES)
    assert contract_drift(contracts).count() == 2
    mapped = map_headers(tables, contracts)
    targets = [m["target"] for m in mapped.first()["mapping"]]
    assert targets == ["a", "a_1", "a1", "col_4", "cran", "amount"]
    assert sorted(r.detail.split("'", 1)[1][:-1] for r in unmapped_headers(mapped).collect()) == ["", "a", "a", "a_1", "Écran"]
    cells = spark.createDataFrame(
        [("r", 0, 0, 2, ["1", "2", "3", "4", "5", "(7)", "x"]), ("r", 0, 0, 3, ["1"])],
        "file_seq_id string, file_ord int, table_no int, src_row bigint, cells array<string>")
    mixed = records_mixed(cells, mapped).orderBy("src_row").collect()
    assert mixed[0]["record"]["amount"] == "-7" and mixed[1]["record"]["amount"] is None
    wide = records_wide(cells, mapped.first()["mapping"]).orderBy("src_row").collect()
    assert [r.amount for r in wide] == ["-7", None] and wide[0].a_1 == "2"


def test_cash_file_of_ten_thousand_rows(spark, tmp_path):
    path = tmp_path / "cash.csv"
    with path.open("w", newline="") as f:
        f.write("﻿Sub Account,Currency,Amount,Item Date,DB/CR\n")
        for i in range(10_000):
            f.write(f'SA{i},USD,{f"""\"{i},000.25\"""" if i % 2 else f"({i})"},23/01/2026,CR\n')
            if i % 500 == 0:
                f.write(",,\n\n")
    contracts = spark.createDataFrame(
        [("T1", [("subaccount", "varchar"), ("currency", "varchar"), ("amount", "numeric"), ("itemdate", "date"),
                 ("dbcr_4", "varchar"), ("file_seq_id", "varchar")], [("dbcr_4", "DB/CR", "String")], True, False, [], False)],
        CONTRACT)
    requests = spark.createDataFrame(
        [("T1", 0, f"file://{path}", ",", 1)],
        "file_seq_id string, file_ord int, path string, delimiter string, headers_row int")
    tables, cells = scan_delimited(spark, requests, str(path))
    records = records_mixed(cells, map_headers(tables, contracts)).withColumns(
        {"path": F.lit(str(path)), "source_name": F.lit(""), "run_id": F.lit("r"), "process_date": F.lit("2026-01-01")})
    batches = build_batches(fill_system_columns(records), 1000)
    out = batches.orderBy("batch_no").collect()
    assert len(out) == 10 and {b.record_count for b in out} == {1000} and out[0].first_row == 2
    one, two = json.loads(out[0].records[1]), json.loads(out[0].records[2])
    assert (one["subaccount"], one["amount"], one["itemdate"], one["file_seq_id"]) == ("SA1", "1000.25", "2026-01-23", "T1")
    assert two["amount"] == "-2" and two["_row"] == "4"
    totals = job_totals(batches).first()
    assert (totals.total_records, totals.total_batches) == (10_000, 10)


def test_latin1_and_late_header(spark, tmp_path):
    path = tmp_path / "old.txt"
    path.write_bytes("title\n\nNÂME;B\n\n é ;\"x;\"\"y\"\n;;\nz\n".encode("latin-1"))
    requests = spark.createDataFrame(
        [("L", 0, f"file://{path}", ";", 3)],
        "file_seq_id string, file_ord int, path string, delimiter string, headers_row int")
    tables, cells = scan_delimited(spark, requests, str(path))
    assert tables.first().headers == ["NÂME", "B"]
    assert [(r.src_row, r.cells) for r in cells.orderBy("src_row").collect()] == [(4, [" é ", 'x;"y']), (5, ["z"])]


def test_workbook_of_2500_rows(spark):
    cells = spark.range(2501).select(
        F.lit("w").alias("file_id"), F.lit(0).alias("sheet_idx"), F.lit("S").alias("sheet"),
        (F.col("id") + 1).cast("int").alias("row"),
        F.posexplode(F.when(F.col("id") == 0, F.array(F.lit("ISIN"), F.lit("Amount"), F.lit("")))
                     .otherwise(F.array(F.format_string("US%010d", F.col("id") - 1), (12.5 * (F.col("id") - 1)).cast("string"), F.lit("")))
                     ).alias("col", "value")).withColumn("col", F.col("col") + 1)
    asked = spark.createDataFrame([("w", None)], "file_id string, identifiers array<string>")
    chosen, missing = sheets.wanted_sheets(cells.select("file_id", "sheet_idx", "sheet").distinct(), asked)
    heads, rows = sheets.sheet_grid(cells, chosen)
    assert heads.first().headers == ["ISIN", "Amount"] and missing.count() == 0
    records = rows.select(F.col("file_id").alias("file_seq_id"), F.lit(0).alias("file_ord"), "table_no",
                          F.col("row").cast("bigint").alias("src_row"), F.col("cells").getItem(0).alias("record"))
    sizes = [b.record_count for b in build_batches(records, 1000).orderBy("batch_no").collect()]
    assert sizes == [1000, 1000, 500]


def test_rows_follow_the_anchor(spark):
    # each step is within the tolerance, the third word is too far from the first
    words = [("f", 1, i, t, x, x, top) for i, (t, x, top) in enumerate(
        [("a", 0.5, 0.100), ("b", 0.1, 0.103), ("c", 0.2, 0.106), ("d", 0.1, 0.109), ("e", 0.1, 0.109)])]
    df = spark.createDataFrame(words, "file_id string, page int, word_ord int, text string, x0 double, x1 double, top double")
    got = [[w.text for w in r.words] for r in visual_rows(df, 0.0035).orderBy("row_no").collect()]
    assert got == [["b", "a"], ["d", "e", "c"]]


@pytest.mark.parametrize("block_rows", [1_000_000, 15])
def test_stitch_and_merge_random(spark, block_rows):
    rnd = random.Random(2)
    heads, body, want = [], [], {}
    for f in range(20):
        current, tables = None, []
        for page in range(rnd.randint(5, 40)):
            width = rnd.choice([2, 2, 3])
            real = rnd.random() < 0.5
            header = ([rnd.choice("PQ")] + ["b", "c"][: width - 1]) if real else [f"col_{i + 1}" for i in range(width)]
            if not (current and len(current) == width and (header == current or not real)):
                current = header
                tables.append((header, []))
            heads.append((f, page, 0, width, header))
            for n in range(rnd.randint(1, 3)):
                cells = [rnd.choice(["", "k"]), rnd.choice(["t", "1.0", ""])] + [""] * (width - 2)
                if not any(cells) or rnd.random() < 0.1:
                    cells = ["Total", ""] + [""] * (width - 2)
                body.append((f, page, 0, n, cells))
                rows = tables[-1][1]
                if cells[0] == "Total":
                    continue
                if rows and not cells[0] and "1.0" not in cells:
                    rows[-1] = [" ".join(x for x in p if x) for p in zip(rows[-1], cells)]
                else:
                    rows.append(cells)
        want[f] = [(i + 1, h, r) for i, (h, r) in enumerate(tables)]
    h = spark.createDataFrame(heads, "file_id int, page int, table_on_page int, width int, header array<string>")
    b = spark.createDataFrame(body, "file_id int, page int, table_on_page int, row_no int, cells array<string>")
    placed = T.stitch(h, block_rows=block_rows)
    got_heads = {(r.file_id, r.table_no): r.table_header for r in placed.collect()}
    merged = T.merge_wrapped(b.join(placed.drop("width", "header"), ["file_id", "page", "table_on_page"]), block_rows=block_rows)
    got_rows = {}
    for r in merged.orderBy("file_id", "table_no", "src_row").collect():
        got_rows.setdefault((r.file_id, r.table_no), []).append(r.cells)
    for f, tables in want.items():
        for no, header, rows in tables:
            assert got_heads[(f, no)] == header
            assert got_rows.get((f, no), []) == rows


def test_messages(spark):
    values = ['{"path":"a.PDF","pdfTemplate":"zzz"}', '[{"fileName":"x.csv"},{"superset":{}}]', '["{}"]', "nope", '"{}"', "null"]
    df = spark.createDataFrame(list(enumerate(values)), "offset int, value string")
    items, dead = R.split_messages(df)
    routed = {(r.offset, r.item_no): r for r in R.route(items).collect()}
    assert {k: r.route for k, r in routed.items()} == {(0, 0): "dead", (1, 0): "process", (1, 1): "skip"}
    assert {r.offset for r in dead.collect()} == {2, 3, 4, 5}
    letters = R.dead_letters(R.route(items), dead_letter_skipped=True).collect()
    assert len(letters) == 2 and not any(r.retryable for r in letters)


def test_replay_changes_nothing(spark, tmp_path):
    base = str(tmp_path)
    message = json.dumps({"fileSeqId": "A", "path": "/x/a.csv"})
    df = spark.createDataFrame([(0, message), (1, message), (2, "broken")], "offset bigint, value string")

    def records_of(claimed):
        return claimed.select("file_seq_id", F.lit(0).alias("file_ord"), F.lit(0).alias("table_no"),
                              F.explode(F.sequence(F.lit(2).cast("bigint"), F.lit(6).cast("bigint"))).alias("src_row")).withColumns(
            {"record": F.lit("{}"), "error": F.lit(None).cast("string")})

    def state():
        jobs = store.latest_jobs(store.read_table(spark, base, "ledger", store.LEDGER_SCHEMA))
        batches = store.current_batches(store.read_table(spark, base, "batches", store.BATCH_SCHEMA), jobs)
        return (jobs.select("file_seq_id", "run_id", "status", "total_records", "total_batches").collect(),
                batches.select("batch_no", "record_count").orderBy("batch_no").collect())

    R.process_epoch(df, 0, base, records_of, batch_size=2)
    once = state()
    assert [tuple(r) for r in once[1]] == [(1, 2), (2, 2), (3, 1)]
    R.process_epoch(df, 0, base, records_of, batch_size=2)  # the same epoch again
    assert state() == once
    R.process_epoch(df, 1, base, records_of, batch_size=2)  # the messages delivered again
    assert state() == once
    assert spark.read.parquet(f"{base}/results").count() == 4  # every delivery is answered
    got = store.get_batch(store.read_table(spark, base, "batches", store.BATCH_SCHEMA), spark.createDataFrame(once[0]), "A", 3)
    assert got.count() == 1


def test_claimed_jobs_show_and_failures_stay_apart(spark, tmp_path):
    base = str(tmp_path)
    sent = [json.dumps({"fileSeqId": k, "path": f"/x/{k}.csv", "ruleId": "r1"}) for k in "AB"]
    df = spark.createDataFrame([(0, 7, sent[0]), (1, 7, sent[1])], "partition int, offset bigint, value string")

    def jobs():
        rows = store.latest_jobs(store.read_table(spark, base, "ledger", store.LEDGER_SCHEMA)).collect()
        return {r["file_seq_id"]: (r["status"], r["error"], r["total_records"], r["rule_id"], r["source_type"]) for r in rows}

    def dies(claimed):
        raise SystemExit

    with pytest.raises(SystemExit):
        R.process_epoch(df, 0, base, dies)
    assert jobs() == {k: ("PROCESSING", None, 0, "r1", "csv") for k in "AB"}

    def records_of(claimed):
        if claimed.filter("file_seq_id = 'B'").count():
            raise OSError("unreadable file")
        return claimed.select("file_seq_id", F.lit(0).alias("file_ord"), F.lit(0).alias("table_no"), F.lit(2).cast("bigint").alias("src_row"),
                              F.lit("{}").alias("record"), F.lit(None).cast("string").alias("error"))

    R.process_epoch(df, 0, base, records_of)  # the same epoch after the crash
    assert jobs() == {"A": ("COMPLETED", None, 1, "r1", "csv"), "B": ("FAILED", "OSError: unreadable file", None, "r1", "csv")}
    letters = spark.read.parquet(f"{base}/dead_letters").collect()
    assert [(r["file_seq_id"], r["retryable"]) for r in letters] == [("B", True)]


def test_record_files(spark, tmp_path):
    df = spark.createDataFrame([("A", "secret", 2, None)], "file_seq_id string, batch_id string, _row int, x string")
    store.write_record_files(df, ["file_seq_id"], str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).first().value == '{"_row":2,"x":null}'


def _scanned(spark, path, delimiter=","):
    from ledgerloom.sources.delimited import scan_delimited

    asked = spark.createDataFrame([("F", 0, str(path), delimiter, 1)], "file_seq_id string, file_ord int, path string, delimiter string, headers_row int")
    tables, cells = scan_delimited(spark, asked, str(path))
    return tables.first().headers, [tuple(r) for r in cells.orderBy("src_row").select("src_row", "cells").collect()]


def test_quoted_line_breaks(spark, tmp_path):
    path = tmp_path / "multi.csv"
    path.write_text('h1,"h\n2",h3\na,"two\nlines",""""\n , ,\n\nb,5" pipe,d\n"x ""y""\n\n,z",1,"q"\nlast,"never closed\nrest')
    headers, rows = _scanned(spark, path)
    assert headers == ["h1", "h\n2", "h3"]
    assert rows == [(2, ["a", "two\nlines", '"']), (3, ["b", '5" pipe', "d"]), (4, ['x "y"\n\n,z', "1", "q"]), (5, ["last", "never closed\nrest"])]


def test_line_breaks_over_block_borders_and_many_columns(spark, tmp_path):
    import csv
    import random

    rnd = random.Random(2)
    rows = [[rnd.choice(["", "a", "b,c", 'q"q', "line\nbreak", "x\n\ny", "'", '"']) + str(i) for _ in range(70)] for i in range(400)]
    path = tmp_path / "wide.csv"
    with path.open("w", newline="") as f:
        csv.writer(f, lineterminator="\n").writerows(rows)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        headers, got = _scanned(spark, path)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert headers == rows[0] and [r[1] for r in got] == rows[1:] and [r[0] for r in got] == list(range(2, 401))


def _read_as_csv(path, delimiter=","):
    import csv

    csv.field_size_limit(1 << 30)
    with path.open(newline="", encoding="utf-8-sig") as f:
        return [r for r in csv.reader(f, delimiter=delimiter)]


@pytest.mark.parametrize("content", [
    'h1|h2\na|"x\r\ny"\r\nb | "open"\r\n', 'h1|h2\r\nb | "no quote\nc|"never\r\nclosed|d\r\ne | f\n', 'h1|h2\nc|"never\nclosed|d\ne | f', "h1|h2\rlone|cr\r\"two\rlines\"|x\r",
    '\ufeff"h|1"|h2\n1|2', 'h|i\n"a"b"c|d\n""|""""\n"x"" y|z"|1\n"|"', 'h|i\n"a\n\n\n|"|2\n\n"b\r\r\n"|3\n"', 'h|i\n1|"x\r', 'h|i\n1|2\r\n\r\n3|"4"x"\r\n',
])
def test_cells_as_the_csv_module_reads_them(spark, tmp_path, content):
    path = tmp_path / "odd.csv"
    path.write_bytes(content.encode())
    expected = _read_as_csv(path, "|")
    headers, rows = _scanned(spark, path, "|")
    assert headers == expected[0] and [r[1] for r in rows] == [r for r in expected[1:] if any(c.strip() for c in r)]


def test_very_long_cells(spark, tmp_path):
    rows = [["h1", "h2"], ["q" * 2_500, 'a "quoted" word, ' * 20_000], ["x", "line\r\n" * 150_000], ['"' * 100_000, "y"], ["z" * 1_000_000, ",\n" * 10]]
    path = tmp_path / "long.csv"
    with path.open("w", newline="") as f:
        import csv

        csv.writer(f).writerows(rows)
    headers, got = _scanned(spark, path)
    assert headers == rows[0] and [r[1] for r in got] == rows[1:]


def test_a_quote_left_open_rejects_its_file_only(spark, tmp_path):
    from ledgerloom.sources.delimited import read_delimited

    good, bad = tmp_path / "good.csv", tmp_path / "bad.csv"
    good.write_text('a,b\n1,"x\ny"\n')
    bad.write_text('a,b\n1,"x\n' + "2,3\n" * 500)
    asked = spark.createDataFrame([(n, 0, str(p), ",", 1) for n, p in (("G", good), ("B", bad))], "file_seq_id string, file_ord int, path string, delimiter string, headers_row int")
    read = read_delimited(spark, asked, [str(good), str(bad)], limit=1000)
    assert [(r.file_seq_id, r.cells) for r in read.cells.collect()] == [("G", ["1", "x\ny"])]
    assert [tuple(r) for r in read.rejected.collect()] == [(str(bad), "record 2 has 2005 characters, more than a record of several lines may have")]
    assert read_delimited(spark, asked, [str(good), str(bad)]).cells.count() == 2


def test_document_patterns_equal_a_search_of_the_whole_text(spark, monkeypatch):
    import re

    from ledgerloom.operators import documents, ordered

    rnd = random.Random(4)
    parts = ["Opening", " balance", ": ", "\n", " ", "12.50", "(3)", "statement date", "- ", "2024/01", "x", "Total:", "\t", "closing\nbalance", "\U0001f600"]
    pages = [(d, p, "".join(rnd.choices(parts, k=rnd.randint(0, 6)))) for d in range(120) for p in range(rnd.randint(1, 9))]
    pages += [(999, p, t) for p, t in enumerate(["opening", *["\n"] * 9, "balance:", *["\n \n"] * 12, "77 total"])]
    pages += [(998, 0, None), (997, 5, "total"), (997, 2, "b"), (997, 9, "last")]
    table = spark.createDataFrame(pages, "file_id int, page int, text string").repartition(5)
    whole = {}
    for d, _, t in sorted(pages, key=lambda r: r[:2]):
        if (t or "").strip():
            whole[d] = f"{whole[d]}\n{t}" if d in whole else t
    asked = spark.createDataFrame([(d, f"f{i}", k) for d in {r[0] for r in pages} for i, k in enumerate(("'total'", "statement date", "zq"))], "file_id int, field string, keyword string")
    for block in (ordered.BLOCK_ROWS, 6):
        monkeypatch.setattr(ordered.OrderedRows.of, "__defaults__", (block, None))
        found = {r.file_id: r for r in documents.key_values(table).collect()}
        assert set(found) == set(whole)
        for d, text in whole.items():
            for name, pattern in documents.KEY_VALUE_PATTERNS.items():
                m = re.search(pattern, text, re.I | re.A)
                assert found[d][name] == (" ".join(m.group(1).split()) if m else None), (d, name, text)
        values, missing = documents.keyword_values(table, asked)
        got = {(r.file_id, r.field): r.value for r in values.collect()}
        lost = missing.count()
        for d in {r[0] for r in pages}:
            for i, k in enumerate(("total", "statement date", "zq")):
                m = re.search(re.escape(k) + r"\s*[:\-]?\s*(.+)", whole.get(d, ""), re.I | re.A)
                assert got.get((d, f"f{i}")) == (" ".join(m.group(1).split()) if m else None), (d, k, whole.get(d))
        assert lost + len(got) == 3 * len({r[0] for r in pages})


def test_nested_options(spark):
    from ledgerloom.operators.contract import merge_options

    def deep(a, b):
        return {**a, **{k: deep(a[k], v) if isinstance(v, dict) and isinstance(a.get(k), dict) else v for k, v in b.items()}}

    rnd = random.Random(6)

    def made(level=0):
        kinds = [None, 1, "x", [1, {"a": 2}], True, {}] + [None] * level
        return {k: made(level + 1) if rnd.random() < 0.5 and level < 4 else rnd.choice(kinds) for k in rnd.sample("abcd", rnd.randint(0, 4))}

    pairs = [(made(), made()) for _ in range(200)]
    rows = [(i, json.dumps(a), json.dumps(b)) for i, (a, b) in enumerate(pairs)] + [(1000, '{"a":1}', None), (1001, '{"a":1}', "nope"), (1002, '{"a":1}', "[1]"), (1003, None, '{"b":2}'), (1004, None, None)]
    found = dict(map(tuple, spark.createDataFrame(rows, "i int, a string, b string").select("i", merge_options(F.col("a"), F.col("b"))).collect()))
    for i, (a, b) in enumerate(pairs):
        assert json.loads(found[i]) == deep(a, b)
    assert [found[i] for i in range(1000, 1005)] == ['{"a":1}'] * 3 + ['{"b":2}', None]


def test_page_ranges_are_not_spelled_out(spark):
    pages = spark.range(1, 8).select(F.col("id").alias("page"))
    found = T.select_pages(pages, "5-1000000000,2-3,3,9-7").orderBy("page_ord").collect()
    assert [r.page for r in found] == [5, 6, 7, 2, 3, 3]


def test_a_thousand_date_formats_in_one_plan(spark):
    import datetime
    import itertools

    from ledgerloom.functions.dates import format_shape, parse_shape

    rnd = random.Random(8)
    days = [f"{a}{x}{b}{y}{c}" for a, b, c in itertools.permutations(["%d", "%m", "%Y"]) for x in "/-. *+" for y in "/-. ,("]
    days += [f"{b}{x}%d{x}{y}" for b in ("%b", "%B") for x in " -_/" for y in ("%Y", "%y")] + ["%y%m%d", "week %d of %m %Y", "%Y"]
    formats = [d + t for d in days for t in ("", " %H:%M", "T%H%M%S", " at %H.%M")]
    rows = []
    for fmt in formats:
        when = datetime.datetime(rnd.randint(1970, 2060), rnd.randint(1, 12), rnd.randint(1, 28), rnd.randint(0, 23), rnd.randint(0, 59), rnd.randint(0, 59))
        rows += [(fmt, when.strftime(fmt)), (fmt, "31" + when.strftime(fmt)[2:]), (fmt, "nothing")]
    assert len(formats) > 900
    df = spark.createDataFrame(rows, "fmt string, value string").withColumn("shape", format_shape(F.col("fmt")))
    for r in df.select("fmt", "value", parse_shape(F.col("value"), F.col("shape")).cast("string").alias("got")).collect():
        try:
            expected = str(datetime.datetime.strptime(r.value, r.fmt))
        except ValueError:
            expected = None
        assert r.got == expected, (r.fmt, r.value)


def test_own_date_formats_and_day_order(spark):
    from ledgerloom.operators.contract import map_headers
    from ledgerloom.operators.records import records_mixed

    formats = {"A": "%m~%d~%Y", "B": "%d~%m~%Y", "C": None, "D": ""}
    tables = spark.createDataFrame([(k, 0, 0, ["When"]) for k in formats], "file_seq_id string, file_ord int, table_no int, headers array<string>")
    contracts = spark.createDataFrame([(k, [("when", "date")], [], True, False, [], False) for k in formats], CONTRACT)
    own = spark.createDataFrame(list(formats.items()), "file_seq_id string, custom_format string")
    cells = spark.createDataFrame([(k, 0, 0, i, [v]) for k in formats for i, v in enumerate(("02~03~2024", "2024-05-06", "7-8-2024"))], "file_seq_id string, file_ord int, table_no int, src_row int, cells array<string>")
    mapped = map_headers(tables, contracts).join(own, "file_seq_id")
    found = {(r.file_seq_id, r.src_row): r.record["when"] for r in records_mixed(cells, mapped).collect()}
    assert [found[k, 0] for k in "ABCD"] == ["2024-02-03", "2024-03-02", "02~03~2024", "02~03~2024"]
    assert {found[k, 1] for k in "ABCD"} == {"2024-05-06"} and {found[k, 2] for k in "ABCD"} == {"2024-08-07"}
    found = records_mixed(cells, mapped, CoercionOptions(dayfirst=False)).filter("src_row = 2").collect()
    assert {r.record["when"] for r in found} == {"2024-07-08"}


def test_plans_of_ingest_stay_small(spark, tmp_path):
    """Slim frames with many readers are written: their plans, repeated in every reader, outgrew the driver."""
    from ledgerloom.operators.ingest import ingest_delimited

    for i in range(3):
        (tmp_path / f"f{i}.csv").write_text("Key,Note\n" + "".join(f"{i}{k},n\n" for k in range(5)))
    names = spark.createDataFrame([(f"R{i}", f"{tmp_path}/f{i}.csv") for i in range(3)], "file_seq_id string, path string")
    listing = names.selectExpr("path", "timestamp'2024-01-01' modificationTime", "1L length")
    requests = names.selectExpr(
        "*", "'' file_name", "'' sub_path", "'' details_delimiter", "',' delimiter", "1 headers_row", "'csv' format", "'d' source_name", "'r' run_id",
        "'2024-05-06' process_date", "false enrich_flow", "'rc' recon_id", "'ev' event_id")
    contracts = names.selectExpr(
        "file_seq_id", "array(named_struct('columnName', 'key', 'columnType', 'bigint')) column_details",
        "cast(array() as array<struct<source_column:string,source_display_column:string,field_type:string>>) positions",
        "true fetch_by_name", "false by_column_number", "cast(array() as array<string>) include_exclude", "false is_exclude")
    done = ingest_delimited(spark, requests, contracts, listing, pick="all", batch_size=2)
    for frame in (done.totals, done.batches, done.warnings, done.rejected):
        assert len(frame._jdf.queryExecution().toString()) < 100_000
    assert {tuple(r) for r in done.totals.collect()} == {(f"R{i}", 5, 3, 1) for i in range(3)}


def _tasks(spark, make):
    """How many tasks the rows of ``make()`` come from, when joins shuffle and tasks are put together by bytes."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return make().withColumn("__p", F.spark_partition_id()).select("__p").distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_tables_of_one_contract_are_mapped_by_many_tasks(spark):
    tables = spark.range(400).selectExpr("'R' file_seq_id", "0 file_ord", "cast(id as int) table_no", "array('A b', 'A b', '') headers")
    contracts = spark.sql("""
        select 'R' file_seq_id, array(named_struct('columnName', 'ab', 'columnType', 'bigint')) column_details,
               cast(array() as array<struct<source_column:string,source_display_column:string,field_type:string>>) positions,
               true fetch_by_name, false by_column_number, cast(array() as array<string>) include_exclude, false is_exclude""")
    mapped = map_headers(tables, contracts)
    assert _tasks(spark, lambda: mapped) > 1
    assert [m.target for m in mapped.first().mapping] == ["ab", "ab_1", "col_3"]
    # Spark infers a filter for the plain form of explode, and puts the mapping with all its lambdas in it again
    plan = unmapped_headers(mapped)._jdf.queryExecution().optimizedPlan().toString()
    assert len(plan) < 12_000


def test_nested_options_are_merged_by_many_tasks(spark):
    from ledgerloom.operators.contract import resolve_options

    requests = spark.range(400).selectExpr("id", "'k' k", "'{\"a\": {\"b\": 1}}' o")
    defaults = spark.sql("select 'k' k, '{\"a\": {\"c\": 2}}' o")
    assert _tasks(spark, lambda: resolve_options(requests, defaults, ["k"], [], ("o",))) > 1


def test_row_limit_of_a_chart_takes_no_single_task(spark):
    from ledgerloom.sources.charts import chart_query

    rows = spark.range(0, 1000, 1, 7)
    for limit, left in ((5000, 900), (1000, 900), (450, 450), (0, 0)):
        got = chart_query(rows, [{"col": "id", "op": ">=", "val": 100}], row_limit=limit)
        assert "Limit" not in got._jdf.queryExecution().optimizedPlan().toString()
        ids = [r.id for r in got.collect()]
        assert len(ids) == len(set(ids)) == left and all(i >= 100 for i in ids)


def test_the_cells_of_sheets_are_not_broadcast(spark):
    """Sizes guessed from few bytes made the cells, not the chosen sheets, the side that went through the driver."""
    cells = spark.range(2000).selectExpr("'b' file_id", "0 sheet_idx", "'S' sheet", "cast(id div 2 as int) + 1 row", "cast(id % 2 as int) + 1 col", "'v' value")
    listed = cells.select("file_id", "sheet_idx", "sheet").distinct()
    chosen, _ = sheets.wanted_sheets(listed, listed.selectExpr("file_id", "cast(null as array<string>) identifiers"))
    heads, rows = sheets.sheet_grid(cells, chosen)
    assert rows.count() == 999 and heads.count() == 1
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert "Range" not in plan and plan.count("Join") == 1  # the cells are grouped into rows once, for all readers


def test_visual_rows_drifting_pages_in_one_exchange(spark):
    """Drifting, equal, missing and huge heights against a plain fold; words move once and nothing is joined."""
    rnd = random.Random(5)
    words, want = [], {}
    for f in range(40):
        top, page = 0.0, []
        for i in range(rnd.randint(1, 60)):
            top += rnd.choice([0.0, 0.001, 0.002, 0.0035, 0.02])
            t = rnd.choice([None, float("nan"), float("inf")]) if rnd.random() < 0.04 else round(top, 4)
            page.append((f"f{f}", 1, i, f"w{i}", rnd.choice([0.1, 0.2, 0.3]), 1.0, t))
        rnd.shuffle(page)
        words += page
        key = lambda t: (t != t, 0.0 if t != t else t)  # noqa: E731  NaN is the largest
        anchors = []
        for t in sorted({w[6] if w[6] == w[6] else math.nan for w in page if w[6] is not None}, key=key):
            if not anchors or not (t == anchors[-1] or t - anchors[-1] <= 0.0035 or (t != t and anchors[-1] != anchors[-1])):
                anchors.append(t)
        rows = {}
        for w in page:
            n = 0 if w[6] is None else sum(key(a) <= key(w[6]) for a in anchors)
            rows.setdefault(n, []).append(w)
        for n, r in rows.items():
            want[f"f{f}", n] = [w[3] for w in sorted(r, key=lambda w: (w[4], w[6] is not None, key(w[6] or 0), w[2]))]
    df = spark.createDataFrame(words, "file_id string, page int, word_ord int, text string, x0 double, x1 double, top double")
    out = visual_rows(df, 0.0035)
    assert {(r.file_id, r.row_no): [w.text for w in r.words] for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert plan.count("Exchange") == 1 and "Join" not in plan


def test_grid_with_holes_in_few_exchanges(spark):
    """Spans, overlaps, empty rows between and repeated Ids; cells of a table move once, whatever steps follow."""
    from ledgerloom.operators.ocr import grid_rows

    schema = """file_id string, block_ord bigint, Id string, BlockType string, Text string, Page int,
        Relationships array<struct<Type:string,Ids:array<string>>>, EntityTypes array<string>, SelectionStatus string,
        RowIndex int, ColumnIndex int, RowSpan int, ColumnSpan int"""

    def block(i, id_, kind, text=None, kids=None, at=(None, None), span=(None, None), status=None, page=None):
        return ("f", i, id_, kind, text, page, kids and [("CHILD", kids)], None, status, *at, *span)

    rows = [
        block(1, "t", "TABLE", kids=["a", "b", "c", "d"], page=2), block(2, "u", "TABLE", kids=["d"]), block(3, None, "TABLE", kids=["a"]),
        block(4, "a", "CELL", kids=["w1", "w2"], at=(2, 1), span=(2, 1)), block(5, "b", "CELL", kids=["s1", "s2"], at=(2, 2)),
        block(6, "c", "CELL", kids=["w3"], at=(2, 2)), block(7, "d", "CELL", at=(5, 3)), block(8, "v", "TABLE", kids=["gone"]),
        block(9, "w1", "WORD", "one"), block(9, "w2", "WORD", "two"), block(9, "w3", "WORD", "three"),
        block(9, "s1", "SELECTION_ELEMENT", status="SELECTED"), block(9, "s2", "SELECTION_ELEMENT", status="NOT_SELECTED"),
    ]
    out = grid_rows(spark.createDataFrame([*rows, rows[0], rows[3]], schema))
    got = sorted((r.page, r.table_on_page, r.row_no, "|".join(r.cells)) for r in out.collect())
    none = [(2, 1, n, "||") for n in (1, 4, 5)]
    assert got == sorted([(2, 1, 2, "one one two two|three|"), (2, 1, 3, "one one two two||"), *none, *((1, 2, n, "||") for n in range(1, 6))])
    plan = out._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[-1]
    assert "row_no" not in "".join(line for line in plan.splitlines() if "Exchange" in line)


def test_sheet_rows_are_dealt_anew_before_coercion(spark, monkeypatch):
    """The rows of few sheets do not bind the costly work per row to few tasks."""
    from ledgerloom.operators import ingest

    seen = {}
    monkeypatch.setattr(ingest, "_stored", lambda files, tables, cells, *more: seen.update(cells=cells))
    cells = spark.range(1, 400).selectExpr("'/b.xlsx' path", "0 sheet_idx", "'S' sheet", "cast(id as int) row", "1 col", "concat('v', id) value", "'string' value_type")
    listing = spark.sql("select '/b.xlsx' path, timestamp '2024-01-01' modificationTime, 1L length")
    requests = spark.sql("""select 'R' file_seq_id, '/b.xlsx' path, string(null) file_name, string(null) sub_path, array('S') sheet_identifiers,
        1 headers_row, string(null) format, 'd' source_name, 'r' run_id, '2024-01-01' process_date, false enrich_flow, string(null) recon_id, string(null) event_id""")
    ingest.ingest_sheets(requests, None, listing, cells, pick="all")
    rows = seen["cells"]
    assert sorted(r.src_row for r in rows.collect()) == list(range(2, 400))
    plan = rows._jdf.queryExecution().optimizedPlan().toString().splitlines()[0]
    assert plan.startswith("RepartitionByExpression") and "src_row" in plan


def test_messages_are_read_once_an_epoch(spark, tmp_path):
    """Items and dead letters of invalid messages come from one reading."""
    read = spark.sparkContext.accumulator(0)
    values = ['{"fileSeqId":"A","path":"/a.csv"}', "42", '{"a":', "[]", '[{"fileSeqId":"B","path":"/b.csv"}, {"x":1}]', "[null]"]

    def counted(pair):
        read.add(1)
        return pair

    messages = spark.createDataFrame(spark.sparkContext.parallelize(list(enumerate(values)), 2).map(counted), "offset bigint, value string")
    base = str(tmp_path / "out")
    R.process_epoch(messages, 0, base, lambda c: c.selectExpr(
        "file_seq_id", "0 file_ord", "0 table_no", "1L src_row", "'{}' record", "string(null) error"))
    assert read.value == len(values)
    letters = spark.read.parquet(f"{base}/dead_letters/epoch=0").collect()
    assert sorted((x.original, x.error.split()[0]) for x in letters) == [("42", "neither"), ("[null]", "neither"), ('{"a":', "message")]
    assert {x.file_seq_id for x in spark.read.parquet(f"{base}/results/epoch=0").collect()} == {"A", "B"}


def test_lines_of_a_block_are_settled_in_chunks(spark, tmp_path, monkeypatch):
    """A window held all lines of an input block, and one task numbered up to a million records with their texts."""
    import csv
    import random

    from ledgerloom.operators import batches
    from ledgerloom.sources import delimited

    rnd = random.Random(5)
    cells = [[str(i), "".join(rnd.choice(["x", "\n", '"', ",", "\n"]) for _ in range(rnd.randint(0, 9)))] for i in range(300)]
    for name, rows in (("a", cells), ("b", cells[::-1])):
        with open(tmp_path / f"{name}.csv", "w", newline="") as f:
            csv.writer(f, lineterminator="\n").writerows([["k", "t"], *rows])
    requests = spark.createDataFrame(
        [(n, 0, f"{tmp_path}/{n}.csv", ",", 1) for n in ("a", "b")], "file_seq_id string, file_ord int, path string, delimiter string, headers_row int")
    monkeypatch.setattr(delimited, "CHUNK", 7)
    read = delimited.read_delimited(spark, requests, str(tmp_path))
    got = {n: [r.cells for r in read.cells.filter(f"file_seq_id = '{n}'").orderBy("src_row").collect()] for n in ("a", "b")}
    assert got == {"a": cells, "b": cells[::-1]}

    monkeypatch.setattr(batches, "NUMBERED_ROWS", 20)
    numbered = batches.number_records(read.cells.select("file_seq_id", "file_ord", "table_no", "src_row")).collect()
    assert sorted((r.file_seq_id, r.src_row, r.n) for r in numbered) == [(f, i + 2, i) for f in ("a", "b") for i in range(300)]


def test_lines_are_cleaned_where_they_are_not_clean(spark):
    """Clean lines, odd white space, blank, empty and missing lines; no line is cleaned for the test of blank ones."""
    import re

    from ledgerloom.functions import text
    from ledgerloom.plans import repair

    rnd = random.Random(7)
    lines = [None, "", " ", "\xa0 　", "a clean line, with single blanks.", "a b", " a", "a ", "a  b", "a  b", "\ta", "é è", "a 𝒳 b", "\x7f \x00"]
    lines += ["".join(rnd.choice("ab!~éжж漢\ufeff𝒳\x00\x7f\u2010" + "  " + text.WHITESPACE) for _ in range(rnd.randint(0, 12))) for _ in range(3000)]
    df = spark.createDataFrame(list(enumerate(lines)), "i int, v string")
    got = df.select("i", text.clean(F.col("v")).alias("c"), text.has_text(F.col("v")).alias("some")).collect()
    want = [re.sub(f"[{re.escape(text.WHITESPACE)}]+", " ", x or "").strip(" ") for x in lines]
    assert {r.i: (r.c, r.some) for r in got} == {i: (w, w != "") for i, w in enumerate(want)}
    assert not any(re.search(text.RUNS, x) for x in (lines[4], "é è", "да нет", "漢 字"))  # nothing is put together anew
    plan = repair.noise_filter(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace") == 2  # once to look for noise, once for the result
