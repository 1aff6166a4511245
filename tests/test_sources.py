from __future__ import annotations

import csv
import json

import pytest

from histlake.operators.facts import superseded_members, with_unknown_member
from histlake.schema import BASE_COLUMNS, CANONICAL_COLUMNS
from histlake.sources.batches import (
    BatchFile,
    align,
    batch_name,
    drift,
    list_batches,
    natural_order,
    read_batch,
    read_csv,
    read_headers,
    read_log,
    select_batches,
    spans_lines,
)
from histlake.sources.employers import (
    count_issues,
    parse_employers,
    read_json_array,
    read_json_lines,
    read_json_records,
)

from .helpers import CLEAN


def write_csv(path, columns, rows):
    lines = [",".join(columns)] + [",".join(r.get(c) or "" for c in columns) for r in rows]
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")


def test_missing_columns_are_added_and_extras_reported(spark, tmp_path):
    path = tmp_path / "individual_tax_returns_day1.csv"
    columns = [*reversed(BASE_COLUMNS), "surprise"]
    write_csv(path, columns, [{**CLEAN, "postal_code": "018234", "surprise": "!", "occupation": "NA"}])
    got = read_batch(spark, str(path))
    assert got.added == ["batch_date", "record_type"]
    assert got.unexpected == ["surprise"]
    row = got.rows.first()
    assert got.rows.columns == [*CANONICAL_COLUMNS, "row_pos"]
    assert (row.postal_code, row.record_type, row.batch_date) == ("018234", "new", None)
    assert row.occupation == "NA" and row.taxpayer_id == "P1"


def test_default_record_type_fills_blanks_only(spark, tmp_path):
    path = tmp_path / "b.csv"
    write_csv(path, CANONICAL_COLUMNS, [{**CLEAN, "record_type": ""}, {**CLEAN, "record_type": "update"}])
    rows = read_batch(spark, str(path), default_record_type="late_arrival").rows.collect()
    assert sorted(r.record_type for r in rows) == ["late_arrival", "update"]


def test_quoted_line_breaks_are_found_and_read(spark, tmp_path):
    plain, broken, loose = tmp_path / "p.csv", tmp_path / "b.csv", tmp_path / "l.csv"
    plain.write_text('a,b\n1,"x, ""y"""\n2,\n')
    broken.write_text('a,b\n1,"x\ny"\n2,z\n')
    loose.write_text('a,b\n5" pipe,"x\ny"\n2,z\n')
    assert [spans_lines(spark, str(p)) for p in (plain, broken, loose)] == [False, True, True]
    assert [tuple(r)[:2] for r in read_csv(spark, str(plain)).collect()] == [("1", 'x, "y"'), ("2", None)]
    assert [tuple(r)[:2] for r in read_csv(spark, str(broken)).collect()] == [("1", "x\ny"), ("2", "z")]
    assert read_csv(spark, str(loose)).count() == 2


def test_row_position_follows_the_file(spark, tmp_path):
    path = tmp_path / "b.csv"
    path.write_text("a\n" + "\n".join(f"{i:06d}" for i in range(20000)) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = read_csv(spark, str(path))
        assert df.rdd.getNumPartitions() > 1
        assert [r.a for r in df.orderBy("row_pos").collect()] == [f"{i:06d}" for i in range(20000)]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_batches_are_listed_in_natural_order_and_selected_exactly(spark, tmp_path):
    for n in (10, 2, 1):
        write_csv(tmp_path / f"individual_tax_returns_day{n}.csv", CANONICAL_COLUMNS, [CLEAN])
    parts = tmp_path / "individual_tax_returns_day3.csv"
    parts.mkdir()
    for p in ("a", "b"):
        write_csv(parts / f"part-{p}.csv", CANONICAL_COLUMNS, [CLEAN])
    (tmp_path / "notes.csv").write_text("x\n1\n")
    files = list_batches(spark, str(tmp_path))
    assert [f.batch for f in files] == ["day1", "day2", "day3", "day10"]
    assert [f.batch for f in select_batches(files, "day1")] == ["day1"]
    assert select_batches(files) == files
    with pytest.raises(ValueError):
        select_batches(files, "day99")
    log = read_log(spark, files)
    assert sorted((r.batch, r.batch_seq) for r in log.collect()) == [
        ("day1", 1), ("day10", 4), ("day2", 2), ("day3", 3), ("day3", 3),
    ]


def test_batch_date_comes_from_any_row(spark, tmp_path):
    write_csv(
        tmp_path / "individual_tax_returns_day1.csv",
        CANONICAL_COLUMNS,
        [{**CLEAN, "batch_date": ""}, {**CLEAN, "batch_date": "2024-04-15"}],
    )
    log = read_log(spark, list_batches(spark, str(tmp_path)))
    assert {r.batch_date for r in log.collect()} == {"2024-04-15"}


def test_names():
    assert batch_name("file:/x/individual_tax_returns_day7.csv") == "day7"
    assert sorted(["d10", "d9", "d1b", "d1"], key=natural_order) == ["d1", "d1b", "d9", "d10"]


def test_align_other_tables(spark):
    got = align(spark.range(1), ["id", "kind"], {"kind": "k"})
    assert got.rows.first().asDict() == {"id": "0", "kind": "k"}


RECORDS = [
    {"employer_id": "E0", "company_name": "A", "uen": "U", "industry": "I", "address": "R", "employee_count": 450},
    {"employer_id": "E1", "company_name": "A", "uen": None, "industry": "I", "address": "R", "employee_count": "320"},
    {"employer_id": "E2", "company_name": "A", "uen": "U", "industry": "I", "address": "R", "employee_count": 5,
     "z_field": 1, "it's": {"n": 1}},
    {"employee_count": True},
    {"employer_id": "", "uen": "", "employee_count": "many"},
    {"employer_id": 0, "uen": 7, "employee_count": 12.5},
    {"employer_id": 5, "uen": "U", "employee_count": " +1_0 "},
    {"employer_id": "E7", "uen": "U", "employee_count": None},
    {"employer_id": "E8", "uen": "U", "employee_count": 320.0},
    {"employer_id": False, "uen": "U", "employee_count": 99999999999},
    {"employer_id": "E10", "uen": "U", "employee_count": "1.0"},
]
EXPECTED = [
    ("E0", "U", 450, None),
    ("E1", None, 320, "missing uen; employee_count was non-integer; coerced"),
    ("E2", "U", 5, "extra fields: [\"it's\", 'z_field']"),
    ("UNKNOWN_3", None, None, "missing employer_id; missing uen; invalid employee_count type"),
    ("UNKNOWN_4", None, None, "missing employer_id; missing uen; uncoercible employee_count"),
    ("UNKNOWN_5", "7", None, "missing employer_id; uncoercible employee_count"),
    ("5", "U", 10, "employee_count was non-integer; coerced"),
    ("E7", "U", None, "missing employee_count"),
    ("E8", "U", None, "uncoercible employee_count"),
    ("UNKNOWN_9", "U", 99999999999, "missing employer_id"),
    ("E10", "U", None, "uncoercible employee_count"),
]


def test_employer_records(spark, tmp_path):
    path = tmp_path / "employers.json"
    path.write_text(json.dumps(RECORDS, indent=1))
    parsed = parse_employers(read_json_array(spark, str(path)))
    got = {
        r.employer_id: (r.employer_id, r.uen, r.employee_count, r.schema_issue_detail)
        for r in parsed.collect()
    }
    assert [got[e[0]] for e in EXPECTED] == EXPECTED
    assert all(r.has_schema_issues == (r.schema_issue_detail is not None) for r in parsed.collect())
    assert tuple(count_issues(parsed).first()) == (11, 10)
    dim = {r.employer_id: r for r in with_unknown_member(parsed).collect()}
    assert len(dim) == 12
    assert dim["UNKNOWN"].company_name == "Unknown / Self-employed"
    assert dim["UNKNOWN_9"].employee_count is None


def test_json_lines_agree_with_the_array(spark, tmp_path):
    path = tmp_path / "employers.jsonl"
    path.write_text("\n".join(json.dumps(r) for r in RECORDS))
    lines = parse_employers(read_json_lines(spark, str(path))).collect()
    assert sorted(r.schema_issue_detail or "" for r in lines) == sorted(e[3] or "" for e in EXPECTED)


def test_duplicate_employers_collapse(spark):
    from histlake.schema import EMPLOYER_COLUMNS

    rows = [("E1", "B", None, None, None, 1), ("E1", "A", None, None, None, 2), ("UNKNOWN", "X", None, None, None, 3)]
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in EMPLOYER_COLUMNS[:5]) + ", employee_count long")
    got = {r.employer_id: r.company_name for r in with_unknown_member(df).collect()}
    assert got == {"E1": "A", "UNKNOWN": "Unknown / Self-employed"}


def test_repeated_header_names_keep_the_first_column(spark, tmp_path):
    path = tmp_path / "individual_tax_returns_day1.csv"
    path.write_text("NRIC,taxpayer_id,nric,nric,full_name,Full_Name\na,P1,b,c,d,e\n")
    got = read_batch(spark, str(path))
    row = got.rows.first()
    assert (row.taxpayer_id, row.nric, row.full_name) == ("P1", "b", "d")
    assert got.unexpected == ["Full_Name.6", "NRIC.1", "nric.4"]


def test_wide_and_spaced_counts_and_bracket_identifiers(spark, tmp_path):
    records = [
        {"employer_id": "[]", "uen": "U", "employee_count": "\t320\n"},
        {"employer_id": [], "uen": "U", "employee_count": 10**25},
        {"employer_id": "E2", "uen": "U", "employee_count": "\u00a07\u2003"},
    ]
    path = tmp_path / "employers.json"
    path.write_text(json.dumps(records))
    got = {r.employer_id: (r.employee_count, r.schema_issue_detail) for r in parse_employers(read_json_array(spark, str(path))).collect()}
    coerced = "employee_count was non-integer; coerced"
    assert got == {"[]": (320, coerced), "UNKNOWN_1": (None, "missing employer_id"), "E2": (7, coerced)}


def test_last_record_of_an_employer_is_kept_and_others_are_listed(spark, tmp_path):
    path = tmp_path / "employers.json"
    path.write_text(json.dumps([{"employer_id": "E1", "company_name": n} for n in ("A", "C", "B")]))
    parsed = parse_employers(read_json_array(spark, str(path)), keep_pos=True)
    assert {r.employer_id: r.company_name for r in with_unknown_member(parsed).collect()}["E1"] == "B"
    assert sorted(r.company_name for r in superseded_members(parsed).collect()) == ["A", "C"]


def test_batches_with_one_header_are_read_by_one_scan(spark, tmp_path):
    """Twelve batches, three headers, odd names, a folder of part files and an empty file."""
    columns = (BASE_COLUMNS, CANONICAL_COLUMNS, [*reversed(CANONICAL_COLUMNS), "place", "batch_seq"])
    for n in range(1, 13):
        name = f"individual_tax_returns_day{n}{' 100%+x' if n == 5 else ''}.csv"
        rows = [{**CLEAN, "taxpayer_id": f"P{n}-{k}", "batch_date": f"2024-01-{n:02}", "place": "x", "batch_seq": "7"} for k in range(3)]
        if n == 7:
            (tmp_path / name).mkdir()
            write_csv(tmp_path / name / "part-0.csv", columns[n % 3], rows[:1])
            write_csv(tmp_path / name / "part-1.csv", columns[n % 3], rows[1:])
        else:
            write_csv(tmp_path / name, columns[n % 3], rows)
    (tmp_path / "individual_tax_returns_day13.csv").write_text("")
    files = list_batches(spark, str(tmp_path))
    assert len(files) == 12  # an empty file is no batch, unless it is named
    files.append(BatchFile(f"{tmp_path}/individual_tax_returns_day13.csv", "day13"))
    log = read_log(spark, files)
    assert log._jdf.queryExecution().optimizedPlan().toString().count("Relation [") <= 2 * 3
    found = sorted((r.batch_seq, r.batch, r.taxpayer_id, r.occupation, r.batch_date) for r in log.collect())
    want = sorted(
        (i, f.batch, r.taxpayer_id, r.occupation, r.batch_date if i % 3 else None)
        for i, f in enumerate(files[:12], 1)
        for r in read_batch(spark, f.path).rows.collect()
    )
    assert found == want and len(found) == 36
    headers = read_headers(spark, files)
    assert [drift(h.names) for h in headers[:3]] == [([], []), ([], ["batch_seq", "place"]), (["batch_date", "record_type"], [])]
    assert headers[12].names == ()
    plain = [BatchFile(f.path.removeprefix("file:"), f.batch) for f in files]
    assert read_log(spark, plain, headers=headers).count() == 36


def test_only_files_whose_quotes_span_lines_are_not_split(spark, tmp_path):
    for n, text in ((1, "a"), (2, "two\nlines"), (3, 'with "quotes"')):
        with open(tmp_path / f"individual_tax_returns_day{n}.csv", "w", newline="") as f:
            csv.writer(f, lineterminator="\n").writerows([CANONICAL_COLUMNS, [{**CLEAN, "full_name": text}[c] for c in CANONICAL_COLUMNS]])
    files = list_batches(spark, str(tmp_path))
    assert [h.multi_line for h in read_headers(spark, files)] == [False, True, False]
    assert {r.full_name for r in read_log(spark, files).collect()} == {"a", "two\nlines", 'with "quotes"'}


def test_no_json_line_is_fatal_or_lost(spark, tmp_path):
    lines = ['\ufeff{"employer_id": "E1"}', '{"employer_id": "E2"', "", "  ", "[1]", "null", "7", '{"a": 1, "a": 2}', "{}", 'x{"b": 1}']
    (tmp_path / "a.jsonl").write_text("\n".join(lines), encoding="utf-8")
    (tmp_path / "b.jsonl").write_text("")
    good, bad = read_json_records(spark, str(tmp_path))
    assert [r.employer_id for r in parse_employers(good).orderBy("employer_id").collect()][0] == "E1" and good.count() == 2
    assert {r.line: r.reason for r in bad.collect()} == {
        '{"employer_id": "E2"': "not JSON", "[1]": "not an object", "null": "not an object", "7": "not an object",
        '{"a": 1, "a": 2}': "not JSON", 'x{"b": 1}': "not JSON",
    }
    assert all(r.file.endswith("a.jsonl") and r.start == 0 for r in bad.collect())
