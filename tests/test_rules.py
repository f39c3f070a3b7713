"""Edge rows, one per rule of the data model."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from basketlens.functions import bands, text
from basketlens.operators import clean, explore, quality, value
from basketlens.operators.report import Report, run_report
from basketlens.plans import dashboard, etl
from basketlens.session import scratch_path
from basketlens.sources import files


def column(spark, rows, sql, schema="x string"):
    return [r[0] for r in spark.createDataFrame([(v,) for v in rows], schema).select(F.expr(sql)).collect()]


def test_missing_tokens(spark):
    rows = ["None", "NA", "", "  ", " nan ", "High", None]
    assert column(spark, rows, text.missing_to_null("x", text.NA_TOKENS)) == [None] * 5 + ["High", None]


def test_money(spark):
    assert column(spark, ["$1,333.80 ", "abc", None], text.money("x")) == [1333.8, None, None]


def test_flag(spark):
    assert column(spark, ["TRUE", "false", " True ", "yes", None], text.flag("x")) == [1, 0, 1, None, None]


def test_timestamp(spark):
    rows = ["2024-03-01 10:30:00", "3/1/2024", "3/1/2024 7:05", "not a date", None]
    day = dt.datetime(2024, 3, 1)
    expected = [day.replace(hour=10, minute=30), day, day.replace(hour=7, minute=5), None, None]
    assert column(spark, rows, text.timestamp("x")) == expected


def test_calendar(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 12, 29),), (None,)],
                               "Time_of_Purchase timestamp_ntz")
    got = [tuple(r)[1:] for r in clean.add_calendar(df).collect()]
    assert got == [(1, 1, 0), (12, 4, 6), (None, None, None)]


def test_bands(spark):
    ages = spark.createDataFrame([(a,) for a in (18, 25, 26, 70, 71)], "Age int").select(bands.age_band())
    assert [r[0] for r in ages.collect()] == [None, "18-25", "26-35", "55+", None]
    loyal = spark.createDataFrame([(a,) for a in (2, 3, 4, 0)], "Brand_Loyalty int").select(bands.loyalty_band())
    assert [r[0] for r in loyal.collect()] == ["Low (1-2)", "Medium (3)", "High (4-5)", None]
    times = spark.createDataFrame([(a,) for a in (3.0, 7.0, 14.0, 15.0, 3.5, None)], "Time_to_Decision double")
    assert [r[0].split()[0] for r in times.select(bands.decision_band()).collect()] == [
        "Quick", "Normal", "Deliberate", "Slow", "Normal", "Slow"]


def test_flags_treat_null_as_no(spark):
    df = spark.createDataFrame([(None, None), (4, 7), (3, 6)], "Brand_Loyalty int, Customer_Satisfaction int")
    assert [(r.High_Satisfaction, r.Is_Loyal) for r in clean.add_flags(df).collect()] == [(0, 0), (1, 1), (0, 0)]


def test_churn_is_never_zero(spark):
    df = spark.createDataFrame([(10, 100.0, 2), (9, 100.0, 2)],
                               "Customer_Satisfaction int, Purchase_Amount double, Frequency_of_Purchase int")
    rows = value.lifetime_value(df).collect()
    assert rows[0].Churn_Rate == 0.05 and rows[0].CLV == 4000.0
    assert rows[1].Churn_Rate == pytest.approx(0.1)


def test_ties_share_a_tercile(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, 2.0, 2.0, 3.0, 9.0]], "CLV double")
    rows = value.value_segments(df).collect()
    assert {r.CLV_Segment for r in rows if r.CLV == 2.0} == {"Low"}


def test_histogram_closes_last_bin(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 10]], "v double")
    got = explore.histogram(df, "v", 5).collect()
    assert [r["count"] for r in got] == [2, 1, 0, 0, 1]
    assert got[-1].bin_end == 10.0


def test_null_keys_kept_in_reports_and_dropped_in_exploration(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0)], "k string, Purchase_Amount double")
    assert run_report(df, Report(keys=["k"], measures=["num_orders"])).count() == 2
    assert explore.value_shares(df, "k").count() == 1


def test_level_absent_from_data(spark):
    grouped = spark.createDataFrame([("Low", 1.0)], "k string, m double")
    assert [tuple(r) for r in bands.in_level_order(grouped, "k", ["Low", "High"]).collect()] == [
        ("Low", 1.0), ("High", None)]


def test_empty_selection_means_all(spark):
    df = spark.createDataFrame([("a",), ("b",)], "k string")
    assert dashboard.select_rows(df, k=[]).count() == 2
    assert dashboard.select_rows(df, k=["a"]).count() == 1


def test_no_missing_values_notice(spark):
    df = spark.createDataFrame([("a", 1)], "k string, n int")
    assert [tuple(r) for r in quality.missing_by_column(df).collect()] == [("No missing values", 0)]


def test_header_normalising(spark):
    raw = spark.createDataFrame([("1", "2", "3")], [" A B ", "Time_Spent_on_Product_Research(hours)", "C"])
    assert clean.normalise_names(raw).columns == ["A_B", "Research_Hours", "C"]


def test_rows_without_key_fields_are_dropped_before_medians(spark):
    names = ["Customer_ID", "Purchase_Amount", "Customer_Satisfaction", "Brand_Loyalty", "Age", "Research_Hours",
             "Time_to_Decision", "Time_of_Purchase", "Gender"]
    rows = [
        ("1", "$10.00", "7", "4", "20", "1", "5", "2024-01-01", " F "),
        ("2", "$20.00", "6", "", "", "2", "", "bad", ""),
        ("3", "", "6", "1", "90", "9", "9", "2024-01-01", "M"),
        ("4", "$5.00", "9", "5", "30", "", "7", "2024-01-02", "M"),
    ]
    got = {r.Customer_ID: r for r in clean.clean_orders(spark.createDataFrame(rows, names)).collect()}
    assert set(got) == {"1", "2", "4"}
    assert (got["2"].Age, got["2"].Time_to_Decision, got["4"].Research_Hours) == (25.0, 6.0, 1.5)
    assert (got["1"].Gender, got["2"].Gender) == ("F", "Unknown")
    assert (got["2"].Is_Loyal, got["2"].Purchase_Month, got["4"].High_Satisfaction) == (0, None, 1)


def test_empty_load_fails(spark):
    with pytest.raises(etl.EmptyLoad):
        etl.require_rows(0)


def test_csv_keeps_text(spark):
    path = scratch_path(spark, "csv-test")
    df = spark.createDataFrame([("  a ", 'say "x", y', "NA")], "p string, q string, r string")
    files.write_csv(df, path)
    assert tuple(files.read_raw_csv(spark, path).first()) == ("  a ", 'say "x", y', "NA")


def test_csv_quoting(spark, tmp_path):
    """Text written by another CSV program, and read by it."""
    import csv

    rows = [['say "x", y', "2"], ["two\nlines", "3"], ['"', ",,"], ["plain", "back\\slash"]]
    target = tmp_path / "in.csv"
    with target.open("w", newline="") as f:
        csv.writer(f).writerows([["a", "b"], *rows])
    read = files.read_raw_csv(spark, str(target), multi_line=True)
    assert [list(r) for r in read.collect()] == rows
    files.write_csv(read.coalesce(1), str(tmp_path / "out"))
    with next((tmp_path / "out").glob("part-*.csv")).open(newline="") as f:
        assert list(csv.reader(f)) == [["a", "b"], *rows]


def test_pivot_shows_every_level(spark):
    df = spark.createDataFrame([("L", "Unknown", 1.0), ("L", "Agender", 3.0), (None, "x", 1.0)], "r string, c string, v double")
    got = explore.pivot_mean(df, "r", "c", F.avg("v"))
    assert got.columns == ["r", "Agender", "Unknown"] and got.collect() == [("L", 3.0, 1.0)]


def test_empty_load_keeps_the_old_table(spark, tmp_path):
    target = str(tmp_path / "orders")
    spark.range(3).write.parquet(target)
    names = ["Customer_ID", "Age", "Purchase_Amount", "Time_of_Purchase", "Customer_Satisfaction", "Research_Hours", "Time_to_Decision"]
    empty = spark.createDataFrame([], ", ".join(f"{n} string" for n in names))
    with pytest.raises(etl.EmptyLoad):
        etl.load_orders(spark, empty, target)
    assert spark.read.parquet(target).count() == 3


def _raw(spark, ids):
    names = ["Customer_ID", "Age", "Purchase_Amount", "Time_of_Purchase", "Customer_Satisfaction", "Research_Hours", "Time_to_Decision"]
    return spark.createDataFrame([(i, "20", "$5", "2024-04-03", "7", "1", "3") for i in ids], ", ".join(f"{n} string" for n in names))


def test_a_load_that_dies_before_the_swap_leaves_the_old_table(spark, tmp_path, monkeypatch):
    target = str(tmp_path / "orders")
    etl.load_orders(spark, _raw(spark, ["1", "2"]), target)
    reader = files.read_table(spark, target)

    def killed(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(files, "publish_version", killed)
        with pytest.raises(KeyboardInterrupt):
            etl.load_orders(spark, _raw(spark, ["3"]), target)
    assert {r.Customer_ID for r in files.read_table(spark, target).collect()} == {"1", "2"}
    etl.load_orders(spark, _raw(spark, ["4"]), target)
    assert {r.Customer_ID for r in files.read_table(spark, target).collect()} == {"4"}
    # Who began to read the version before still can.
    assert {r.Customer_ID for r in reader.collect()} == {"1", "2"}
    etl.load_orders(spark, _raw(spark, ["5"]), target)
    assert len(list((tmp_path / "orders" / files.VERSIONS).iterdir())) == 2


def test_malformed_records_are_quarantined(spark, tmp_path):
    source = tmp_path / "in.csv"
    source.write_text('a,b\n1,2\n3\n4,5,6\n"x, y",NA\n')
    read = {(r.a, r.b, r._malformed) for r in files.read_raw_records(spark, str(source)).collect()}
    assert {(a, b) for a, b, bad in read if bad is None} == {("1", "2"), ("x, y", "NA")}
    assert {bad for _, _, bad in read if bad is not None} == {"3", "4,5,6"}


def test_load_counts_the_quarantined(spark, tmp_path):
    source, target = tmp_path / "in.csv", str(tmp_path / "orders")
    header = "Customer_ID,Age,Purchase_Amount,Time_of_Purchase,Customer_Satisfaction,Time_Spent_on_Product_Research(hours),Time_to_Decision"
    source.write_text(header + "\n1,20,$5,2024-04-03,7,1,3\nNA\n2,20,$6,2024-04-03,7,1,3,more\n3,30,$7,2024-04-03,7,1,4\n")
    metrics = etl.load_orders(spark, files.read_raw_records(spark, str(source)), target)
    assert (metrics.rows_in, metrics.rows_out, metrics.quarantined_rows, metrics.columns_in) == (2, 2, 2, 7)
    assert {r.record for r in files.read_table(spark, f"{target}-quarantine").collect()} == {"NA", "2,20,$6,2024-04-03,7,1,3,more"}
    assert files.MALFORMED not in files.read_table(spark, target).columns


def test_load_takes_formats_and_tokens(spark, tmp_path):
    rows = [("1", "20", "$5", "03.04.2024", "7", "1", "-"), ("2", "30", "$6", "soon", "8", "2", "3"), ("3", "40", "$7", None, "8", "2", "5")]
    names = ["Customer_ID", "Age", "Purchase_Amount", "Time_of_Purchase", "Customer_Satisfaction", "Research_Hours", "Time_to_Decision"]
    raw = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
    metrics = etl.load_orders(spark, raw, str(tmp_path / "orders"), ["-"], ["dd.MM.yyyy"])
    got = {r.Customer_ID: r for r in files.read_table(spark, str(tmp_path / "orders")).collect()}
    assert metrics.unparsed_times == 1 and metrics.rows_out == 3
    assert got["1"].Time_of_Purchase == dt.datetime(2024, 4, 3) and got["1"].Time_to_Decision == 4.0


def test_functions_travel_to_workers_without_the_package(tmp_path):
    """A driver started elsewhere: only its own path knows the package."""
    import os
    import subprocess
    import sys
    from pathlib import Path

    script = f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parent.parent)!r})
from basketlens.operators import stats
from basketlens.session import build_session
spark = build_session("elsewhere", "local[1]", spark__ui__enabled="false", spark__sql__shuffle__partitions="1")
df = spark.createDataFrame([(g, float(v)) for g in (0, 1) for v in range(g, 9)], "g int, v double")
print("p", stats.t_test(df, "g", "v").first().p_value)
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "p 0." in done.stdout, done.stderr[-1500:]
