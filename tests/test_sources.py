import gzip
import os

import pytest

from clickweave.sinks import compact_files, write_text, write_tsv
from clickweave.sources import hour_range_glob, hour_range_scan, read_text_lines, union_logs
from clickweave.sources.documents import doc_day_glob
from clickweave.functions.time import hours_in_range


def test_hour_glob_same_day():
    assert hour_range_glob("/b", "2024-01-01-05", "2024-01-01-07") == "/b/{2024-01-01/05,2024-01-01/06,2024-01-01/07}/*"


def test_hour_glob_across_midnight_and_whole_days():
    g = hour_range_glob("/b/", "2024-01-01-22", "2024-01-03-01")
    assert g == "/b/{2024-01-01/22,2024-01-01/23,2024-01-02/*,2024-01-03/00,2024-01-03/01}/*"


def test_hour_ranges_month_and_leap_edges():
    hs = hours_in_range("2024-02-28-23", "2024-03-01-00")
    assert [h.strftime("%Y-%m-%d-%H") for h in hs][:2] == ["2024-02-28-23", "2024-02-29-00"]
    assert len(hs) == 1 + 24 + 1
    assert len(hours_in_range("2023-02-28-23", "2023-03-01-00")) == 2
    with pytest.raises(ValueError):
        hours_in_range("2024-01-02-00", "2024-01-01-00")


def _write_hour(base, day, hour, lines_):
    d = os.path.join(base, day, hour)
    os.makedirs(d, exist_ok=True)
    with gzip.open(os.path.join(d, "part-0.gz"), "wt") as f:
        f.write("\n".join(lines_) + "\n")
    with open(os.path.join(d, "notes.txt"), "w") as f:  # not .gz: ignored
        f.write("ignored\n")


def test_hour_range_scan_reads_each_hour_once_and_skips_missing(spark, tmp_dir):
    for day, hour in (("2024-01-01", "22"), ("2024-01-01", "23"), ("2024-01-02", "05"), ("2024-01-03", "00"),
                      ("2024-01-03", "02")):
        _write_hour(tmp_dir, day, hour, [f"{day}-{hour}-a", f"{day}-{hour}-b", ""])
    got = sorted(r.value for r in hour_range_scan(spark, tmp_dir, "2024-01-01-23", "2024-01-03-01").collect())
    assert got == ["2024-01-01-23-a", "2024-01-01-23-b", "2024-01-02-05-a", "2024-01-02-05-b",
                   "2024-01-03-00-a", "2024-01-03-00-b"]
    assert hour_range_scan(spark, tmp_dir, "2025-01-01-00", "2025-01-01-03").count() == 0


def test_union_is_a_bag(spark, tmp_dir):
    _write_hour(tmp_dir, "2024-01-01", "00", ["x"])
    _write_hour(tmp_dir, "2024-01-01", "01", ["y"])
    g1 = hour_range_glob(tmp_dir, "2024-01-01-00", "2024-01-01-01")
    g2 = hour_range_glob(tmp_dir, "2024-01-01-01", "2024-01-01-02")
    assert sorted(r.value for r in union_logs(spark, [g1, g2]).collect()) == ["x", "y", "y"]


def test_doc_day_glob_two_roots():
    g = doc_day_glob(["/r/a", "/r/b"], "2017-06-01", "2017-06-02")
    assert g == "/r/{a,b}/{2017-06-01,2017-06-02}/*/*"


def test_gzip_tsv_round_trip_and_compaction(spark, tmp_dir):
    df = spark.createDataFrame([("u", None, "vw"), ("v", "d", "clk")], "a string, b string, c string")
    out = os.path.join(tmp_dir, "tsv")
    write_tsv(df, out, compression="gzip", run="r7")
    assert any(f.endswith(".gz") for f in os.listdir(os.path.join(out, "run=r7")))
    back = spark.read.text(out)
    assert sorted((r.value, r.run) for r in back.collect()) == [("u\tnull\tvw", "r7"), ("v\td\tclk", "r7")]
    write_tsv(df.limit(1), out, run="r8")  # another run leaves r7 alone
    assert sorted(os.listdir(out))[:2] == ["run=r7", "run=r8"]
    small = os.path.join(tmp_dir, "small")
    write_text(spark.range(100).selectExpr("cast(id as string) as value"), small, num_files=10)
    compact_files(spark, small, os.path.join(tmp_dir, "compact"), num_files=2)
    parts = [f for f in os.listdir(os.path.join(tmp_dir, "compact")) if f.startswith("part-")]
    assert len(parts) == 2
    assert read_text_lines(spark, os.path.join(tmp_dir, "compact")).count() == 100


def test_blank_lines_of_any_whitespace_are_skipped(spark, tmp_dir):
    d = os.path.join(tmp_dir, "ws")
    os.makedirs(d)
    with open(os.path.join(d, "a.txt"), "w") as f:
        f.write('{"a":1}\n\t\n \r\n\n{"b":2}\r\n')
    assert sorted(r.value.strip() for r in read_text_lines(spark, d).collect()) == ['{"a":1}', '{"b":2}']


def test_max_records_per_file(spark, tmp_dir):
    out = os.path.join(tmp_dir, "capped")
    write_text(spark.range(100).selectExpr("cast(id as string) as value").coalesce(1), out, max_records_per_file=30)
    parts = [f for f in os.listdir(out) if f.startswith("part-")]
    assert len(parts) == 4 and read_text_lines(spark, out).count() == 100
