import datetime as dt

import pytest

from candlewick.operators import clean, enrich, star
from candlewick.sources import csv_bars, literal
from candlewick.sources.spine import date_spine
from tests.assets import DEFAULT_ASSETS

RUN_TS = "2024-01-01T00:00:00Z"

# padded and mixed-case headers, extra columns, a bad number, a blank
# date, an invalid bar, a duplicate line.
F1 = """SNo, Date ,HIGH,Low,Open,Close,Adj Close,Volume
1,2020-01-01 23:59:59,11,9,10,10.5,0,1
2,2020-01-02 23:59:59,12,10,10.5,11,0,1
3,2020-01-03 23:59:59,oops,10,11,12,0,1
4,,12,10,11,12,0,1
5,2020-01-05 23:59:59,9,13,12,12.5,0,1
6,2020-01-06 23:59:59,14,12,12.5,13,0,1
6,2020-01-06 23:59:59,14,12,12.5,13,0,1
7,2020-01-08 23:59:59,13,11,13,12,0,1
"""


def write(path, text):
    path.write_text(text)
    return str(path)


def test_f1_dirty_csv_golden(spark, tmp_path):
    f = write(tmp_path / "btc.csv", F1)
    silver, plan = csv_bars.read_bars_csv(spark, {"btc": f}, RUN_TS)
    assert sorted(r["date"] for r in silver.collect()) == [
        "2020-01-01", "2020-01-02", "2020-01-05", "2020-01-06", "2020-01-08"]
    rep = csv_bars.ingest_report(silver, plan).collect()
    assert [(r["coin_id"], r["status"], r["rows"]) for r in rep] == [("btc", "loaded", 5)]
    enriched = enrich.enrich(clean.stage_prices(silver))
    fact = star.fact_price(enriched, star.dim_asset(literal.metadata_rows(spark, DEFAULT_ASSETS)),
                           star.dim_date(date_spine(spark)))
    got = {r["price_sk"]: r for r in fact.collect()}
    expect = {
        "07b6a680613926b2ff3251ea9e03a985": (2.0, 5.0, None, 10.5),
        "0b7d2035915e673bc8b15a71ebb4ac36": (2.0, 4.7619, 0.5, 10.75),
        "676302e9935c4e71598a48a93b0c5e30": (2.0, 4.0, 2.0, 11.5),
        "f71574350a014fda85f041314f38b23c": (2.0, -7.6923, -1.0, 11.625),
    }
    assert set(got) == set(expect)
    for sk, (rng, ret, chg, ma) in expect.items():
        r = got[sk]
        assert (r["daily_range"], r["daily_return_pct"], r["price_change"]) == (rng, ret, chg)
        assert r["ma_7d"] == ma and r["ma_30d"] == ma


def test_f2_different_header_orders_do_not_shift(spark, tmp_path):
    a = write(tmp_path / "a.csv", "Date,Open,High,Low,Close\n2020-01-01,1,3,0.5,2\n")
    b = write(tmp_path / "b.csv", "close,low,high,open,trade date\n20,5,30,10,2020-01-01\n")
    silver, _ = csv_bars.read_bars_csv(spark, {"a": a, "b": b}, RUN_TS)
    got = {r["coin_id"]: (r["open"], r["high"], r["low"], r["close"]) for r in silver.collect()}
    assert got == {"a": (1.0, 3.0, 0.5, 2.0), "b": (10.0, 30.0, 5.0, 20.0)}


def test_f3_missing_column_and_missing_file(spark, tmp_path):
    ok = write(tmp_path / "ok.csv", "Date,Open,High,Low,Close\n2020-01-01,1,3,0.5,2\n")
    no_close = write(tmp_path / "nc.csv", "Date,Open,High,Low\n2020-01-01,1,3,0.5\n")
    silver, plan = csv_bars.read_bars_csv(
        spark, {"ok": ok, "nc": no_close, "gone": str(tmp_path / "gone.csv")}, RUN_TS)
    report = csv_bars.ingest_report(silver, plan)
    status = {r["coin_id"]: r["status"] for r in report.collect()}
    assert status == {"ok": "loaded", "nc": "missing_columns", "gone": "missing"}
    assert silver.count() == 1
    with pytest.raises(csv_bars.NoDataError):
        csv_bars.read_bars_csv(spark, {"nc": no_close, "gone": str(tmp_path / "gone.csv")},
                               RUN_TS)


def test_two_date_headers_rejected():
    with pytest.raises(ValueError):
        csv_bars.header_map(["Date", "Open", "High", "Low", "Close", "Trade Date"])


def test_f4_bad_date_strict_fails_lenient_rejects(spark, tmp_path):
    f = write(tmp_path / "bad.csv",
              "Date,Open,High,Low,Close\n2020-01-01,1,3,0.5,2\nbad,1,3,0.5,2\n")
    silver, _ = csv_bars.read_bars_csv(spark, {"x": f}, RUN_TS)
    with pytest.raises(Exception, match="unparsable date"):
        silver.collect()
    lenient, _ = csv_bars.read_bars_csv(spark, {"x": f}, RUN_TS, strict_dates=False)
    assert lenient.count() == 1
    rej = csv_bars.rejected_dates(spark, {"x": f}).collect()
    assert [r["date_text"] for r in rej] == ["bad"]


def test_f5_number_coercion(spark, tmp_path):
    rows = ["2020-01-0%d,%s,10,1,2" % (i + 1, v)
            for i, v in enumerate(["12d", "NaN", "-", '"1,234.5"', " 12.5 ", "1e3"])]
    f = write(tmp_path / "n.csv", "Date,Open,High,Low,Close\n" + "\n".join(rows) + "\n")
    silver, _ = csv_bars.read_bars_csv(spark, {"x": f}, RUN_TS)
    got = sorted((r["date"], r["open"]) for r in silver.collect())
    assert got == [("2020-01-05", 12.5), ("2020-01-06", 1000.0)]


def test_provenance_columns(spark, tmp_path):
    f = write(tmp_path / "p.csv", "Date,Open,High,Low,Close\n2020-01-01,1,3,0.5,2\n")
    r = csv_bars.read_bars_csv(spark, {"x": f}, RUN_TS)[0].first()
    assert (r["coin_id"], r["source"], r["extracted_at"]) == ("x", "local_csv", RUN_TS)
    staged = clean.stage_prices(csv_bars.read_bars_csv(spark, {"x": f}, RUN_TS)[0]).first()
    assert staged["extracted_at"] == dt.datetime(2024, 1, 1)
    assert staged["price_date"] == dt.date(2020, 1, 1)


def test_date_formats_by_source(spark, tmp_path):
    us = write(tmp_path / "us.csv", "Date,Open,High,Low,Close\n04/29/2013,1,3,0.5,2\n")
    iso = write(tmp_path / "iso.csv", "Date,Open,High,Low,Close\n2013-04-30 23:59:59,1,3,0.5,2\n")
    for named in ({"us": "MM/dd/yyyy"}, None):  # by name, inferred
        silver, _ = csv_bars.read_bars_csv(spark, {"us": us, "iso": iso}, RUN_TS, date_format=named)
        assert {r["coin_id"]: r["date"] for r in silver.collect()} == {"us": "2013-04-29", "iso": "2013-04-30"}
    with pytest.raises(Exception, match="unparsable date"):
        csv_bars.read_bars_csv(spark, {"us": us}, RUN_TS, date_format=csv_bars.ISO)[0].collect()


def bars_file(path, dates):
    path.parent.mkdir(parents=True, exist_ok=True)
    return write(path, "Date,Open,High,Low,Close\n" + "".join(f"{d},1,3,0.5,2\n" for d in dates))


@pytest.mark.parametrize("dates, want", [
    (["1/2/2020", "1/13/2020"], {"2020-01-02", "2020-01-13"}),
    (["2/1/2020", "13/1/2020 10:30"], {"2020-01-02", "2020-01-13"}),
    (["", "05/05/2020 23:59:59"], {"2020-05-05"}),  # both orders say the same
    (["20200102", "20201231"], {"2020-01-02", "2020-12-31"}),
    (["2020/1/2"], {"2020-01-02"}), (["3.12.2020"], {"2020-12-03"}),
    (["", ""], set())])
def test_inferred_dates(spark, tmp_path, dates, want):
    f = bars_file(tmp_path / "x.csv", dates)
    silver, _ = csv_bars.read_bars_csv(spark, {"x": f}, RUN_TS)
    assert {r["date"] for r in silver.collect()} == want


def test_dates_of_a_folder_are_inferred_together(spark, tmp_path):
    """The second file alone is ambiguous; ISO files of the folder stay ISO."""
    for name, dates in (("a", ["1/13/2020"]), ("b", ["1/2/2020"]), ("c", ["2020-01-05"])):
        bars_file(tmp_path / "d" / f"{name}.csv", dates)
    silver, _ = csv_bars.read_bars_csv(spark, {"x": str(tmp_path / "d")}, RUN_TS)
    assert {r["date"] for r in silver.collect()} == {"2020-01-13", "2020-01-02", "2020-01-05"}


@pytest.mark.parametrize("dates, match", [(["1/2/2020"], "fit .*d/M/yyyy"), (["1/13/2020", "13/1/2020"], "unparsable date"),
                                          (["soon"], "unparsable date")])
def test_ambiguous_and_unknown_dates_raise(spark, tmp_path, dates, match):
    f = bars_file(tmp_path / "x.csv", dates)
    with pytest.raises(csv_bars.DateFormatError, match=match):
        csv_bars.read_bars_csv(spark, {"x": f}, RUN_TS)
    # lenient: the pattern that parses the most, if one does
    if len(dates) == 1 and dates[0] == "soon":
        assert csv_bars.read_bars_csv(spark, {"x": f}, RUN_TS, strict_dates=False)[0].count() == 0
    more = bars_file(tmp_path / "y.csv", ["1/13/2020", "1/14/2020", "13/1/2020"])
    silver, _ = csv_bars.read_bars_csv(spark, {"y": more}, RUN_TS, strict_dates=False)
    assert {r["date"] for r in silver.collect()} == {"2020-01-13", "2020-01-14"}


def test_asset_without_a_surviving_row_is_reported(spark, tmp_path):
    ok = write(tmp_path / "ok.csv", "Date,Open,High,Low,Close\n2020-01-01,1,3,0.5,2\n")
    bad = write(tmp_path / "bad.csv", "Date,Open,High,Low,Close\n2020-01-01,x,x,x,x\n")
    silver, plan = csv_bars.read_bars_csv(spark, {"ok": ok, "bad": bad}, RUN_TS)
    got = {r["coin_id"]: (r["status"], r["rows"], r["first_date"])
           for r in csv_bars.ingest_report(silver, plan).collect()}
    assert got == {"ok": ("loaded", 1, "2020-01-01"), "bad": ("loaded", 0, None)}


def test_folders_of_one_header(spark, tmp_path):
    for k in range(3):
        bars_file(tmp_path / "many" / f"p={k}" / "f.csv", [f"2020-01-0{k + 1}"])
    silver, plan = csv_bars.read_bars_csv(spark, {"m": str(tmp_path / "many")}, RUN_TS)
    assert silver.count() == 3 and {r["coin_id"] for r in silver.collect()} == {"m"}
    assert list(plan["groups"].values()) == [[(str(tmp_path / "many"), "m")]]


@pytest.mark.parametrize("headers", [
    (",Date,Open,High,Low,Close", ",Date,Close,Low,High,Open"),  # a column without a name: a pandas index
    ("Date,Open,High,Low,Close", "Date,Close,Low,High,Open"),
    ("x,Date,x,Open,High,Low,Close", "Date,Close,Low,High,Open,x,X"),  # repeated names
    ("\ufeffDate,Open,High,Low,Close", 'Close,"Date, local",Low,High,Open')])
def test_two_layouts_in_one_folder(spark, tmp_path, headers):
    want = {"open": "1", "high": "4", "low": "0.5", "close": "2"}
    folder = tmp_path / "mixed"
    (folder / "deep").mkdir(parents=True)
    days = []
    for k, header in enumerate(headers * 2):
        day = f"2020-01-0{k + 1}"
        names = csv_bars.split_header(header.lstrip("\ufeff"))
        cells = [day if "date" in n.lower() else want.get(n.lower(), str(k)) for n in names]
        write((folder / "deep" if k > 1 else folder) / f"{k}.csv", f"{header}\n{','.join(cells)}\n")
        days.append(day)
    write(folder / "empty.csv", "")
    silver, plan = csv_bars.read_bars_csv(spark, {"m": str(folder)}, RUN_TS)
    assert sorted((r.date, r.open, r.high, r.low, r.close, r.coin_id) for r in silver.collect()) == [
        (d, 1.0, 4.0, 0.5, 2.0, "m") for d in days]
    assert len(plan["groups"]) == 2 and all(len(p) == 2 for p in plan["groups"].values())


def test_a_file_without_a_column_skips_its_asset(spark, tmp_path):
    ok = bars_file(tmp_path / "ok" / "a.csv", ["2020-01-01"])
    bars_file(tmp_path / "part" / "a.csv", ["2020-01-01"])
    write(tmp_path / "part" / "b.csv", "Date,Open,High,Low\n2020-01-02,1,3,0.5\n")
    silver, plan = csv_bars.read_bars_csv(spark, {"ok": ok, "part": str(tmp_path / "part")}, RUN_TS)
    assert {r.coin_id for r in silver.collect()} == {"ok"}
    (asset, status, detail), = plan["skipped"]
    assert (asset, status) == ("part", "missing_columns") and detail.endswith("/part/b.csv")


def test_a_file_that_came_or_changed_after_the_plan_fails(spark, tmp_path):
    folder = tmp_path / "late"
    bars_file(folder / "a.csv", ["2020-01-01"])
    for name, header in (("a", "Date,Close,Low,High,Open"), ("b", "Date,Close,Low,High,Open")):
        plan = csv_bars.plan_csv_files(spark, {"m": str(folder)})
        (key, _), = plan["groups"].items()
        write(folder / f"{name}.csv", f"{header}\n2020-01-09,1,3,0.5,2\n")
        with pytest.raises(Exception, match="(?i)header"):
            csv_bars._read_group(spark, plan, key, True, ",").collect()


def test_only_the_heads_of_large_files_are_read(spark, tmp_path):
    """More rows than a batch holds, split into several parts when read."""
    rows = "".join(f"{k},2020-01-{k % 28 + 1:02d},1,3,0.5,2\n" for k in range(60_000))
    f = write(tmp_path / "big.csv", "No,Date,Open,High,Low,Close\n" + rows)
    g = write(tmp_path / "big2.csv", "No,Date,Close,High,Low,Open\n" + rows)
    heads = {r.file.rsplit("/", 1)[1]: (r.line, r.sample) for r in csv_bars.read_heads(spark, [f, g]).collect()}
    assert heads == {"big.csv": ("No,Date,Open,High,Low,Close", "2020-01-01"),
                     "big2.csv": ("No,Date,Close,High,Low,Open", "2020-01-01")}
    silver, _ = csv_bars.read_bars_csv(spark, {"x": f, "y": g}, RUN_TS)
    assert {(r.coin_id, r.open, r.close) for r in silver.collect()} == {("x", 1.0, 2.0), ("y", 2.0, 1.0)}
    assert silver.count() == 56


def test_one_file_of_two_assets_and_paths_inside_each_other(spark, tmp_path):
    inner = bars_file(tmp_path / "top" / "in" / "a.csv", ["2020-01-01"])
    bars_file(tmp_path / "top" / "b.csv", ["2020-01-02"])
    silver, _ = csv_bars.read_bars_csv(spark, {"all": str(tmp_path / "top"), "one": inner,
                                               "both": [str(tmp_path / "top" / "in"), inner]}, RUN_TS)
    assert sorted((r.coin_id, r.date) for r in silver.collect()) == [
        ("all", "2020-01-01"), ("all", "2020-01-02"), ("both", "2020-01-01"), ("one", "2020-01-01")]
