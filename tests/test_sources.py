import hashlib
import zipfile

import pytest
from pyspark.sql import functions as F

from barforge.sources import tape, upkeep

LINES = ["1,10.5,2,21.0,1704067200000,True,True", "2,11.0,1,11.0,1704067201000000,false,True", "x,y,z"]


def test_csv(spark, tmp_path):
    (tmp_path / "a.csv").write_text("\n".join(LINES) + "\n")
    rows = tape.read_csv(spark, str(tmp_path)).orderBy("trade_id").collect()
    assert [(r.trade_id, r.price, r.isBuyerMaker, r.isBestMatch, str(r.time)) for r in rows] == [(1, 10.5, True, True, "2024-01-01 00:00:00"), (2, 11.0, False, True, "2024-01-01 00:00:01")]


def test_zip_and_checksum(spark, tmp_path):
    path = tmp_path / "a.zip"
    with zipfile.ZipFile(path, "w") as z:
        z.writestr("a.csv", "id,price,qty,quote_qty,time,is_buyer_maker,is_best_match\n" + "\n".join(LINES[:2]))
        z.writestr("b.csv", "\n".join([LINES[1], *(f"{i},1,1,1,1704067200000,true,true" for i in range(5, 30))]))
    rows = tape.read_zips(spark, str(tmp_path)).orderBy("trade_id").collect()
    assert [r.trade_id for r in rows] == [1, 2, *range(5, 30)]
    assert tape.checksums(spark, str(tmp_path)).first().sha256 == hashlib.sha256(path.read_bytes()).hexdigest()


def test_append_and_pack(spark, tmp_path):
    old = spark.sql("select timestamp_ntz'2024-01-01' + make_dt_interval(id) as time, id from range(10)")
    new = spark.sql("select timestamp_ntz'2024-01-01' + make_dt_interval(id) as time, id from range(20)")
    assert upkeep.append_new(old, new).count() == 10
    assert upkeep.append_new(old.limit(0), new).count() == 20
    upkeep.pack(new, str(tmp_path / "packed"), 2)
    assert spark.read.parquet(str(tmp_path / "packed")).count() == 20


@pytest.mark.parametrize(("name", "kind"), [("BTC_imbalance_1.parquet", "imbalance"), ("standard.parquet", "standard"), ("x", "other")])
def test_labels(spark, name, kind):
    assert spark.range(1).select(upkeep.file_label(F.lit(name)).alias("k")).first().k == kind


def test_calendar(spark):
    assert upkeep.calendar(spark, "2024-01-01", "2024-03-01", "1 month").count() == 3


def test_archives_of_markets(spark):
    dates = upkeep.calendar(spark, "2024-02-01", "2024-02-01")
    url = lambda **how: upkeep.archive_urls(dates, "https://a.example/data/", "XY", **how).first().url
    assert url() == "https://a.example/data/XY/XY-trades-2024-02-01.zip"
    assert url(market="um") == "https://a.example/data/futures/um/daily/trades/XY/XY-trades-2024-02-01.zip"
    assert url(market="cm", monthly=True) == "https://a.example/data/futures/cm/monthly/trades/XY/XY-trades-2024-02.zip"
    assert url(market="spot") == "https://a.example/data/spot/daily/trades/XY/XY-trades-2024-02-01.zip"


def test_sums_decide_states(spark):
    files = spark.createDataFrame([("file:/x/a.zip", "AA"), ("file:/x/b.zip", "bb"), ("file:/x/c.zip", "cc")], "path string, sha256 string")
    sums = spark.createDataFrame([("aa  a.zip",), ("b0 *b.zip",), ("",)], "value string")
    got = {r.path[-5:]: r.state for r in upkeep.verified(files, sums).collect()}
    assert got == {"a.zip": "completed", "b.zip": "failed", "c.zip": "pending"}


def test_archives_are_converted_and_counted(spark, tmp_path):
    import zipfile

    def put(name, *files):
        with zipfile.ZipFile(tmp_path / name, "w") as z:
            for k, text in enumerate(files):
                z.writestr(f"{k}.csv", text)

    put("a.zip", "1,10.5,2,21,1700000000000,True,True\n1,10.5,2,21,1700000000000,True,True\n")  # an id twice in one file stays
    put("b.zip", "time,price,qty,quote_qty,id,is_buyer_maker\n1700000000001,11,1,11,5,false\n")  # a header in another order
    put("c.zip", "7,1,1,1,1700000000002,true\n", "7,2,2,4,1700000000003,true\n" + "8,3,1,3,1700000000004,false\n" * 2)
    rows = {(r.trade_id, r.price, r.isBuyerMaker) for r in tape.read_zips(spark, str(tmp_path)).collect()}
    assert rows == {(1, 10.5, True), (5, 11.0, False), (7, 1.0, True), (8, 3.0, False)}
    assert upkeep.convert(spark, str(tmp_path), str(tmp_path / "out")) == (6, 6)
    assert upkeep.pack_by_size(tape.read_zips(spark, str(tmp_path)), str(tmp_path / "packed"), 1000, 400) == 3
    packed = spark.read.parquet(str(tmp_path / "packed"))
    assert packed.columns == [f.name for f in tape.TRADE_SCHEMA.fields] and packed.count() == 6


def test_csv_by_header(spark, tmp_path):
    (tmp_path / "t.csv").write_text("price,id,time,qty\n2.5,3,1700000000000,1\nbad,x,1,1\n")
    rows = tape.read_csv(spark, str(tmp_path / "t.csv"), header=True).collect()
    assert [(r.trade_id, r.price, r.quoteQty, r.isBestMatch) for r in rows] == [(3, 2.5, None, False)]
    (tmp_path / "s.csv").write_text("3,2.5,1,2.5,1700000000000,true\n")
    assert tape.read_csv(spark, str(tmp_path / "s.csv"), best_match=False).first().isBuyerMaker


def test_bars_and_experiments_are_found_again(spark, tmp_path):
    bars = spark.createDataFrame([(1.0, 2), (3.0, 4)], "params double, close int")
    upkeep.write_bars(bars, str(tmp_path / "bars"))
    assert upkeep.load_bars(spark, str(tmp_path / "bars")).count() == 2
    assert upkeep.load_bars(spark, str(tmp_path / "bars"), 3.0).first().close == 4
    upkeep.write_experiment(str(tmp_path / "runs" / "one"), bars, {"span": 20, "name": "x"})
    row = upkeep.experiments(spark, str(tmp_path / "runs")).first()
    assert (row.folder, row.span, row["name"]) == ("one", 20, "x")
