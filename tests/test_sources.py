import datetime as dt

from seriesloom.sources import read_csv, write_forecast


def test_quoted_csv_with_mark_and_blank_line(spark, tmp_path):
    text = '﻿"Date","Price","Vol."\n"Sep 15, 2023","104.934","-"\n"Sep 14, 2023","105.052","24.38K"\n\n'
    path = tmp_path / "rates.csv"
    path.write_text(text, encoding="utf-8")
    df = read_csv(spark, str(path), "Date string, Price double, volume string", {"Date": ["MMM dd, yyyy"]}, drop=["volume"])
    assert [tuple(r) for r in df.orderBy("Date").collect()] == [
        (dt.date(2023, 9, 14), 105.052),
        (dt.date(2023, 9, 15), 104.934),
    ]


def test_row_number_column_and_mixed_dates(spark, tmp_path):
    path = tmp_path / "rows.csv"
    path.write_text(",day,merchant,total\n0,2018-01-01,535,12\n1,2018-02,535,\n")
    df = read_csv(
        spark, str(path), "row int, day string, merchant int, total double", {"day": ["yyyy-MM-dd", "yyyy-MM"]}, drop=["row"]
    )
    assert df.columns == ["day", "merchant", "total"]
    assert sorted(tuple(r) for r in df.collect()) == [(dt.date(2018, 1, 1), 535, 12.0), (dt.date(2018, 2, 1), 535, None)]


def test_forecast_comes_back_as_written(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5), (2, 3.5)], "id int, sales double")
    write_forecast(df, str(tmp_path / "csv"), "csv")
    assert sorted(read_csv(spark, str(tmp_path / "csv"), "id int, sales double").collect()) == [(1, 2.5), (2, 3.5)]
    first = next((tmp_path / "csv").glob("*.csv")).read_text().splitlines()[0]
    assert first == "id,sales"
    write_forecast(df, str(tmp_path / "pq"), partition_by=["id"])
    assert spark.read.parquet(str(tmp_path / "pq")).where("id = 2").first()["sales"] == 3.5
