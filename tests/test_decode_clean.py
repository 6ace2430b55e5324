import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from tideline.functions.decode import epoch_ms, json_decode, parse_time, payload_text
from tideline.functions.fixed import INVOICE_DATE_FORMAT
from tideline.functions.timeparts import with_time_parts
from tideline.operators.clean import retail_clean, retail_rejects

ORDER = "order_id INT, order_owner STRING, order_value INT, timestamp BIGINT"


def test_malformed_json_gives_null_row(spark):
    df = spark.createDataFrame([("junk",), ('{"order_id": 3, "order_owner": "Pita Pan"}',)], "value STRING")
    got = rows(json_decode(df, ORDER), "order_id", "order_owner")
    assert got == [(None, None), (3, "Pita Pan")]


def test_malformed_json_can_be_dropped(spark):
    df = spark.createDataFrame([("junk",), ('{"order_id": 3}',)], "value STRING")
    assert rows(json_decode(df, ORDER, keep_bad=False), "order_id") == [(3,)]


def test_wrong_field_type_nulls_that_field(spark):
    df = spark.createDataFrame([('{"order_id": "x", "order_owner": "a"}',)], "value STRING")
    r = json_decode(df, ORDER).collect()[0]
    assert r.order_id is None


def test_payload_bytes_to_text(spark):
    df = spark.createDataFrame([(bytearray(b'{"a": 1}'),)], "value BINARY")
    assert payload_text(df).collect()[0].value == '{"a": 1}'


def test_epoch_milliseconds(spark):
    df = spark.createDataFrame([(1648044703123,)], "ms BIGINT")
    assert df.select(epoch_ms("ms").alias("t")).collect()[0].t == dt.datetime(2022, 3, 23, 14, 11, 43, 123000)


def test_invoice_dates_padded_and_not(spark):
    df = spark.createDataFrame([("12/1/2010 8:26",), ("12/01/2010 08:26",), ("x",)], "d STRING")
    got = [r.t for r in df.select(parse_time("d", INVOICE_DATE_FORMAT).alias("t")).collect()]
    assert got[0] == got[1] == dt.datetime(2010, 12, 1, 8, 26)
    assert got[2] is None



def _inv(spark, data):
    return spark.createDataFrame(data, "Country STRING, UnitPrice STRING, Quantity STRING, InvoiceDate STRING")


def test_clean_rejects_bad_rows(spark):
    df = _inv(spark, [
        ("U.K.", "2.5", "3", "12/1/2010 8:26"),    # kept
        ("42", "2.5", "3", "12/1/2010 8:26"),      # no letter
        ("", "2.5", "3", "12/1/2010 8:26"),        # empty country
        ("UK", "abc", "3", "12/1/2010 8:26"),      # bad price
        ("UK", "2.5", "-1", "12/1/2010 8:26"),     # negative quantity
        ("UK", "2.5", "0", "12/1/2010 8:26"),      # zero quantity
        ("UK", "2.5", None, "12/1/2010 8:26"),     # NULL quantity
        ("UK", "0", "2", "12/1/2010 8:26"),        # zero price
        ("UK", "1.0", "2", "not a date"),          # kept with NULL date
    ])
    got = rows(retail_clean(df))
    assert got == [("U.K.", 2.5, 3, dt.datetime(2010, 12, 1, 8, 26)), ("UK", 1.0, 2, None)] or \
        got == [("UK", 1.0, 2, None), ("U.K.", 2.5, 3, dt.datetime(2010, 12, 1, 8, 26))]
    reasons = dict(rows(retail_rejects(df)))
    assert reasons == {"ok": 1, "bad_country": 2, "bad_price": 1, "quantity_not_positive": 2,
                       "bad_quantity": 1, "price_not_positive": 1, "no_date": 1}


def test_time_parts_zero_padded(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 5, 7, 9),)], "ts TIMESTAMP_NTZ")
    r = with_time_parts(df, "ts", prefix="ingest_").collect()[0]
    assert (r.ingest_year, r.ingest_month, r.ingest_day, r.ingest_hour) == ("2024", "03", "05", "07")
    r2 = with_time_parts(df, "2022-03-23 14:11:43", two_digit_year=True).collect()[0]
    assert (r2.year, r2.month, r2.day, r2.hour) == ("22", "03", "23", "14")
    assert with_time_parts(df, None).select(F.length("year")).collect()[0][0] == 4


def test_prices_out_of_range_are_rejected_with_a_reason(spark):
    raw = [(c, p, "2", "1/1/2024 1:00") for c, p in
           [("FR", "1e20"), ("FR", "NaN"), ("FR", "Infinity"), ("FR", "0.000004"), ("FR", "-Infinity")]]
    df = spark.createDataFrame(raw, "Country STRING, UnitPrice STRING, Quantity STRING, InvoiceDate STRING")
    assert [r.UnitPrice for r in retail_clean(df).collect()] == [0.000004]
    got = {r.reason: r.n for r in retail_rejects(df).collect()}
    assert got == {"price_out_of_range": 3, "ok": 1, "price_not_positive": 1}
    from tideline.plans.retail import sales_from_clean
    assert [r.Total_sales for r in sales_from_clean(retail_clean(df)).collect()] == [0.000008]


def test_messages_are_parsed_once(spark, tmp_path):
    path = str(tmp_path / "m")
    spark.createDataFrame([('{"Country":"FR","UnitPrice":"1","Quantity":"2"}',)], "value STRING").write.text(path)
    from tideline.plans.inputs import INVOICE_SCHEMA
    p = retail_clean(json_decode(spark.read.text(path), INVOICE_SCHEMA))._jdf.queryExecution().optimizedPlan().toString()
    assert p.count("from_json") == 1
