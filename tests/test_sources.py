"""CSV sources with declared schemas, the seven-source reader, missing sources."""

import tempfile

import pytest
from pyspark.sql import functions as F

from lateline import schemas
from lateline.sources import scan_csv, scan_sources, synthetic_tables

from fulfilment_fixtures import SF0001


def _write_csv(df, path):
    out = df
    for f in df.schema.fields:
        if f.dataType.typeName() == "timestamp":
            out = out.withColumn(f.name, F.date_format(f.name, "yyyy-MM-dd HH:mm:ss"))
    out.coalesce(1).write.option("header", True).csv(path)


def test_csv_roundtrip_with_declared_schema(spark):
    d = tempfile.mkdtemp(prefix="csv-", dir="/tmp")
    t = synthetic_tables(spark, SF0001)
    paths = {}
    for name, df in t.as_dict().items():
        paths[name] = f"{d}/{name}"
        _write_csv(df, paths[name])
    back = scan_sources(spark, paths, fmt="csv")
    assert back.orders.schema == schemas.ORDERS or [f.dataType for f in back.orders.schema] == \
        [f.dataType for f in schemas.ORDERS]
    for name, df in t.as_dict().items():
        a = df.select(*[F.col(f.name).cast(f.dataType) for f in schemas.SOURCES[name].fields])
        b = back.as_dict()[name]
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, name


def test_missing_source_is_an_error(spark):
    with pytest.raises(FileNotFoundError):
        scan_sources(spark, {"orders": "/nonexistent"})


def test_unparsable_timestamp_fails(spark):
    d = tempfile.mkdtemp(prefix="csvbad-", dir="/tmp")
    with open(f"{d}/o.csv", "w") as fh:
        fh.write("order_id,customer_id,order_status,order_purchase_timestamp,order_approved_at,"
                 "order_delivered_carrier_date,order_delivered_customer_date,order_estimated_delivery_date\n")
        fh.write("o1,c1,delivered,not-a-time,,,,\n")
    with pytest.raises(Exception):
        scan_csv(spark, f"{d}/o.csv", schemas.ORDERS).collect()


def _file(text):
    d = tempfile.mkdtemp(prefix="csvnames-", dir="/tmp")
    with open(f"{d}/f.csv", "w") as fh:
        fh.write(text)
    return f"{d}/f.csv"


def test_csv_columns_are_taken_by_name(spark):
    """Wider files, other column order, quoted line breaks where a source has them."""
    p = _file('review_id,order_id,review_comment_message,review_score,extra\n'
              'r1,o1,"two\nlines, one ""quote""",5,x\nr2,o2,,,y\n')
    got = scan_csv(spark, p, schemas.REVIEWS, multiline=True).orderBy("order_id").collect()
    assert [tuple(r) for r in got] == [("o1", 5), ("o2", None)]
    p = _file("product_width_cm,product_id,product_photos_qty,product_category_name,product_length_cm,"
              "product_height_cm,product_weight_g\n1.5,p1,3,cat,2,3,400\n")
    r = scan_csv(spark, p, schemas.PRODUCTS).first()
    assert (r.product_id, r.product_width_cm, r.product_weight_g) == ("p1", 1.5, 400.0)


def test_csv_missing_column_is_an_error(spark):
    with pytest.raises(ValueError, match="review_score"):
        scan_csv(spark, _file("order_id,review_id\no1,r1\n"), schemas.REVIEWS)
