"""Test data folders and small source tables."""

import datetime as dt

from lateline import schemas
from lateline.sources.files import Tables

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


def ts(s):
    return None if s is None else dt.datetime.strptime(s, "%Y-%m-%d %H:%M")


def order(oid, purchase, approved, carrier, delivered, estimate, customer="c1", status="delivered"):
    return (oid, customer, status, ts(purchase), ts(approved), ts(carrier), ts(delivered), ts(estimate))


def make_tables(spark, orders, items=(), sellers=(), customers=(), reviews=(), products=(), cat_trans=()):
    S = schemas.SOURCES
    return Tables(**{k: spark.createDataFrame(list(v), S[k]) for k, v in dict(
        orders=orders, items=items, sellers=sellers, customers=customers, reviews=reviews,
        products=products, cat_trans=cat_trans).items()})
