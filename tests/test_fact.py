"""Star-schema semantics on literal tables: first, fan-out, cohorts, fills."""

from pyspark.sql import functions as F

from lateline.config import DEFAULT_CONFIG
from lateline.operators import fact as FT, marts

from fulfilment_fixtures import make_tables, order

SELLERS = [("A", 10000, "x", "SP"), ("B", 10001, "y", "RJ")]
CUSTOMERS = [("c1", "u1", 20000, "z", "SP")]
PRODUCTS = [("p1", "cat", 1.0, 1.0, 1.0, 1.0), ("p2", None, None, 1.0, 1.0, 1.0)]
CAT = [("cat", "cat_en")]


def _base_orders():
    return [
        # o1: late (delivered after estimate), two reviews, sellers A (line 1) and B (line 2)
        order("o1", "2017-08-01 10:00", "2017-08-01 11:00", "2017-08-02 10:00",
              "2017-08-20 10:00", "2017-08-10 00:00"),
        # o2: on time, B's first order (2017Q1)
        order("o2", "2017-02-01 10:00", "2017-02-01 11:00", "2017-02-02 10:00",
              "2017-02-05 10:00", "2017-02-10 00:00"),
        # o3: no items
        order("o3", "2017-03-01 10:00", "2017-03-01 11:00", "2017-03-02 10:00",
              "2017-03-05 10:00", "2017-03-10 00:00"),
    ]


ITEMS = [("o1", 2, "p2", "B", 20.0, 2.0), ("o1", 1, "p1", "A", 10.0, None),
         ("o2", 1, "p2", "B", 5.0, 1.0)]
REVIEWS = [("o1", 5), ("o1", 1), ("o2", 4)]


def test_fact_grain_first_cohort_fills(spark):
    t = make_tables(spark, _base_orders(), ITEMS, SELLERS, CUSTOMERS, REVIEWS, PRODUCTS, CAT)
    f = FT.fact_deliveries(t, DEFAULT_CONFIG)
    rows = {(r.order_id, r.review_score): r for r in f.collect()}
    assert len(rows) == 4                                   # S18: o1 fans out to 2 rows
    o1 = rows[("o1", 5.0)]
    assert o1.seller_id == "A" and o1.product_id == "p1"    # S15 first by line
    assert o1.seller_cohort == "2017Q3"                     # S21 A's first order
    assert o1.price == 30.0 and o1.freight_value == 2.0     # S16 sum skips nulls
    assert o1.product_category_name_en == "cat_en"
    o2 = rows[("o2", 4.0)]
    assert o2.seller_cohort == "2017Q1"                     # B's earliest order
    o3 = rows[("o3", 0.0)]                                  # S25 missing review -> 0
    assert o3.seller_id is None and o3.seller_cohort is None    # S23
    assert o3.freight_bucket is None                        # S24 null bucket


def test_first_skips_null_s15(spark):
    items = spark.createDataFrame([("o", 1, "p1", None, 1.0, 1.0), ("o", 2, "p2", "x", 1.0, None)],
                                  "order_id string, order_item_id int, product_id string, "
                                  "seller_id string, price double, freight_value double")
    r = FT.items_agg(items).collect()[0]
    assert r.seller_id == "x" and r.product_id == "p1"


def test_all_null_sum_is_zero_s16(spark):
    items = spark.createDataFrame([("o", 1, "p", "s", None, None)],
                                  "order_id string, order_item_id int, product_id string, "
                                  "seller_id string, price double, freight_value double")
    r = FT.items_agg(items).collect()[0]
    assert r.price == 0.0 and r.freight_value == 0.0


def test_seller_rate_row_level_s19(spark):
    t = make_tables(spark, _base_orders()[:2], [("o1", 1, "p1", "A", 1.0, 1.0), ("o2", 1, "p1", "A", 1.0, 1.0)],
                    SELLERS, CUSTOMERS, REVIEWS, PRODUCTS, CAT)
    f = FT.fact_deliveries(t, DEFAULT_CONFIG)
    s = marts.seller_performance_all(f, DEFAULT_CONFIG).collect()[0]
    assert s.total_orders == 2 and s.late_orders == 2
    assert abs(s.late_rate - 2 / 3) < 1e-9


def test_chronic_and_new_problem_s30(spark):
    cfg = DEFAULT_CONFIG
    df = spark.createDataFrame(
        [("a", 20, 0.2), ("b", 20, 0.21), ("c", 19, 0.21), ("d", 19, 1.0), ("e", 20, 1.0)],
        "seller_id string, total_orders long, late_rate double")
    flags = df.select("seller_id",
                      ((F.col("late_rate") > cfg.chronic_rate) & (F.col("total_orders") >= 20)).cast("int").alias("ch"),
                      ((F.col("total_orders") < 20) & (F.col("late_rate") == 1.0)).cast("int").alias("np"))
    got = {r.seller_id: (r.ch, r.np) for r in flags.collect()}
    assert got == {"a": (0, 0), "b": (1, 0), "c": (0, 0), "d": (0, 1), "e": (1, 0)}


def test_pruned_facts_equal_the_whole_one(spark):
    from collections import Counter

    from lateline.config import SYNTHETIC_CONFIG as SYN
    from lateline.sources.synthetic import synthetic_tables
    from fulfilment_fixtures import SF0001
    t = synthetic_tables(spark, SF0001)
    whole = FT.fact_deliveries(t, SYN).persist()
    for cols in (tuple(c for c in marts.SELLER_COLS if c != "price"), marts.REGIONAL_COLS, marts.COHORT_COLS, ("freight_bucket",), ("product_category_name_en", "product_id"),
                 ("order_id", "review_score"), ("seller_state",)):
        part = FT.fact_deliveries(t, SYN, columns=cols)
        assert part.columns == [c for c in whole.columns if c in cols]
        assert Counter(map(tuple, part.collect())) == Counter(map(tuple, whole.select(*part.columns).collect())), cols


def test_orders_without_items_skip_the_item_joins(spark):
    # a third of all orders has no item: their null keys must not meet in one task
    orders = [order(f"o{i}", "2017-01-01 10:00", "2017-01-01 11:00", "2017-01-02 10:00", "2017-01-05 10:00", "2017-01-10 00:00") for i in range(90)]
    items = [(f"o{i}", 1, f"p{i % 4}", f"s{i % 7}", 10.0, float(i)) for i in range(90) if i % 3]
    t = make_tables(spark, orders, items, sellers=[(f"s{i}", 1, "city", "SP") for i in range(7)], customers=[("c1", "u1", 1, "city", "RJ")],
                    products=[(f"p{i}", "cat", 1.0, 1.0, 1.0, 1.0) for i in range(4)], cat_trans=[("cat", "category")])
    f = FT.fact_deliveries(t, DEFAULT_CONFIG)
    got = f.select("order_id", "seller_id", "seller_state", "seller_cohort", "product_category_name_en", "customer_state").collect()
    assert len(got) == 90
    bare = [r for r in got if r.seller_id is None]
    assert len(bare) == 30 and all((r.seller_state, r.seller_cohort, r.product_category_name_en, r.customer_state) == (None, None, "unknown", "RJ") for r in bare)
    assert all((r.seller_state, r.seller_cohort, r.product_category_name_en) == ("SP", "2017Q1", "category") for r in got if r.seller_id)
