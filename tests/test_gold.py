"""Gold facts on small literal frames: NULLs, orphans, fan-out and ties."""

import datetime as dt
import math
import random
import struct

import pytest

from stratum.operators.ranking import primary_value_by_window
from stratum.operators.refine import latest_per_key, version_order
from stratum.plans import gold

TS = dt.datetime


@pytest.fixture()
def frames(spark):
    orders = spark.createDataFrame([
        # order, customer, status, purchase, delivered, estimated
        ("o1", "c1", "delivered", TS(2017, 1, 1, 23, 59, 59), TS(2017, 1, 2, 0, 0, 1), TS(2017, 1, 10)),
        ("o2", "c2", "delivered", TS(2017, 1, 1), TS(2017, 2, 1), TS(2017, 1, 10)),     # late
        ("o3", "c1", "shipped", TS(2017, 1, 5), None, TS(2017, 1, 10)),                # no delivery
        ("o4", "c9", "delivered", TS(2017, 1, 5), TS(2017, 1, 1), TS(2017, 1, 10)),    # before purchase
    ], "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp,"
       " order_delivered_customer_date timestamp, order_estimated_delivery_date timestamp")
    items = spark.createDataFrame([
        ("o1", 1, "p1", "s1", 10.0, 1.0),
        ("o1", 2, "p1", "s1", 20.0, None),    # NULL freight: item left out of the sum
        ("o2", 1, "p2", "s1", 5.0, 0.5),
        ("o2", 2, "p2", "s1", 5.0, 0.5),      # two items of one seller in a late order
        ("o3", 1, "pX", "s2", 7.0, 0.7),      # unknown product
        ("o5", 1, "p1", "s2", 3.0, 0.3),      # order missing, but reviewed
    ], "order_id string, order_item_id int, product_id string, seller_id string, price double,"
       " freight_value double")
    customers = spark.createDataFrame(
        [("c1", "SP"), ("c2", "RJ")], "customer_id string, customer_state string")
    sellers = spark.createDataFrame([("s1",), ("s2",), ("s3",)], "seller_id string")
    products = spark.createDataFrame(
        [("p1", "toys", 100, 1, 2, 3), ("p2", "books", 200, 4, 5, 6)],
        "product_id string, product_category_name string, product_weight_g int,"
        " product_length_cm int, product_height_cm int, product_width_cm int")
    reviews = spark.createDataFrame([
        ("r1", "o1", 5), ("r2", "o1", None), ("r3", "o2", 2), ("r4", "o2", 4), ("r5", "o5", 1),
    ], "review_id string, order_id string, review_score int")
    return dict(orders=orders, items=items, customers=customers, sellers=sellers,
                products=products, reviews=reviews)


def test_fact_sales(frames):
    f = frames
    rows = {r.order_id: r for r in gold.fact_sales(f["orders"], f["items"], f["customers"]).collect()}
    assert set(rows) == {"o1", "o2", "o3", "o4"}
    assert rows["o1"].total_order_value == pytest.approx(11.0)        # NULL freight item skipped
    assert rows["o1"].delivery_time_days == 1                          # calendar-day boundary
    assert rows["o2"].total_order_value == pytest.approx(11.0)
    assert rows["o3"].delivery_time_days is None
    assert rows["o4"].total_order_value is None                        # order without items
    assert rows["o4"].delivery_time_days == -4
    assert rows["o4"].customer_state is None                           # unknown customer


def test_fact_seller_performance(frames):
    f = frames
    df = gold.fact_seller_performance(f["sellers"], f["items"], f["orders"], f["reviews"])
    rows = {r.seller_id: r for r in df.collect()}
    assert set(rows) == {"s1", "s2", "s3"}
    s1 = rows["s1"]
    assert s1.sum_revenue == pytest.approx(40.0)
    assert s1.count_overdue_delivery == 2          # item grain: late order o2 counted per item
    # item-weighted mean of order means: o1 (5.0) x2, o2 (3.0) x2
    assert s1.avg_review_score == pytest.approx(4.0)
    s2 = rows["s2"]
    assert s2.sum_revenue == pytest.approx(10.0)
    assert s2.count_overdue_delivery == 0
    assert s2.avg_review_score is None             # o5 is reviewed but missing from orders
    s3 = rows["s3"]
    assert s3.sum_revenue is None and s3.count_overdue_delivery is None and s3.avg_review_score is None
    assert [r.seller_id for r in df.collect()][0] == "s1"   # most late first


def test_fact_product_performance(frames):
    f = frames
    rows = gold.fact_product_performance(f["items"], f["products"], f["reviews"]).collect()
    assert len(rows) == 6                                       # item grain
    unknown = [r for r in rows if r.order_id == "o3"][0]
    assert unknown.product_id is None and unknown.product_category_name is None
    o1 = [r for r in rows if r.order_id == "o1"]
    assert all(r.avg_review_score == pytest.approx(5.0) for r in o1)   # NULL score ignored
    o5 = [r for r in rows if r.order_id == "o5"][0]
    assert o5.avg_review_score == pytest.approx(1.0)


def test_fact_payment_summary_ties_and_nulls(spark, frames):
    payments = spark.createDataFrame([
        ("o1", 1, "credit", 3, 50.0),
        ("o1", 2, "voucher", 1, 50.0),      # same value, later sequence
        ("o2", 1, None, 1, 10.0),           # NULL type
        ("o2", 2, "boleto", 2, None),       # NULL value ranks last
        ("o9", 1, "credit", 1, 1.0),        # payment without order
    ], "order_id string, payment_sequential int, payment_type string,"
       " payment_installments int, payment_value double")
    df = gold.fact_payment_summary(payments, frames["orders"], frames["customers"])
    rows = {r.order_id: r for r in df.collect()}
    assert rows["o1"].primary_payment_type == "credit"
    assert rows["o1"].total_methods_distincts_payments == 2
    assert rows["o1"].total_payment_value == pytest.approx(100.0)
    assert rows["o2"].primary_payment_type is None
    assert rows["o2"].total_methods_distincts_payments == 1
    assert rows["o2"].max_installments == 2
    assert rows["o9"].customer_state is None
    assert [r.order_id for r in df.collect()][0] == "o1"

    window = {r.order_id: r.primary_payment_type for r in primary_value_by_window(
        payments, ["order_id"], "payment_type", "payment_value", "payment_sequential",
        "primary_payment_type").collect()}
    assert window == {k: v.primary_payment_type for k, v in rows.items()}


def test_dim_dates(spark):
    rows = gold.dim_dates(spark, "2016-01-01", "2016-03-01").collect()
    assert len(rows) == 61
    assert rows[0].date_id == dt.date(2016, 1, 1) and rows[0].day_of_week == 6
    assert (rows[0].year, rows[0].month, rows[0].day) == (2016, 1, 1)
    assert rows[-1].date_id == dt.date(2016, 3, 1)


def test_latest_per_key_total_order(spark):
    df = spark.createDataFrame([
        ("k", 1, "b", "f2"), ("k", 1, "a", "f1"), ("k", 2, "z", "f0"), ("j", None, "q", "f9"),
        ("j", 0, "q", "f8"),
    ], "key string, _v int, val string, _src string")
    out = {r.key: (r._v, r.val) for r in latest_per_key(df, ["key"], version_order(df, ["key"], "_v")).collect()}
    assert out == {"k": (2, "z"), "j": (0, "q")}       # NULL version ranks last


def test_dim_dates_default_end_is_today_plus_90(spark):
    rows = gold.dim_dates(spark, dt.date.today()).collect()
    assert len(rows) == 91
    assert rows[-1].date_id == dt.date.today() + dt.timedelta(days=90)


def test_order_number_orders_like_the_double(spark):
    from stratum.functions.expressions import with_order_number
    rng = random.Random(4)
    values = [0.0, -0.0, 1.0, -1.0, 2.0, 0.5, 5e-324, -5e-324, 2.2250738585072014e-308, 2.225073858507201e-308,
              1.7976931348623157e308, float("inf"), float("-inf"), 0.1, 0.30000000000000004, 0.3, 1e15 + 0.125]
    values += [math.ldexp(1.0, e) for e in range(-1074, 1024, 7)]
    values += [math.nextafter(math.ldexp(1.0, e), d) for e in range(-1000, 1024, 11) for d in (0.0, math.inf)]
    values += [struct.unpack("<d", struct.pack("<Q", rng.getrandbits(64)))[0] for _ in range(3000)]
    values = [v for v in values if v == v]
    df = with_order_number(spark.createDataFrame([(v,) for v in [*values, float("nan"), None]], "v double"), "v", "n")
    got = [r.n for r in df.collect()]
    for v, n in zip(values, got):
        assert abs(n) == struct.unpack("<q", struct.pack("<d", abs(v)))[0] and (n < 0) == (v < 0)
    assert got[-1] < min(got[:-1]) and got[-2] > max(got[:-2])


def test_payment_totals_against_the_window(spark):
    """Many ties in value and sequence, nulls everywhere; one order holds a third of the rows."""
    rng = random.Random(9)
    rows = [(rng.choice(["hot", f"o{rng.randrange(300)}", f"o{rng.randrange(300)}"]), rng.choice([None, 1, 2, 3, -5, 2**31 - 1]),
             rng.choice(["a", "b", "c", None]), rng.choice([None, 1, 12]),
             rng.choice([None, 1.0, 1.0, 0.1 + 0.2, 0.3, -4.0, 1e300, float("inf")])) for _ in range(4000)]
    df = spark.createDataFrame(rows, "order_id string, payment_sequential int, payment_type string, "
                                     "payment_installments int, payment_value double")
    got = {r.order_id: r for r in gold.payment_totals(df).collect()}
    want = {r.order_id: r.p for r in primary_value_by_window(
        df, ["order_id"], "payment_type", "payment_value", "payment_sequential", "p").collect()}
    assert {k: r.primary_payment_type for k, r in got.items()} == want
    for k, r in got.items():
        own = [x for x in rows if x[0] == k]
        assert r.total_methods_distincts_payments == len({x[2] for x in own} - {None})
        assert r.max_installments == max((x[3] for x in own if x[3]), default=None)
        assert r.total_payment_value == pytest.approx(sum(x[4] for x in own if x[4] is not None)) \
            or all(x[4] is None for x in own) and r.total_payment_value is None
