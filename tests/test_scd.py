"""SCD2 / SCD1 merges against hand cases and a row-by-row model."""

import datetime as dt
import random

from pyspark.sql import functions as F

from starmart import schemas as S
from starmart.operators.scd import scd1_merge, scd2_merge

AS_OF = dt.date(2024, 3, 10)
DAY_BEFORE = AS_OF - dt.timedelta(days=1)
START = dt.date(1900, 1, 1)
ATTRS = ["product_name", "brand", "category", "subcategory", "catalog_price"]
STAGED_SCHEMA = "product_business_key long, product_name string, brand string, category string, subcategory string, catalog_price decimal(10,2), _seq long"


def _dim(spark, rows):
    return spark.createDataFrame(rows, S.DIM_PRODUCT)


def _merge(spark, dim_rows, staged_rows, as_of=AS_OF):
    dim = _dim(spark, dim_rows)
    staged = spark.createDataFrame(staged_rows, STAGED_SCHEMA)
    d = scd2_merge(dim, staged, entity="product", key="product_key",
                   bk="product_business_key", attrs=ATTRS, as_of=as_of)
    out = d.all_versions(dim.filter(~F.col("is_current")))
    return ([tuple(r) for r in out.orderBy("product_key").collect()],
            [r["message"] for r in d.events.collect()])


def _versions(rows):
    """Versions without their surrogate keys, as a sorted list."""
    return sorted((r[1:] for r in rows), key=repr)


def test_new_key_is_inserted_open_from_1900(spark):
    rows, events = _merge(spark, [], [(1, "a", "b", "c", "d", None, 1)])
    assert rows == [(1, 1, "a", "b", "c", "d", None, START, None, True)]
    assert events == ["Inserted new product BK=1"]


def test_null_to_value_and_value_to_null_are_changes(spark):
    cur = [(7, 1, "a", None, "c", "d", None, START, None, True),
           (8, 2, "a", "b", "c", "d", None, START, None, True)]
    rows, _ = _merge(spark, cur, [(1, "a", "x", "c", "d", None, 1),
                                  (2, "a", None, "c", "d", None, 2)])
    by_key = {r[0]: r for r in rows}
    assert by_key[7][-2:] == (DAY_BEFORE, False) and by_key[8][-2:] == (DAY_BEFORE, False)
    assert {r[0] for r in rows} == {7, 8, 9, 10}
    assert by_key[9][1] == 1 and by_key[9][-3:] == (AS_OF, None, True)


def test_null_to_null_is_no_change(spark):
    cur = [(3, 1, "a", None, "c", "d", None, START, None, True)]
    rows, events = _merge(spark, cur, [(1, "a", None, "c", "d", None, 1)])
    assert rows == cur and events == []


def test_a_then_b_for_a_new_key(spark):
    rows, events = _merge(spark, [], [(5, "A", "b", "c", "d", None, 1),
                                      (5, "B", "b", "c", "d", None, 2)])
    assert rows == [(1, 5, "A", "b", "c", "d", None, START, DAY_BEFORE, False),
                    (2, 5, "B", "b", "c", "d", None, AS_OF, None, True)]
    assert events == ["Inserted new product BK=5", "SCD2 change for BK=5"] or \
        sorted(events) == sorted(["Inserted new product BK=5", "SCD2 change for BK=5"])


def test_a_b_a_with_current_a(spark):
    cur = [(1, 5, "A", "b", "c", "d", None, START, None, True)]
    rows, _ = _merge(spark, cur, [(5, "A", "b", "c", "d", None, 1),
                                  (5, "B", "b", "c", "d", None, 2),
                                  (5, "A", "b", "c", "d", None, 3)])
    assert rows == [(1, 5, "A", "b", "c", "d", None, START, DAY_BEFORE, False),
                    (2, 5, "B", "b", "c", "d", None, AS_OF, DAY_BEFORE, False),
                    (3, 5, "A", "b", "c", "d", None, AS_OF, None, True)]


def test_key_absent_from_staging_is_unchanged(spark):
    cur = [(1, 5, "A", "b", "c", "d", None, START, None, True)]
    rows, events = _merge(spark, cur, [(6, "Z", "b", "c", "d", None, 1)])
    assert rows[0] == cur[0] and rows[1][:2] == (2, 6) and len(events) == 1


def test_new_keys_follow_max_key(spark):
    cur = [(7, 1, "a", "b", "c", "d", None, START, None, True)]
    rows, _ = _merge(spark, cur, [(4, "x", "b", "c", "d", None, 1),
                                  (2, "x", "b", "c", "d", None, 2),
                                  (3, "x", "b", "c", "d", None, 3)])
    assert [(r[0], r[1]) for r in rows] == [(7, 1), (8, 2), (9, 3), (10, 4)]


# --- row-by-row model --------------------------------------------------------

def _model(dim_rows, staged_rows, as_of):
    rows = [list(r) for r in dim_rows]
    nxt = max([r[0] for r in rows], default=0) + 1
    for s in sorted(staged_rows, key=lambda r: r[-1]):
        bk, attrs = s[0], list(s[1:-1])
        cur = [r for r in rows if r[1] == bk and r[9]]
        if not cur:
            rows.append([nxt, bk, *attrs, START, None, True])
            nxt += 1
        elif cur[0][2:7] != attrs:
            cur[0][8], cur[0][9] = as_of - dt.timedelta(days=1), False
            rows.append([nxt, bk, *attrs, as_of, None, True])
            nxt += 1
    return [tuple(r) for r in rows]


def test_matches_row_by_row_model_on_random_batches(spark):
    rng = random.Random(7)
    vals = ["p", "q", None]
    for trial in range(4):
        dim_rows = []
        for k in range(1, 9):
            if rng.random() < 0.6:
                dim_rows.append((len(dim_rows) + 1, k, rng.choice(vals), "b", "c", "d", None,
                                 START, None, True))
        staged = [(rng.randint(1, 10), rng.choice(vals), rng.choice(["b", None]), "c", "d",
                   None, i) for i in range(25)]
        got, _ = _merge(spark, dim_rows, staged)
        want = _model(dim_rows, staged, AS_OF)
        assert _versions(got) == _versions(want), f"trial {trial}"
        keys = sorted(r[0] for r in got)
        assert keys == list(range(1, len(got) + 1))


def test_scd1_last_by_seq_wins_and_key_is_kept(spark):
    dim = spark.createDataFrame([(3, 10, "old", "c", "C", "R", "T", dt.date(2000, 1, 1))],
                                S.DIM_STORE)
    staged = spark.createDataFrame(
        [(10, "first", "c", "C", "R", "T", dt.date(2000, 1, 1), 1),
         (10, "second", "c", "C", "R", "T", dt.date(2000, 1, 1), 2),
         (11, "new", "c", "C", "R", "T", dt.date(2000, 1, 1), 3)],
        "store_business_key long, store_name string, city string, country string, region string, store_type string, opening_date date, _seq long")
    d = scd1_merge(dim, staged, entity="store", key="store_key", bk="store_business_key",
                   attrs=["store_name", "city", "country", "region", "store_type", "opening_date"])
    rows = {r["store_business_key"]: r for r in d.current.collect()}
    assert rows[10]["store_key"] == 3 and rows[10]["store_name"] == "second"
    assert rows[11]["store_key"] == 4
    assert d.events.count() == 3


def test_hot_key_holding_most_of_the_batch(spark):
    """One key with 1,200 staged rows (runs of repeats and changes) next to a
    few ordinary keys: the result equals the row-by-row model."""
    rng = random.Random(11)
    dim_rows = [(1, 1, "p", "b", "c", "d", None, START, None, True),
                (2, 2, "q", "b", "c", "d", None, START, None, True)]
    staged, value = [], "p"
    for i in range(1200):
        if rng.random() < 0.3:
            value = rng.choice(["p", "q", "r"])
        staged.append((1, value, "b", "c", "d", None, i))
    staged += [(2, "q", "b", "c", "d", None, 2000), (3, "z", "b", "c", "d", None, 2001)]
    dim = _dim(spark, dim_rows)
    st = spark.createDataFrame(staged, STAGED_SCHEMA).repartition(6)
    d = scd2_merge(dim, st, entity="product", key="product_key", bk="product_business_key",
                   attrs=ATTRS, as_of=AS_OF)
    got = [tuple(r) for r in d.all_versions(dim.filter(~F.col("is_current"))).collect()]
    assert _versions(got) == _versions(_model(dim_rows, staged, AS_OF))
    assert sum(1 for r in got if r[1] == 1 and r[-1]) == 1


def test_fast_path_matches_model_on_random_single_row_batches(spark):
    """Unique keys per batch take the equi-join path; same model, same result."""
    rng = random.Random(5)
    vals = ["p", "q", None]
    for trial in range(3):
        dim_rows = [(k, k, rng.choice(vals), "b", "c", "d", None, START, None, True)
                    for k in range(1, 13) if rng.random() < 0.7]
        dim_rows = [(i + 1, *r[1:]) for i, r in enumerate(dim_rows)]
        keys = rng.sample(range(1, 16), 10)
        staged = [(k, rng.choice(vals), rng.choice(["b", None]), "c", "d", None, i)
                  for i, k in enumerate(keys)]
        got, events = _merge(spark, dim_rows, staged)
        assert _versions(got) == _versions(_model(dim_rows, staged, AS_OF)), f"trial {trial}"
        assert sorted(r[0] for r in got) == list(range(1, len(got) + 1))
        assert len(events) == len(got) - len(dim_rows)
