import datetime as dt
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tenderloom.operators import joins
from tenderloom.operators.latest import latest_by, upsert_latest
from tenderloom.operators.mode import most_frequent

TEN, ELEVEN = dt.datetime(2026, 3, 1, 10), dt.datetime(2026, 3, 1, 11)
HISTORY = "k string, v string, etl_period string, loaded_at timestamp_ntz"


def latest_values(spark, rows, **options):
    df = spark.createDataFrame(rows, HISTORY)
    return {r.k: r.v for r in latest_by(df, ["k"], **options).collect()}


@pytest.mark.parametrize(
    "rows, expected",
    [
        ([("a", "old", "202601", ELEVEN), ("a", "new", "202602", TEN)], "new"),
        ([("a", "old", "202601", TEN), ("a", "new", "202601", ELEVEN)], "new"),
        ([("a", "old", "202601", ELEVEN), ("a", "new", "202601", None)], "new"),
        ([("a", "old", "202601", ELEVEN), ("a", "new", None, TEN)], "new"),
        ([("a", "same", "202601", TEN), ("a", "same", "202601", TEN)], "same"),
        ([("a", "x", "202601", TEN), ("a", "b", "202601", TEN)], "b"),
    ],
)
def test_latest_version(spark, rows, expected):
    assert latest_values(spark, rows) == {"a": expected}
    assert latest_values(spark, rows[::-1]) == {"a": expected}


def test_dimension_order_ignores_period(spark):
    rows = [("a", "early", "202602", TEN), ("a", "late", "202601", ELEVEN)]
    assert latest_values(spark, rows, version=("loaded_at",)) == {"a": "late"}
    assert latest_values(spark, rows) == {"a": "early"}


def test_null_keys_are_one_group(spark):
    rows = [(None, "x", "202601", TEN), (None, "y", "202602", TEN), ("a", "z", "202601", TEN)]
    assert latest_values(spark, rows) == {None: "y", "a": "z"}


versions = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", None]),
        st.sampled_from(["x", "y", "z", None]),
        st.sampled_from(["202601", "202602", None]),
        st.sampled_from([TEN, ELEVEN, None]),
    ),
    min_size=1,
    max_size=12,
)


def brute_latest(rows):
    """Highest version first with NULL on top, then the smallest value with NULL first."""

    def rank(row):
        _, value, period, loaded = row
        newest = (period is None, period or "", loaded is None, loaded or dt.datetime.min)
        return newest, value

    best = {}
    for row in rows:
        held = best.get(row[0])
        if held is None or rank(row)[0] > rank(held)[0]:
            best[row[0]] = row
        elif rank(row)[0] == rank(held)[0] and (row[1] is not None, row[1] or "") < (held[1] is not None, held[1] or ""):
            best[row[0]] = row
    return {k: v[1] for k, v in best.items()}


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=versions, seed=st.integers(0, 1000))
def test_latest_matches_brute_force_in_any_order(spark, rows, seed):
    shuffled = rows[:]
    random.Random(seed).shuffle(shuffled)
    df = spark.createDataFrame(shuffled, HISTORY).repartition(1 + seed % 4)
    assert {r.k: r.v for r in latest_by(df, ["k"]).collect()} == brute_latest(rows)


def test_latest_limits_before_the_shuffle(spark, plan_of):
    df = spark.range(100).select(
        (F.col("id") % 3).cast("string").alias("k"),
        F.col("id").cast("string").alias("v"),
        F.concat(F.lit("20260"), F.col("id") % 9).alias("etl_period"),
        F.lit(None).cast("timestamp_ntz").alias("loaded_at"),
    )
    plan = plan_of(latest_by(df, ["k"]))
    assert "row_number(), 1, Partial" in plan and "row_number(), 1, Final" in plan


def test_upsert(spark):
    existing = spark.createDataFrame([("a", "1", "202601", TEN), ("b", "1", "202603", TEN)], HISTORY)
    incoming = spark.createDataFrame([("a", "2", "202602", TEN), ("b", "2", "202602", TEN), ("c", "2", "202602", TEN)], HISTORY)
    once = upsert_latest(existing, incoming, ["k"])
    assert {r.k: r.v for r in once.collect()} == {"a": "2", "b": "1", "c": "2"}
    assert upsert_latest(once, incoming, ["k"]).exceptAll(once).isEmpty()


def test_mode_ties_and_missing_values(spark):
    counts = spark.createDataFrame(
        [("k1", "b", 2), ("k1", "a", 2), ("k1", "c", 1), ("k2", None, 9), ("k2", "x", 1), ("k3", None, 4)],
        "k string, v string, n long",
    )
    got = {r.k: r.v for r in most_frequent(counts, "k", "v").collect()}
    assert got == {"k1": "a", "k2": "x", "k3": None}


def test_mode_uses_binary_text_order(spark):
    counts = spark.createDataFrame([("k", "á", 1), ("k", "a", 1), ("k", "B", 1)], "k string, v string, n long")
    assert most_frequent(counts, "k", "v").first().v == "B"


# --- skewed joins ---------------------------------------------------------------------------------


@pytest.fixture
def skewed(spark):
    """A third of the left rows share one key and a third have none; keys 0-9 have two right rows."""
    kind = F.col("id") % 3
    left = spark.range(6000).select(
        F.when(kind == 0, "hot").when(kind == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), F.col("id") % 700)).alias("k"),
        F.col("id").alias("row"),
    )
    right = spark.range(500).select(
        F.when(F.col("id") == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"), F.col("id").alias("v")
    )
    extra = spark.range(10).select(F.concat(F.lit("k"), F.col("id")).alias("k"), (F.col("id") + 1000).alias("v"))
    return left, right.union(extra)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("hot_rows", [1, 100, 10**6])
def test_spread_join_equals_plain_join(no_broadcast, skewed, how, hot_rows):
    left, right = skewed
    spread = joins.spread_join(left, right, ["k"], how, hot_rows)
    plain = left.join(right, "k", how)
    assert spread.columns == plain.columns
    assert spread.exceptAll(plain).isEmpty() and plain.exceptAll(spread).isEmpty()


def test_spread_join_on_several_keys(spark, no_broadcast):
    left = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("a"),
        F.when(F.col("id") % 9 == 0, F.lit(None)).otherwise(F.lit(1)).alias("b"),
        F.col("id").alias("row"),
    )
    right = left.select("a", "b").distinct().withColumn("v", F.lit("x"))
    spread = joins.spread_join(left, right, ["a", "b"], "left", hot_rows=10)
    plain = left.join(right, ["a", "b"], "left")
    assert spread.exceptAll(plain).isEmpty() and plain.exceptAll(spread).isEmpty()


def test_hot_keys_are_found_with_slots_in_proportion(skewed):
    left, _ = skewed
    assert {r.k: r._slots for r in joins.hot_keys(left, ["k"], hot_rows=500).collect()} == {"hot": 4, None: 4}


def test_hot_key_rows_are_spread(spark, no_broadcast, skewed):
    left, right = skewed
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        spread = joins.spread_join(left, right, ["k"], "left", hot_rows=100)
        used = spread.where("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert used == 4  # all shuffle partitions of the test session


def test_hot_key_count_shares_the_shuffle_of_the_left_side(spark, no_broadcast, plan_of, tmp_path):
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").cast("string").alias("line"),
        F.lit("202601").alias("etl_period"),
        F.lit(None).cast("timestamp_ntz").alias("loaded_at"),
    )
    rows.write.parquet(str(tmp_path / "lines"))
    left = latest_by(spark.read.parquet(str(tmp_path / "lines")), ["k", "line"])
    right = spark.range(50).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    plan = plan_of(joins.spread_join(left, right, ["k"], "left", hot_rows=100), run=True)
    assert "ReusedExchange [k" in plan


def test_small_right_side_is_left_to_broadcast(spark, plan_of, skewed):
    left, right = skewed
    plan = plan_of(joins.spread_join(left, right, ["k"], "left"))
    assert "BroadcastHashJoin" in plan and "_slot" not in plan


def test_unsupported_join_type(skewed):
    with pytest.raises(ValueError):
        joins.spread_join(*skewed, ["k"], "full")


def test_ties_follow_the_collation(spark):
    from tenderloom.operators.mode import most_frequent, text_order
    from tenderloom.plans import catalog

    texts = ["B", "z", "á", "a"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r.t for r in df.orderBy(*text_order("t", "UNICODE")).collect()] == ["a", "á", "B", "z"]
    assert [r.t for r in df.orderBy(*text_order("t")).collect()] == ["B", "a", "z", "á"]
    rows = [("1" * 16, t, 2) for t in ("B", "z", "á")] + [("1" * 15 + "2", t, 1) for t in ("b", "B")] + [("2" * 16, None, 5)]
    counts = spark.createDataFrame(rows, "cod_producto string, descr string, n long")

    def names(df):
        return {r[0]: r[1] for r in df.collect()}

    assert names(catalog.product_names(counts)) == {"1" * 16: "B", "1" * 15 + "2": "B", "2" * 16: None}
    assert names(catalog.product_names(counts, "UNICODE")) == {"1" * 16: "á", "1" * 15 + "2": "b", "2" * 16: None}
    assert names(catalog.commodity_names(counts, "UNICODE")) == {"1" * 8: "B", "2" * 8: None}  # three of B in all
    # Equal under the collation: binary order decides.
    assert names(most_frequent(counts, "cod_producto", "descr", collation="UNICODE_CI"))["1" * 15 + "2"] == "B"
    product = {r.cod_producto: r.descripcion_producto for r in catalog.catalog_from_counts(counts, collation="UNICODE").collect()}
    assert product[int("1" * 16)] == "á"
    assert dict(catalog.catalog_from_counts(counts, collation="UNICODE").dtypes)["descripcion_producto"] == "string"


def test_distinct_values_of_merged_parts(spark):
    import random

    from tenderloom.plans import distinct_tenders as dt_

    rnd = random.Random(4)
    rows = [(rnd.choice("ab"), rnd.choice(["x", "y", None]), rnd.choice([None, *(f"S{i:05d}" for i in range(300))])) for _ in range(2000)]
    rows += [("hot", "x", f"T{i}") for i in range(40_000)]
    whole = spark.createDataFrame(rows, "buyer string, supplier string, tender string")
    parts_of = [whole.where(F.col("tender").isNull() | (F.substring("tender", -1, 1) < "5")), whole.where("tender > 'S00100'"), whole.limit(0)]
    numbers, parts, sketches = None, [], []
    for part in parts_of:
        numbers = dt_.number_values(part, "tender", numbers)
        parts.append(dt_.distinct_parts(part, ["buyer", "supplier"], "tender", numbers))
        sketches.append(dt_.sketch_parts(part, ["buyer", "supplier"], "tender"))
    found = [r.number for r in numbers.collect()]
    assert sorted(found) == list(range(len(found))) and len(found) == numbers.select("tender").distinct().count()
    union = parts_of[0].unionByName(parts_of[1])
    for keys in (["buyer"], ["buyer", "supplier"], []):
        want = union.where("tender IS NOT NULL").groupBy(*keys).agg(F.count_distinct("tender").alias("carteles"))
        assert sorted(map(str, dt_.count_exactly(parts, keys).collect())) == sorted(map(str, want.collect()))
    assert parts[1].where("buyer = 'hot'").count() == 2  # 40,000 numbers lie in two blocks
    want = {r.buyer: r.n for r in union.groupBy("buyer").agg(F.count_distinct("tender").alias("n")).collect()}
    for r in dt_.estimate(sketches, ["buyer"]).collect():
        assert abs(r.carteles_estimados - want[r.buyer]) <= 1 + 4 * dt_.SKETCH_ERROR * want[r.buyer]


def test_sparse_groups_keep_a_word_for_each_tender(spark):
    """Numbers at the ends of words and blocks, the sign bit among them; a group with one tender is not a block of 4 KB."""
    from tenderloom.plans import distinct_tenders as dt_

    rows = [("a", n) for n in (0, 62, 63, 64, 32_767, 32_768)] + [("b", 63), ("b", None)]
    numbers = spark.range(40_000).selectExpr("id AS t", "id AS number")
    part = dt_.distinct_parts(spark.createDataFrame(rows, "k string, t long"), ["k"], "t", numbers)
    for df in (part, dt_.merge_parts([part, part], ["k"])):
        assert {(r.k, r.block): sorted(map(tuple, r.bits)) for r in df.collect()} == {
            ("a", 0): [(0, 1 + (1 << 62) - (1 << 63)), (1, 1), (511, -(1 << 63))],
            ("a", 1): [(0, 1)],
            ("b", 0): [(0, -(1 << 63))],
        }
    assert {r.k: r.carteles for r in dt_.count_exactly([part, part], ["k"]).collect()} == {"a": 6, "b": 1}


HISTORIES = ("k string, n string, v string, etl_period string, loaded_at timestamp_ntz", "k string, w string, etl_period string, loaded_at timestamp_ntz")


def histories(spark):
    rnd = random.Random(7)
    keys = [None, "hot", *(f"k{i}" for i in range(20))]

    def rows(n, *columns):
        pick = [rnd.choice([keys[:2], keys]) for _ in range(n)]
        return [(rnd.choice(p), *[rnd.choice(c) for c in columns], rnd.choice(["202601", "202602", None]), TEN) for p in pick]

    left = rows(3000, [None, *map(str, range(30))], "xy")
    return spark.createDataFrame(left, HISTORIES[0]), spark.createDataFrame(rows(300, "pq"), HISTORIES[1])


@pytest.mark.parametrize("hot_rows", [1, 50, 1_000_000])
def test_latest_join_equals_the_join_of_latest_rows(spark, hot_rows, monkeypatch):
    from tenderloom.operators import latest

    monkeypatch.setattr(latest, "fits_broadcast", lambda df: False)
    left, right = histories(spark)
    version = ("etl_period", "loaded_at")
    want = latest_by(left, ["k", "n"]).drop(*version).join(latest_by(right, ["k"]).drop(*version), ["k"], "left")
    found = latest.latest_join(left, ["k", "n"], right, ["k"], ["k"], hot_rows)
    assert found.columns == want.columns
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))


def test_staged_rows_are_joined_once(spark, tmp_path, monkeypatch):
    """Rows of each side meet by the join key before their versions are compared; no second shuffle follows."""
    from tenderloom.operators import latest

    monkeypatch.setattr(latest, "fits_broadcast", lambda df: False)
    left, right = histories(spark)
    plan = latest.latest_join(left, ["k", "n"], right, ["k"], ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 2
    few = plan[: plan.index("REPARTITION_BY_COL")]
    assert "Window" in few and "ENSURE_REQUIREMENTS" not in few.replace("BroadcastExchange", "")


@pytest.mark.parametrize("hot_rows", [1, 1_000_000])
def test_sides_in_buckets_are_joined_where_they_lie(spark, hot_rows, tmp_path, monkeypatch):
    from tenderloom.operators import latest

    monkeypatch.setattr(latest, "fits_broadcast", lambda df: False)
    spark.conf.set("spark.sql.requireAllClusterKeysForCoPartition", "false")
    sides = []
    for side, df in zip("lr", histories(spark)):
        name = f"history_{side}_{hot_rows}"
        df.withColumn("m", F.coalesce("etl_period", F.lit("none"))).write.bucketBy(4, "k").option(
            "path", str(tmp_path / name)
        ).saveAsTable(name)
        sides.append(spark.table(name))
    try:
        left, right = sides
        version, on = ("etl_period", "loaded_at"), ["k", "m"]
        want = latest_by(left, ["k", "n", "m"]).drop(*version).join(latest_by(right, on).drop(*version), on, "left")
        found = latest.latest_join(left, ["k", "n", "m"], right, on, on, hot_rows, clustered=("left", "right"))
        assert sorted(map(str, found.collect())) == sorted(map(str, want.select(*found.columns).collect()))
        assert "REPARTITION_BY_COL" not in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.requireAllClusterKeysForCoPartition")
        for side in "lr":
            spark.sql(f"DROP TABLE IF EXISTS history_{side}_{hot_rows}")


def test_rows_are_dealt_out_to_as_many_tasks_as_asked_for(spark, plan_of, monkeypatch):
    from tenderloom.operators import latest

    monkeypatch.setattr(latest, "fits_broadcast", lambda df: False)
    left, right = histories(spark)
    want = latest.latest_join(left, ["k", "n"], right, ["k"], ["k"])
    found = latest.latest_join(left, ["k", "n"], right, ["k"], ["k"], partitions=13)
    assert plan_of(found).count("13), REPARTITION_BY_NUM") == 2
    assert sorted(map(str, found.collect())) == sorted(map(str, want.collect()))


def test_stored_lines_have_more_buckets_the_larger_they_are(spark, tmp_path, plan_of, monkeypatch):
    """A task's rows stay few at any setting of the session; the facts read the buckets where they lie."""
    from conformance import fixtures as fx
    from conformance import queries as registered

    rows = {
        "lineitem": "id AS l_orderkey, id % 5 AS l_partkey, id % 3 AS l_suppkey, 1 AS l_linenumber, 2.0D AS l_quantity, "
        "3.5D AS l_extendedprice, 0.1D AS l_discount, 0.02D AS l_tax, 'R' AS l_returnflag, 'F' AS l_linestatus, "
        "timestamp_ntz'1996-02-03' AS l_shipdate",
        "orders": "id AS o_orderkey, id % 4 AS o_custkey, 'O' AS o_orderstatus, 9.5D AS o_totalprice, "
        "timestamp_ntz'1996-01-02' AS o_orderdate, '1-URGENT' AS o_orderpriority",
        "part": "id AS p_partkey, 'part' AS p_name",
    }
    for name, columns in rows.items():
        spark.range(40).selectExpr(*columns.split(", ")).write.parquet(str(tmp_path / f"{name}.parquet"))
    want = {
        build: sorted(map(str, build(spark, str(tmp_path)).collect()))
        for build in (registered.build_tender_lines, registered.build_bid_lines, registered.build_award_lines)
    }
    monkeypatch.setattr("tenderloom.operators.latest.fits_broadcast", lambda df: False)
    monkeypatch.setattr(fx, "LINE_BYTES", 400)
    buckets = fx.line_partitions(spark, str(tmp_path))
    assert buckets > int(spark.conf.get("spark.sql.shuffle.partitions"))
    for build, rows_ in want.items():
        found = build(spark, str(tmp_path))
        plan = plan_of(found)
        assert f"SelectedBucketsCount: {buckets} out of {buckets}" in plan or build is registered.build_bid_lines
        assert plan.count("REPARTITION_BY_NUM") == {registered.build_tender_lines: 1, registered.build_bid_lines: 2}.get(build, 0)
        assert len(rows_) == 40 and sorted(map(str, found.collect())) == rows_


def test_few_duplicate_keys_shuffle_no_rows(spark, plan_of):
    from tenderloom.operators import quality

    rows = spark.range(1000).selectExpr("if(id = 7, 6L, id) AS k", "repeat('x', 50) AS v")
    found = quality.duplicate_rows(rows, ["k"])
    assert "BroadcastHashJoin" in plan_of(found) and "Exchange hashpartitioning" not in plan_of(found)
    assert sorted((r.k, r.n_rows) for r in found.collect()) == [(6, 2), (6, 2)]


def test_hot_keys_are_looked_for_in_one_scan(spark, plan_of, tmp_path):
    spark.range(1000).selectExpr("id % 3 AS k").write.parquet(str(tmp_path / "rows"))
    found = joins.hot_keys(spark.read.parquet(str(tmp_path / "rows")), ["k"], 1_000_000)
    plan = plan_of(found, run=True)
    assert found.collect() == [] and "Subquery" not in plan
    assert sorted(joins.hot_keys(spark.read.parquet(str(tmp_path / "rows")), ["k"], 100).collect()) == [(0, 4), (1, 4), (2, 4)]


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_large_sides_are_joined_in_more_tasks(spark, plan_of, tmp_path, monkeypatch, no_broadcast, how):
    for name, first in (("l", 0), ("r", 30)):
        rows = [(k % 70 if k % 9 else None, k) for k in range(first, first + 100)]
        spark.createDataFrame(rows, f"k int, {name} int").write.parquet(str(tmp_path / name))
    left, right = spark.read.parquet(str(tmp_path / "l")), spark.read.parquet(str(tmp_path / "r"))
    few = joins.spread_join(left, right, ["k"], how, hot_rows=2)
    assert ", 37)" not in plan_of(few)
    files = sum(f.stat().st_size for n in "lr" for f in (tmp_path / n).glob("*.parquet"))
    monkeypatch.setattr("tenderloom.operators.joins.TASK_BYTES", files / 36.5)
    many = joins.spread_join(left, right, ["k"], how, hot_rows=2)
    assert plan_of(many).count(", 37)") == 2
    assert sorted(map(str, many.collect())) == sorted(map(str, left.join(right, "k", how).collect()))
