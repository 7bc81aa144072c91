import random

from pyspark.sql import functions as F

from rankweave.operators import presence

SCHEMA = "snap_date string, cust_id string, prod_name string, label int, area string"


def rows(seed=1):
    rng = random.Random(seed)
    return [(f"d{rng.randrange(3)}", f"c{rng.randrange(15)}", rng.choice("XYZ"), int(rng.random() < 0.3), rng.choice(["n", "s", None])) for _ in range(200)]


def plainly(data, level, at):
    out = {}
    for value in {r[at] if at is not None else "all" for r in data}:
        own = [r for r in data if at is None or r[at] == value]
        entities = {r[1] for r in own}
        bought = {r[1] for r in own if r[3]}
        out[level, value if value is not None else "all"] = (len(own), sum(r[3] for r in own), len(entities), len(bought), len({(r[0], r[1]) for r in own}))
    return out


def test_roll_up_equals_distinct_counts(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA)
    want = plainly(data, "total", None) | plainly(data, "snap_date", 0) | plainly(data, "prod_name", 2) | plainly(data, "area", 4)
    summary = presence.presence(df, ["snap_date", "prod_name", "area"])
    got = {(r.level, r.value or "all"): (r.rows, r.positives, r.entities, r.positive_entities, r.queries) for r in presence.rolled_up(summary).collect()}
    assert got == want
    first, second = (summary.where(F.pmod(F.xxhash64("cust_id"), F.lit(2)) == i) for i in (0, 1))  # of disjoint entities
    assert sorted(map(str, presence.rolled_up(first.unionByName(second)).collect())) == sorted(map(str, presence.rolled_up(summary).collect()))
    assert presence.dataset_overview(df.limit(0), ["area"]).count() == 0


def test_statistics_of_items_and_segments(spark):
    data = rows(2)
    df = spark.createDataFrame(data, SCHEMA)
    want = plainly(data, "prod_name", 2)
    for r in presence.item_entity_statistics(df).collect():
        _, positives, entities, bought, _ = want["prod_name", r.prod_name]
        assert (r.entities, r.positive_entities, r.negative_entities) == (entities, bought, entities - bought)
        assert (r.positive_rate, r.positives_per_entity) == (bought / entities, positives / bought)
    assert {r.area: r.entities for r in presence.segment_entity_statistics(df, "area").collect()} == {k[1] if k[1] != "all" else None: v[2] for k, v in plainly(data, "area", 4).items()}
    assert presence.segment_entity_statistics(df, "none").count() == 0


def test_no_row_is_multiplied(spark, tmp_path):
    spark.createDataFrame(rows(), SCHEMA).write.parquet(f"{tmp_path}/t")
    plan = presence.dataset_overview(spark.read.parquet(f"{tmp_path}/t"), ["snap_date", "prod_name", "area"])._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan and plan.count("Exchange hashpartitioning") == 2
