from helpers import raw
from test_tables import bronze_of

from brooklet.plans import serving
from brooklet.plans.lakehouse import Lakehouse
from brooklet.schemas import MARTS


def test_marts_are_tables_of_the_catalog(spark, tmp_path):
    house, db = Lakehouse(spark, f"{tmp_path}/house"), "shop_test"
    bought = lambda d, price: raw(event_type="purchase", event_time=f"2020-04-0{d}T10:00:00Z", price=price)
    house.create()
    assert set(house.publish_catalog(db, f"{tmp_path}/db")) == set(MARTS)
    assert spark.table(f"{db}.daily_revenue").count() == 0 and spark.table(f"{db}.rfm_segmentation").count() == 0
    house.process(bronze_of(spark, [bought(1, "5"), bought(2, "7")]), "r1")
    assert spark.table(f"{db}.daily_revenue").count() == 0  # not published yet
    house.publish_catalog(db)
    assert {r.tableName for r in spark.sql(f"SHOW TABLES IN {db}").collect() if not r.isTemporary} == set(MARTS)
    house.process(bronze_of(spark, [bought(2, "8"), bought(3, "1")]), "r2")
    house.publish_catalog(db)
    assert house.publish_catalog(db) == []
    for name in MARTS:
        assert sorted(map(str, spark.table(f"{db}.{name}").select(*MARTS[name].schema.names).collect())) == sorted(map(str, house.read(name).collect())), name
    columns, rows = serving.execute(spark, "SELECT event_date, purchase_revenue FROM daily_revenue ORDER BY event_date", database=db)
    assert [r["purchase_revenue"] for r in rows] == [5.0, 15.0, 1.0] and spark.catalog.currentDatabase() == "default"
    plan = spark.table(f"{db}.daily_revenue").where("event_date = DATE '2020-04-03'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    house.table("daily_revenue").replace_partitions(house.read("daily_revenue").where("false"), ["2020-04-01"])
    assert house.publish_catalog(db) == ["daily_revenue"]
    assert sorted(str(r.event_date) for r in spark.table(f"{db}.daily_revenue").collect()) == ["2020-04-02", "2020-04-03"]
    spark.sql(f"DROP DATABASE {db} CASCADE")
    assert house.read("daily_revenue").count() == 2  # dropped tables leave the folders


def test_bucketed_keys_are_not_shuffled(spark, tmp_path):
    """The same rows as without the index; the target's side of the anti join has no exchange; a stop leaves nothing wrong."""
    house = Lakehouse(spark, f"{tmp_path}/house", key_database="keys_test", buckets=4)
    plain = Lakehouse(spark, f"{tmp_path}/plain")
    batches = [[raw(product_id=str(k)) for k in ks] for ks in (range(5), range(3, 9), range(9), [20])]
    for k, batch in enumerate(batches):
        a, b = (h.process(bronze_of(spark, batch), f"r{k}", "none") for h in (house, plain))
        assert (a.bronze_rows, a.silver_rows) == (b.bronze_rows, b.silver_rows)
        if k == 1:
            house.table("silver_events").compact()  # files are new: the index is made again
        if k == 2:
            house.keys("silver_events", "dedupe_key")._cover(0)  # as if it had stopped before its property
    index = house.keys("silver_events", "dedupe_key")
    assert index.keys().select("dedupe_key").distinct().count() == house.read("silver_events").count() == 10
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = house.new_silver(house.read("silver_events"), [r.event_date for r in house.read("silver_events").select("event_date").distinct().collect()])
        assert found.count() == 0
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert plan.count("Exchange") == 1 and "Bucketed: true" in plan and "SortMergeJoin" in plan, plan
    spark.sql("DROP DATABASE keys_test CASCADE")
