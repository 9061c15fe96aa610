"""The backfill: everything the source files hold, read once."""

from pyspark.sql import functions as F
from test_jobs import NOW, rows, shop, write_sources  # noqa: F401

from merchmill import values
from merchmill.operators import first_per_key
from merchmill.plans import ingest, jobs
from merchmill.sources.storage import exists
from merchmill.sources.tables import read_table


def test_a_backfill_takes_the_same_lines_without_the_store_of_days(spark, shop, folder):  # noqa: F811
    write_sources(folder, orders=200, days=9)
    with open(f"{folder}/{values.SOURCE_FILES['orders']}", "a", encoding="utf-8") as out:
        # a second row of some orders: earlier, without a time, and alike but for status and person
        out.write("o003,c50,canceled,2018-03-01 00:00:00,1\no004,c4,shipped,never,1\no005,c5,canceled,2018-03-30 12:00:00,1\n")
    config = shop()
    src = jobs.read_sources(spark, config)
    built = ingest.build_orders(src["orders"], src["order_items"], src["customers"], NOW)
    want = first_per_key(built, ingest.LINE_KEY, ["created_at", "customer_id", "status"]).select(*ingest.ORDER_COLUMNS, "order_date")
    done = jobs.seed_history(spark, config, NOW)
    got = read_table(spark, config.path("ingest", "orders"), jobs.order_layout(config)).select(*want.columns)
    assert done["orders"] == want.count() < built.count() and rows(got) == rows(want)
    for name, whole in (("customers", ingest.build_customers(src["customers"], NOW, config.seed)),
                        ("products", ingest.build_products(src["products"], src["order_items"], src["translation"], NOW))):
        assert rows(read_table(spark, config.path("ingest", name)).select(*sorted(whole.columns))) == rows(whole.select(*sorted(whole.columns)))
    # the store would hold every line twice more, shuffled and written for that
    assert not exists(spark, config.path("history", f"seed={config.seed}-{config.partition_by}"))
    assert jobs.seed_history(spark, config, NOW) == {"customers": 0, "products": 0, "orders": 0}
