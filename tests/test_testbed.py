"""The graph over the driver's tables: distinct by numbers, which become strings last."""

import duckdb

from evgraph.plans.testbed import VIEWS, Testbed, sql

SMALL = "/root/testdata/sf0.001"


def keys_of_aggregates(frame):
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    return [line.split("[", 1)[1].split("]")[0] for line in plan.splitlines() if "Aggregate [" in line]


def test_content_and_topics_are_distinct_by_numbers(spark):
    t = Testbed(spark, SMALL)
    for frame in (t.content(), t.topics()):
        keys = keys_of_aggregates(frame)
        assert keys and not any("person_id" in k or "content_ref" in k for k in keys)


def test_content_and_topics_are_those_of_the_views(spark):
    base = duckdb.connect()
    for name in ("lineitem", "orders", "part"):
        base.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SMALL}/{name}.parquet'")
    t = Testbed(spark, SMALL)
    for frame, view in ((t.content(), "content"), (t.topics(), "topics")):
        assert view in VIEWS
        columns = ", ".join(frame.columns)
        assert sorted(map(tuple, frame.collect())) == sorted(base.execute(sql(f"SELECT {columns} FROM {view}", view)).fetchall())
