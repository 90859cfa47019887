import math

import pytest
from pyspark.sql import functions as F

from rateflow.functions.statistics import paired_count
from rateflow.operators.carry import own_date_changes
from rateflow.plans import named_queries
from rateflow.sources import tables


@pytest.fixture
def queries(monkeypatch):
    kept = dict(named_queries.BUSINESS_QUERIES)
    monkeypatch.setattr(named_queries, "BUSINESS_QUERIES", kept)
    return kept


def test_a_question_is_registered_and_run(spark, queries):
    mart = spark.createDataFrame([("A", 1.0), ("B", 2.0)], "series_id STRING, value DOUBLE")
    named_queries.register("frame", lambda marts, as_of: marts("m").where("value > 1"))
    named_queries.register("text", "-- all\nSELECT max(value) AS top, {as_of} AS day FROM {m};")
    marts = {"m": mart}.get
    assert [r["series_id"] for r in named_queries.run_named(spark, "frame", marts=marts).collect()] == ["B"]
    row = named_queries.run_named(spark, "text", "2024-01-02", marts=marts).first()
    assert (row["top"], str(row["day"])) == (2.0, "2024-01-02")


@pytest.mark.parametrize("text", ["", "  \n", "-- only a comment\n", "/* nor\nthis */ ;"])
def test_an_empty_body_is_refused(queries, text):
    with pytest.raises(ValueError, match="empty"):
        named_queries.register("nothing", text)
    assert "nothing" not in queries


def test_a_name_is_taken_once(queries):
    with pytest.raises(ValueError, match="duplicate"):
        named_queries.register("usd_eur_differential_5y", "SELECT 1")
    with pytest.raises(ValueError, match="needs a name"):
        named_queries.register(" ", "SELECT 1")


def test_an_unknown_name_lists_the_known(spark):
    with pytest.raises(KeyError, match="usd_eur_differential_5y"):
        named_queries.run_named(spark, "nope")


def test_places_follow_the_order_across_partitions(spark):
    frame = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("key")).repartition(5)
    placed = tables.with_place(frame.orderBy(F.desc("key"))).collect()
    keys = sorted((r["key"] for r in placed), reverse=True)
    assert sorted((r["place"], r["key"]) for r in placed) == list(enumerate(keys, 1))
    assert tables.with_place(frame.limit(0).orderBy("key")).count() == 0


def test_changes_between_infinities_count_for_nothing(spark, day):
    inf = math.inf
    frame = spark.createDataFrame(
        [(day(f"2024-01-0{i + 1}"), v) for i, v in enumerate([inf, inf, 1.0, inf, inf])], "d DATE, rate DOUBLE"
    )
    changed = own_date_changes(frame, "d", {"rate": "change"})
    assert [r["change"] for r in changed.orderBy("d").collect()] == [None, None, -inf, inf, None]
    n = changed.agg(paired_count(F.col("change"), F.lit(1.0)).alias("n")).first()["n"]
    assert n == 2
