"""Plan shape: pruning and pushdown reach the scan, dimension joins are
broadcast, the pair join is an equi-join, no Cartesian products."""
from citystream.plans.queries import QUERIES


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dimension_join_is_broadcast(spark, sf_dir):
    p = _plan(QUERIES["q_aqi_rolling_join"](spark, sf_dir))
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_scan_reads_only_needed_columns(spark, sf_dir):
    p = _plan(QUERIES["q_aqi_emergency"](spark, sf_dir))
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>" in p


def test_no_cartesian_products(spark, sf_dir):
    for name in ("q_ward_energy", "q_aqi_advisories", "q_gridlock", "q_route_enrichment",
                 "q_dead_letters"):
        p = _plan(QUERIES[name](spark, sf_dir))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_pair_join_is_equi(spark, sf_dir):
    from pyspark.sql import functions as F
    from citystream.operators.bunching import near_segments
    from citystream.sources.fixtures import Fixtures
    g = Fixtures(spark, sf_dir).gps().where("lat > 1 AND lon IS NOT NULL").select(
        "route_id", "bus_id", "lat", "lon", F.col("event_time").alias("t"),
        F.col("event_id").alias("e"))
    p = _plan(near_segments(g, pair_seconds=3600))
    assert "CartesianProduct" not in p and "NestedLoopJoin" not in p


def test_bunching_runs_a_fixed_number_of_jobs(spark, sf_dir, monkeypatch):
    """Tables cut and small results fetched before the last plan, whatever the
    length of the alert chains; no self-join for each doubling."""
    from pyspark.sql.classic.dataframe import DataFrame

    from citystream.operators import bunching as B
    from citystream.plans import chain
    seen = []
    for module, name in ((B, "cut"), (chain, "_cut")):
        old = getattr(module, name)
        monkeypatch.setattr(module, name, lambda df, old=old: seen.append("cut") or old(df))
    for name in ("collect", "first", "take", "count"):
        old = getattr(DataFrame, name)
        monkeypatch.setattr(DataFrame, name,
                            lambda self, *a, old=old: seen.append("fetch") or old(self, *a))
    out = B.bunching(_gps(spark, sf_dir))
    assert len(seen) <= 12
    assert _plan(out).count("SortMergeJoin") + _plan(out).count("BroadcastHashJoin") <= 12


def _gps(spark, sf_dir):
    from citystream.operators import quality as Q
    from citystream.sources.fixtures import Fixtures
    return Q.valid_records(Q.validate(Fixtures(spark, sf_dir).gps(), Q.BUS_GPS))


def test_raw_messages_are_parsed_once(spark, sf_dir):
    p = _plan(QUERIES["q_topic_dead_letters"](spark, sf_dir))
    # Two topics, one parse each, and one to read the packed letters back.
    assert p.count("parse_json") <= 4
