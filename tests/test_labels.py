"""Cluster names: collisions, ties and nulls, by position and by runner-up."""

import pytest

from basketry.plans import segments as s

PROF = "cluster int, monetary double, tenure_days double, recency_days double, discount_usage_rate double"


def names(spark, rows, **kw):
    return {r.cluster: r.segment for r in s.label_clusters(spark.createDataFrame(rows, PROF), **kw).collect()}


def test_one_cluster_wins_every_rule(spark):
    rows = [(0, 9.0, 1.0, 9.0, 9.0), (1, 8.0, 5.0, 8.0, 1.0), (2, 7.0, 2.0, 7.0, 8.0), (3, 6.0, 3.0, 6.0, 7.0), (4, 5.0, 4.0, 5.0, 6.0)]
    assert names(spark, rows) == {0: s.HIGH_VALUE, 1: s.OCCASIONAL, 2: s.NEW, 3: s.PRICE_SENSITIVE, 4: s.AT_RISK}
    assert names(spark, rows, resolve="runner_up") == {0: s.HIGH_VALUE, 2: s.NEW, 1: s.AT_RISK, 3: s.PRICE_SENSITIVE, 4: s.OCCASIONAL}


def test_no_collision_gives_the_same_names(spark):
    rows = [(0, 9.0, 5.0, 1.0, 1.0), (1, 1.0, 1.0, 2.0, 2.0), (2, 2.0, 6.0, 9.0, 3.0), (3, 3.0, 7.0, 3.0, 9.0), (4, 4.0, 8.0, 4.0, 4.0)]
    assert names(spark, rows) == names(spark, rows, resolve="runner_up")


def test_ties_go_to_the_smaller_id_and_nulls_win_nothing(spark):
    rows = [(2, 5.0, 1.0, None, None), (1, 5.0, 1.0, None, None), (0, None, None, None, None)]
    assert names(spark, rows, resolve="runner_up") == {1: s.HIGH_VALUE, 2: s.NEW, 0: s.OCCASIONAL}


def test_fewer_and_more_clusters_than_rules(spark):
    assert names(spark, [(0, 1.0, 1.0, 1.0, 1.0)], resolve="runner_up") == {0: s.HIGH_VALUE}
    many = [(i, float(i), float(i), float(i), float(i)) for i in range(7)]
    got = names(spark, many, resolve="runner_up")
    assert got[6] == s.HIGH_VALUE and got[0] == s.NEW and got[5] == s.AT_RISK and got[4] == s.PRICE_SENSITIVE
    assert {got[1], got[2], got[3]} == {s.OCCASIONAL}


def test_unknown_rule(spark):
    with pytest.raises(ValueError):
        s.label_clusters(spark.createDataFrame([], PROF), resolve="other")
