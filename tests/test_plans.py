"""Plan-shape guards: the properties the operators are designed for."""

import re

from cadenza.operators import credits, discovery, integrity, profile, reports, search

SHUFFLE = re.compile(r"\bExchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobinPartitioning)")


def _plan(df) -> str:
    # Before execution an adaptive plan prints the plan it starts from.
    return df._jdf.queryExecution().executedPlan().toString()


def _shuffles(df) -> int:
    return sum(1 for line in _plan(df).splitlines() if SHUFFLE.search(line))


def test_search_takes_top_k_before_touching_bridges(small_catalog):
    plan = _plan(search.search_tracks(small_catalog, "red", 20))
    assert "TakeOrderedAndProject" in plan
    # The credit rows are cut to the top-k keys by a broadcast semi join.
    assert re.search(r"BroadcastHashJoin .*LeftSemi", plan)


def test_key_list_reaches_the_parquet_scan(small_catalog):
    plan = _plan(credits.track_isrcs(small_catalog, [3, 6, 9]))
    assert re.search(r"PushedFilters: \[[^\]]*(In\(p_partkey|EqualTo\(p_partkey)", plan)


def test_scans_read_only_needed_columns(small_catalog):
    plan = _plan(reports.label_catalog_size(small_catalog))
    read = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert read and all("o_totalprice" not in r and "c_acctbal" not in r for r in read)


def test_catalog_wide_jobs_share_their_shuffles(make_catalog):
    cat = make_catalog()
    # One grouped aggregate over all 27 tables, then the final sort.
    assert _shuffles(profile.table_row_counts(cat)) <= 2
    assert _shuffles(profile.coverage_report(cat)) <= 2


def test_integrity_report_is_a_few_passes(make_catalog):
    cat = make_catalog()
    # PK group-by, orphan join (two sides), violation count, final sort.
    assert _shuffles(integrity.integrity_report(cat)) <= 6


def test_broadcast_hint_only_within_bound(spark):
    from cadenza.plans.keys import BROADCAST_ROW_BOUND, bounded_broadcast

    df = spark.range(10)
    hinted = bounded_broadcast(df, 10)._jdf.queryExecution().logical().toString()
    unhinted = bounded_broadcast(df, BROADCAST_ROW_BOUND + 1)._jdf.queryExecution().logical().toString()
    assert "broadcast" in hinted.lower()
    assert "broadcast" not in unhinted.lower()
    assert "broadcast" not in bounded_broadcast(df, None)._jdf.queryExecution().logical().toString().lower()


def test_searched_table_is_read_once(small_catalog):
    # The k rows are evaluated while the query is built; what is left reads the bridges only.
    for df in (search.search_tracks(small_catalog, "red", 20), discovery.search_tracks_word(small_catalog, "red", 20)):
        assert "part.parquet" not in _plan(df) and "p_name" not in _plan(df)
    assert "c_name" not in _plan(search.search_users(small_catalog, "0001", 20))
    plan = _plan(reports.recent_reviews(small_catalog, 25))
    assert plan.count("TakeOrderedAndProject") == 1


def test_reports_take_their_top_rows_once(small_catalog):
    # The ranking is evaluated while the query is built; what is left reads names and titles of k rows.
    for df in (reports.top_rated_tracks(small_catalog, limit=10), reports.most_prolific_artists(small_catalog, 10)):
        assert _plan(df).count("TakeOrderedAndProject") == 1
    assert "l_quantity" not in _plan(reports.top_rated_tracks(small_catalog, limit=10))


def test_find_consumers_filters_each_side_before_they_meet(small_catalog):
    plan = _plan(search.find_consumers(small_catalog, "build", 10))
    assert plan.count("LeftSemi") >= 2 and plan.count("Contains") >= 2


def test_cascade_scans_a_reached_table_once(make_catalog):
    cat = make_catalog(users=[(1, "u", None, None, None)], consumer=[(1, "c")], review=[(5, 1, "x", None, 1, 2)])
    rows_left = integrity.cascade_delete(cat, "users", [1]).catalog.written_by
    plan = _plan(rows_left)
    # One scan of the bridge, one outer join per reference, the deleted keys read from their written tables.
    assert len(re.findall(r"Scan ExistingRDD\[consumer_id", plan)) == 1
    assert len(re.findall(r"LeftOuter", plan)) == 2 and plan.count("ReadSchema: struct<key:bigint>") == 2
