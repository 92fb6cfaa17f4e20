import pytest

from cadenza.sources.jdbc import DB_TABLE_NAMES, jdbc_read_options, stripe_predicates, stripe_query


def test_partitioned_options_split_key_range():
    opts = jdbc_read_options("jdbc:postgresql://db/catalog", "track", bounds=(1, 20000), num_partitions=8)
    assert opts["dbtable"] == "track"
    assert opts["partitionColumn"] == "track_id"
    assert (opts["lowerBound"], opts["upperBound"], opts["numPartitions"]) == ("1", "20001", "8")


def test_reference_table_names():
    assert DB_TABLE_NAMES["users"] == '"User"'
    assert DB_TABLE_NAMES["track_rights_holder"] == "track_rightsholder"
    single = jdbc_read_options("jdbc:x", "users")
    assert "partitionColumn" not in single


KEYS = {
    "sparse": [10 ** (k % 7) * (k + 1) for k in range(1000)],
    "skewed": [5] * 700 + list(range(300)),
    "with nulls": [None] * 40 + list(range(-500, 460)),
    "one value": [3] * 1000,
    "few": [1, 2],
}


@pytest.mark.parametrize("name", KEYS)
def test_stripes_follow_the_data(name):
    # The generated SQL runs on an in-process engine; every row lies in one stripe, and no stripe is larger than it must be.
    import duckdb

    con = duckdb.connect()
    con.execute("CREATE TABLE review (review_id BIGINT)")
    con.executemany("INSERT INTO review VALUES (?)", [(k,) for k in KEYS[name]])
    least = [r[0] for r in con.execute(stripe_query("review", "review_id", 10)).fetchall()]
    sizes = [con.execute(f"SELECT COUNT(*) FROM review WHERE {p}").fetchone()[0] for p in stripe_predicates("review_id", least)]
    rows = KEYS[name]
    hot = max(rows.count(k) for k in set(rows) if k is not None)
    assert sum(sizes) == len(rows) and max(sizes) <= -(-len(rows) // 10) * 2 + hot + rows.count(None)
    if name == "sparse":
        assert len(sizes) == 10 and max(sizes) <= 110
    if name == "one value":
        assert sizes == [1000]


def test_no_rows_are_one_stripe():
    assert stripe_predicates("k", []) == ["(k IS NULL OR k IS NOT NULL)"]
