"""Second copies of tables: the same rows as the table itself, with less read."""

import re
import tempfile

import pytest
from pyspark.sql import functions as F
from table_rows import rows

from cadenza.catalog import Catalog
from cadenza.operators import credits, discovery, search
from cadenza.schemas import schema
from cadenza.sources.files import Changes, commit_changes, load_catalog, save_catalog
from cadenza.sources.projections import PROJECTIONS, term_grams

N = 60_000
TABLES = ("track", "artist", "track_artist", "track_isrc")


def scanned(df) -> int:
    """Rows that the file scans of ``df`` gave, after row groups and pages were skipped."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


@pytest.fixture(scope="module")
def root(spark):
    i = F.col("id")
    word = F.element_at(F.array(*map(F.lit, ["Red", "blue", "Green", "café", "ZEBRA"])), (i % 5 + 1).cast("int"))
    title = F.when(i % 97 == 0, None).when(i % 1000 == 7, F.concat(F.lit("Quartz "), i)).otherwise(F.concat(word, F.lit(" song "), i % 300))
    track = spark.range(N).select(
        i.alias("track_id"), title.alias("title"), (i % 100).cast("int").alias("duration_sec"),
        F.when(i % 11 != 0, 60 + (i * 37) % 14000 / 100).cast("decimal(6,2)").alias("bpm"),
        F.when(i % 11 != 0, F.substring(F.lit("CDEFGAB"), (i % 7 + 1).cast("int"), F.lit(1))).alias("key"),
        F.when(i % 11 != 0, F.when(i % 2 == 0, "major").otherwise("minor")).alias("mode"), F.lit(False).alias("explicit_flag"),
    )
    tables = {
        "track": track,
        "artist": spark.createDataFrame([(1, "Ännï", None, None, None), (2, "anna", None, None, None), (3, "Bob", None, None, None)], schema("artist")),
        "track_artist": spark.range(N).select(i.alias("track_id"), (1 + i % 3).alias("artist_id"), F.lit("x").alias("role")),
        "track_isrc": spark.range(N).select(i.alias("track_id"), F.concat(F.lit("X"), F.lpad((i * 2).cast("string"), 11, "0")).alias("isrc"), F.lit(True).alias("is_primary")),
    }
    path = tempfile.mkdtemp(prefix="cadenza-test-proj-")
    save_catalog(Catalog(tables), path, projections=("search_track", "search_artist", "audio_track"), buckets=8)
    return path


@pytest.fixture(scope="module")
def catalog(spark, root):
    return load_catalog(spark, root, tables=TABLES)


def _plain(cat):
    return Catalog(dict(cat))


TERMS = ["quartz", "QUARTZ 12", "ed song 29", "xyz", "re", "", "s%g 7", "r_d song 1", "café", "CAFÉ song 3", "song 299", "nix\\%", "zebra song"]


@pytest.mark.parametrize("term", TERMS)
def test_search_by_trigrams_gives_the_rows_of_the_scan(catalog, term):
    found = search.matching(catalog, "track", ["title"], term).select("track_id", "title")
    want = search.matching(_plain(catalog), "track", ["title"], term).select("track_id", "title")
    assert found.exceptAll(want).count() == want.exceptAll(found).count() == 0


def test_search_by_trigrams_reads_little(catalog):
    assert rows(search.search_tracks(catalog, "quartz", 5)) == rows(search.search_tracks(_plain(catalog), "quartz", 5))
    hit = search.matching(catalog, "track", ["title"], "quartz").select("track_id")
    scan = search.matching(_plain(catalog), "track", ["title"], "quartz").select("track_id")
    assert scanned(scan) == N and scanned(hit) < N / 10
    assert scanned(search.matching(catalog, "track", ["title"], "qqqq").select("track_id")) <= 2000  # no such trigram: at most a page
    assert term_grams("ab") is None and term_grams("a%bc") is None and term_grams("ABca") == ["abc", "bca"]


def test_projections_follow_appends_and_removals(spark, root):
    before = load_catalog(spark, root, tables=TABLES)
    gone = before.track.filter("track_id in (7, 1007)")
    new = spark.createDataFrame([(N + 1, "New QUARTZ", 1, None, None, None, False), (7, "quartz again", 1, 99.5, "C", "major", False)], "track_id long, title string, duration_sec int, bpm double, key string, mode string, explicit_flag boolean")
    new = new.withColumn("bpm", F.col("bpm").cast("decimal(6,2)"))
    commit_changes(spark, root, Changes({"track": new}, {"track": gone}), "s", 0, before.as_of)
    after = load_catalog(spark, root, tables=TABLES)
    found = sorted(rows(search.matching(after, "track", ["title"], "quartz").select("track_id", "title")))
    assert found == sorted(rows(search.matching(_plain(after), "track", ["title"], "quartz").select("track_id", "title")))
    assert (N + 1, "New QUARTZ") in found and (7, "quartz again") in found and 1007 not in dict(found)
    assert rows(discovery.tracks_by_audio(after, 99, 100, "C", "major")) == rows(discovery.tracks_by_audio(_plain(after), 99, 100, "C", "major"))
    assert after.replace(track=after.track.limit(0)).projection("search_track") is None
    # Put back what was there, for the other tests of this module.
    back = before.track.filter("track_id in (7, 1007)")
    commit_changes(spark, root, Changes({"track": back}, {"track": new}), "s", 1, after.as_of)
    again = load_catalog(spark, root, tables=TABLES)
    assert again.track.count() == N


@pytest.mark.parametrize("asked", [{"bpm_lo": 100, "bpm_hi": 104}, {"bpm_lo": 100, "bpm_hi": 120, "mode": "minor"}, {"key": "C", "mode": "major", "bpm_lo": 150}])
def test_audio_projection_skips_pages(catalog, asked):
    found = discovery.tracks_by_audio(catalog, **asked)
    assert rows(found) == rows(discovery.tracks_by_audio(_plain(catalog), **asked))
    stored = catalog.projection("audio_track")
    cond = [F.col("bpm") >= asked["bpm_lo"]] + ([F.col("bpm") <= asked["bpm_hi"]] if "bpm_hi" in asked else [])
    cond += [F.col(c) == asked[c] for c in ("key", "mode") if c in asked]
    hit = stored.select("track_id", "bpm", "key", "mode")
    for c in cond:
        hit = hit.filter(c)
    assert scanned(hit) < N / 2


def test_bloom_filter_skips_absent_isrc(catalog, spark, root):
    isrc = f"X{7 * 2 + 1:011d}"  # between stored values, so minima and maxima cannot tell
    asked = catalog.track_isrc.filter(F.col("isrc") == isrc).select("track_id")
    assert "isrc" in re.search(r"PushedFilters: \[([^\]]*)\]", asked._jdf.queryExecution().executedPlan().toString()).group(1)
    assert scanned(asked) == 0
    assert 0 < scanned(catalog.track_isrc.filter(F.col("isrc") == f"X{14:011d}").select("track_id")) < N


def test_bucketed_bridge_joins_without_a_shuffle(spark, root):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        base = load_catalog(spark, root, tables=("track_artist", "track_isrc"))
        joined = base.track_artist.join(base.track_isrc, "track_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == N
        credit = credits.track_isrcs(base.replace(track=base.track_artist.select("track_id", F.lit("t").alias("title"))), None, ordered=False)
        assert "Exchange" not in credit._jdf.queryExecution().executedPlan().toString()
        one = base.track_artist.filter("track_id = 5").select("artist_id")
        assert rows(one) == [(3,)] and scanned(one) < N / 2
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_linguistic_order(catalog):
    names = [r["name"] for r in search.search_artists(catalog, "", 3, collation="UNICODE").collect()]
    assert names == ["anna", "Ännï", "Bob"]
    assert [r["name"] for r in search.search_artists(catalog, "", 3).collect()] == ["Bob", "anna", "Ännï"]
    listed = credits.artist_tracks(_plain(catalog).replace(track=catalog.track.filter("track_id < 10")), 2, collation="UNICODE").collect()
    assert [r["title"] for r in listed] == sorted((r["title"] for r in listed), key=str.lower)
    assert set(PROJECTIONS) >= {"search_users", "search_consumer", "audio_track"}
