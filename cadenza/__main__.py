"""Command line: run one catalog operator and print (or write) its result.

    python -m cadenza --catalog /data/catalog search_tracks --term red --limit 20
    python -m cadenza --testdata /root/testdata/sf0.01 top_rated_tracks --min-ratings 5
    python -m cadenza --catalog /data/catalog track_detail --ids 1 2 3 --out /data/out/detail

Non-interactive counterpart of a menu-driven client: every read operator is
a sub-command; ``--ids`` takes one or more keys (omit for all keys). Write
jobs read a request file and write their outputs (new rows, rejects) under
``--out``:

    python -m cadenza --catalog /data/catalog ingest_reviews --requests reqs.csv --out /data/batch-7
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from .operators import credits, discovery, ingest, integrity, profile, reports, search

SEARCHES = {
    "search_tracks": search.search_tracks,
    "search_artists": search.search_artists,
    "search_albums": search.search_albums,
    "search_users": search.search_users,
    "search_producers": search.search_producers,
    "search_labels": search.search_labels,
    "search_rightsholders": search.search_rightsholders,
    "find_groups": search.find_groups,
    "find_consumers": search.find_consumers,
    "group_members_by_name": search.group_members_by_name,
    "consumer_reviews_by_name": search.consumer_reviews_by_name,
    "search_tracks_word": discovery.search_tracks_word,
}
DETAILS = {
    "track_detail": credits.track_detail,
    "artist_tracks": credits.artist_tracks,
    "album_tracks": credits.album_tracks,
    "track_songwriters": credits.track_songwriters,
    "track_producers": credits.track_producers,
    "group_members": credits.group_members,
    "user_playlists": credits.user_playlists,
    "user_playlist_list": credits.user_playlist_list,
    "playlist_tracks": credits.playlist_tracks,
    "track_rights": credits.track_rights,
    "track_isrcs": credits.track_isrcs,
    "artist_producer_links": credits.artist_producer_links,
    "consumer_reviews": credits.consumer_reviews,
    "track_reviews": credits.track_reviews,
    "user_profiles": credits.user_profiles,
}
REPORTS = {
    "popular_genres": reports.popular_genres,
    "most_prolific_artists": reports.most_prolific_artists,
    "recent_reviews": reports.recent_reviews,
    "label_catalog_size": reports.label_catalog_size,
    "genre_tree": reports.genre_tree,
}


WRITES = ("ingest_reviews", "ingest_playlists", "playlist_add", "playlist_remove", "apply_playlist_changes")


def _read_requests(spark, path: str):
    """Requests by column name; the write jobs cast them to their declared types."""
    if path.endswith(".csv"):
        return spark.read.option("header", "true").csv(path)
    return spark.read.parquet(path)


def _changes(cat, op: str, requests):
    """A write job as a batch for the stored catalog."""
    from .sources.files import Changes

    out = _write_job(cat, op, requests)
    rejects = {f"_rejects_{op}": out["rejects"]} if "rejects" in out else {}
    if op == "playlist_remove":
        return Changes(rejects, {"playlist_track": out["removed"]})
    if op == "apply_playlist_changes":
        touched = requests.select(F.col("playlist_id").cast("bigint"), F.col("track_id").cast("bigint")).distinct()
        pair = ["playlist_id", "track_id"]
        return Changes({"playlist_track": out["playlist_track"].join(touched, pair, "left_semi")}, {"playlist_track": touched})
    return Changes({t: df for t, df in out.items() if t != "rejects"} | rejects)


def _write_job(cat, op: str, requests) -> dict:
    """Run one write job; returns output name -> DataFrame."""
    if op == "ingest_reviews":
        b = ingest.ingest_reviews(cat, requests)
        return {"review": b.review, "written_by": b.written_by, "gets": b.gets, "rejects": b.rejects}
    if op == "ingest_playlists":
        b = ingest.ingest_playlists(cat, requests)
        return {"playlist": b.playlist, "makes": b.makes, "rejects": b.rejects}
    if op == "playlist_add":
        b = ingest.playlist_add(cat, requests)
        return {"playlist_track": b.added, "rejects": b.rejects}
    if op == "playlist_remove":
        b = ingest.playlist_remove(cat, requests)
        return {"playlist_track": b.remaining, "removed": b.removed, "rejects": b.rejects}
    return {"playlist_track": ingest.apply_playlist_changes(cat, requests)}


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="python -m cadenza")
    src = p.add_mutually_exclusive_group(required=True)
    src.add_argument("--catalog", help="stored catalog folder (one Parquet folder per table)")
    src.add_argument("--testdata", help="driver test-data folder, mapped on the fly")
    p.add_argument("--master", default=None, help="e.g. local[8]; default: from spark-submit")
    p.add_argument("--out", default=None, help="write Parquet here instead of printing")
    p.add_argument("--rows", type=int, default=50, help="rows to print")
    sub = p.add_subparsers(dest="op", required=True)
    add = sub.add_parser

    def add_parser(name, **kw):
        # --out is accepted after the sub-command too.
        sp = add(name, **kw)
        sp.add_argument("--out", dest="sub_out", default=None, help=argparse.SUPPRESS)
        return sp

    sub.add_parser = add_parser
    for name in SEARCHES:
        s = sub.add_parser(name)
        s.add_argument("--term", default="")
        s.add_argument("--limit", type=int, default=10 if name.startswith(("find_", "group_", "consumer_")) else 20)
    for name in DETAILS:
        s = sub.add_parser(name)
        s.add_argument("--ids", type=int, nargs="*", default=None)
    for name in REPORTS:
        s = sub.add_parser(name)
        s.add_argument("--limit", type=int, default=50 if name == "genre_tree" else 10)
    s = sub.add_parser("top_rated_tracks")
    s.add_argument("--min-ratings", type=int, default=1)
    s.add_argument("--limit", type=int, default=10)
    s.add_argument("--count-mode", choices=reports.COUNT_MODES, default="joined")
    s = sub.add_parser("tracks_by_audio")
    s.add_argument("--bpm-lo", type=float, default=None)
    s.add_argument("--bpm-hi", type=float, default=None)
    s.add_argument("--key", default=None)
    s.add_argument("--mode", default=None)
    sub.add_parser("table_row_counts")
    sub.add_parser("coverage_report")
    sub.add_parser("integrity_report")
    for name in WRITES:
        s = sub.add_parser(name, help="batch write job; outputs go to --out/<table>")
        s.add_argument("--requests", required=True, help="request file/folder (.csv with header, else Parquet)")
        s.add_argument("--commit", default=None, metavar="JOB", help="apply to the stored catalog as this job (once, also if run again)")
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    from .session import build_session

    spark = build_session(args.master)
    if args.catalog:
        from .sources.files import load_catalog

        cat = load_catalog(spark, args.catalog)
    else:
        from .sources.testdata import from_testdata

        cat = from_testdata(spark, args.testdata)
    op = args.op
    args.out = getattr(args, "sub_out", None) or args.out
    if op in WRITES:
        if args.commit:
            from .sources.files import commit_changes

            if not args.catalog:
                raise SystemExit("--commit needs a stored catalog (--catalog)")
            commit_changes(spark, args.catalog, _changes(cat, op, _read_requests(spark, args.requests)), args.commit, 0, cat.as_of)
            return 0
        if not args.out:
            raise SystemExit("write jobs need --out (a folder; one Parquet folder per output) or --commit")
        for name, df in _write_job(cat, op, _read_requests(spark, args.requests)).items():
            df.write.mode("overwrite").parquet(f"{args.out.rstrip('/')}/{name}")
        return 0
    if op in SEARCHES:
        df = SEARCHES[op](cat, args.term, args.limit)
    elif op in DETAILS:
        ids = None if not args.ids else (args.ids[0] if len(args.ids) == 1 else args.ids)
        df = DETAILS[op](cat, ids)
    elif op in REPORTS:
        df = REPORTS[op](cat, args.limit)
    elif op == "top_rated_tracks":
        df = reports.top_rated_tracks(cat, args.min_ratings, args.limit, args.count_mode)
    elif op == "tracks_by_audio":
        df = discovery.tracks_by_audio(cat, args.bpm_lo, args.bpm_hi, args.key, args.mode)
    elif op == "table_row_counts":
        df = profile.table_row_counts(cat)
    elif op == "integrity_report":
        df = integrity.integrity_report(cat)
    else:
        df = profile.coverage_report(cat)
    if args.out:
        df.write.mode("overwrite").parquet(args.out)
    else:
        df.show(args.rows, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
