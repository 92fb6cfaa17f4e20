from cadenza.__main__ import DETAILS, REPORTS, SEARCHES, WRITES, _parser


def test_every_operator_has_a_sub_command():
    p = _parser()
    for name in list(SEARCHES) + list(DETAILS) + list(REPORTS):
        args = p.parse_args(["--catalog", "/x", name])
        assert args.op == name
    for name in WRITES:
        args = p.parse_args(["--catalog", "/x", name, "--requests", "r.csv", "--out", "/o"])
        assert args.requests == "r.csv" and args.sub_out == "/o"
        assert p.parse_args(["--catalog", "/x", name, "--requests", "r.csv", "--commit", "job"]).commit == "job"


def test_ids_and_limits():
    p = _parser()
    args = p.parse_args(["--testdata", "/t", "track_detail", "--ids", "1", "2"])
    assert args.ids == [1, 2]
    args = p.parse_args(["--catalog", "/c", "top_rated_tracks", "--min-ratings", "5", "--count-mode", "distinct"])
    assert (args.min_ratings, args.count_mode, args.limit) == (5, "distinct", 10)
    assert p.parse_args(["--catalog", "/c", "find_groups"]).limit == 10
    assert p.parse_args(["--catalog", "/c", "search_tracks"]).limit == 20
