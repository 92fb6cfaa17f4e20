import itertools
import re

from cadenza.llm import filteraudit as A

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def failures(text):
    words = WORDS.findall(text)
    return [
        len(words) < 50,
        100 * len(set(words)) < 65 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
        bool(re.search("[#$%&*|]", text)),
    ]


def brute(docs, labels):
    """Rows of the audit by applying the filters one after the other."""
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    texts = [(i, t or "", s or "") for i, t, s in docs]
    facts = []
    for i, t, s in texts:
        copy = any(o == t and j is not None and i is not None and j < i for j, o, _ in texts)
        facts.append((s, dict(zip("ABCDE", [*failures(t), copy])), i in good, i in toxic))
    out, shapley = [], {}
    for part in {s for s, *_ in facts}:
        mine = [f for f in facts if f[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = mine
            for k, f in enumerate(order):
                gone = [d for d in left if d[1][f]]
                left = [d for d in left if not d[1][f]]
                failing = sum(d[1][f] for d in mine)
                alone = sum(d[1][f] and sum(d[1].values()) == 1 for d in mine)
                shapley[part, f] = shapley.get((part, f), 0) + len(gone)
                out.append((part, "".join(order), k + 1, len(left), len(gone), failing - len(gone), alone, sum(d[2] for d in gone), sum(d[3] for d in gone)))
    return sorted((*r, shapley[r[0], r[1][r[2] - 1]]) for r in out)


def test_swap_chain_visits_every_order_once():
    for n in range(6):
        order, seen = list(range(n)), set()
        seen.add(tuple(order))
        for level in A.swap_chain(n):
            order[level], order[level + 1] = order[level + 1], order[level]
            seen.add(tuple(order))
        assert len(seen) == len(A.swap_chain(n)) + 1 == len(list(itertools.permutations(range(n))))


def test_diagram_keeps_its_function_and_shares_nodes():
    masks = {0: (5, 1), 1: (3, 0), 2: (3, 0), 7: (2, 2), 4: (1, 0)}
    d = A.Diagram(masks, 3, 2)
    for level in [*A.swap_chain(3), 0, 1, 0]:
        for mask in range(8):
            node = d.root
            for f in d.order:
                node = d.children[node][mask >> f & 1]
            assert d.weight[node] == masks.get(mask, (0, 0))
        assert d.weight[d.root] == (14, 3)
        assert all(len(set(t.values())) == len(t) and t == {d.children[n]: n for n in t.values()} for t in d.levels)
        d.swap(level)
    same = A.Diagram(dict.fromkeys(range(32), (1,)), 5, 1)
    assert [len(t) for t in same.levels] == [1] * 5  # equal sub-diagrams are one node


def test_audit_equals_one_filter_after_the_other(spark):
    prose = " ".join(f"w{i}" for i in range(60))
    docs = [
        (1, prose, "web"), (2, prose, "web"), (3, prose, "news"), (4, "short", "web"), (5, "short", None), (6, None, None), (7, "", ""), (8, "THIS IS LOUD " * 30, "web"),
        (9, "a b " * 40, "news"), (10, prose + " 100%", "news"), (11, prose + " 100%", "web"), (0, prose.upper(), "web"), (12, "\x0b\x1f\x85 " + prose, "web"), (13, "é" * 5000, "news"),
        (2, prose, "web"), (2, "other", "web"), (None, prose, "web"), (None, "alone", "web"), (None, None, "web"), (14, "x " * 200_000, "web"), (15, "\x1c".join("abc") * 70, "web"),
    ]
    labels = [(1, 1, 0), (2, 0, 1), (4, 1, 1), (9, None, 1), (9, 1, None), (11, 1, 0), (8, 0, 0), (99, 1, 1), (None, 1, 1)]
    df = spark.createDataFrame([(*d, 3, "m") for d in docs], "doc_id long, text string, source string, n int, mask string").repartition(4)
    lf = spark.createDataFrame([(*r, 1) for r in labels], "doc_id int, quality int, toxic int, n int").repartition(2)
    got = A.audit(df, lf)
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    rows = sorted(tuple(r) for r in got.collect())
    assert len(rows) == 600 * 3 and rows == brute(docs, [x for x in labels if x[0] is not None])
    assert A.audit(df.limit(0), lf).collect() == []
    assert A.audit(df, lf.limit(0)).where("good_lost > 0 or toxic_lost > 0").count() == 0


def test_masks_of_any_number_of_filters(spark):
    masks = spark.createDataFrame([("p", 0, 4, 1), ("p", 3, 2, 2), ("p", 1, 1, 0)], "part string, mask int, n long, extra long")
    rows = {(r.filter_order, r.step): r for r in A.audit_masks(masks, "xy", ("extra",)).collect()}
    assert len(rows) == 4 and rows["xy", 1].removed == 3 and rows["xy", 2].removed == 0 and rows["yx", 1].removed == 2 and rows["yx", 2].removed == 1
    assert rows["yx", 1].extra_lost == 2 and rows["yx", 1].shapley == 2 and rows["xy", 1].shapley == 4 and rows["xy", 2].redundant == 2
