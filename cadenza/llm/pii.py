"""Personal data: fixed patterns as seeds, and bootstrapped contextual extraction.

The base patterns find e-mail addresses, IP addresses, card and phone
numbers. These seeds induce lexical patterns: the two words before a seed, the
one word before it (and whether that begins the line), and the word after it.
Spark then scores the bipartite graph of patterns and instances in rounds: a
pattern is as good for a kind as the share of its distinct instances believed
to be of that kind, and an instance as good as the noisy-or of its patterns.
Patterns of enough support and share that are also specific (at least
``SPECIFIC`` of all places where their words stand are next to an
identifier) discover further identifiers that no base pattern knows.

An identifier is a token of at least ``MIN_LENGTH`` characters with a digit
or ``@``, outside all base spans, without the punctuation around it.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import map_batches, materialise, texts_of, unused

KINDS = ["email", "ip", "card", "phone"]
ROUNDS = 3
#: Distinct believed instances that a pattern needs.
SUPPORT = 3.0
#: Share of a pattern's distinct instances that must be believed.
SHARE = 0.6
SPECIFIC = 0.5
MIN_LENGTH = 5
#: Bits of the filter that finds places of candidate patterns; its hits are joined exactly.
FILTER_BITS = 1 << 23
HASH_SEED = 42  # that of Spark's xxhash64

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost, non-overlapping matches, found from each ``@`` outwards in linear time."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
            at = text.find("@", done)
        else:
            done = at + 1
            at = text.find("@", done)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the base patterns, by kind and start."""
    out = [(0, a, b) for a, b in emails(text)]
    out += [(1, *m.span()) for m in _IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split("."))]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13 and 13 <= len(d := _digits(m.group())) <= 19 and luhn(d):
            out.append((2, *m.span()))
    if "+" in text:
        out += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m.group())) <= 15]
    return out


_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyz0000000000")
_AROUND = "\"'`()[]{}<>,;:!?.#*$%&|=~"
_TOKEN = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
CONTEXT_CHARS = 120


def contexts(text: str, start: int, end: int) -> list[str]:
    """Patterns of the place ``start`` to ``end``: words next to it on its line, lower-cased with digits as 0; each needs a letter.

    ``a b`` and ``b`` are the words before it, ``\\nb`` says that b begins the
    line, and `` c`` (with a space in front) is the word after it. A word that
    goes on for ``CONTEXT_CHARS`` characters is no lexical context.
    """
    line = text.rfind("\n", 0, start) + 1
    begin = max(line, start - CONTEXT_CHARS)
    words = text[begin:start].rstrip("\"'`([{< ").split()[-3:]
    if begin > line and len(words) < 3:
        words = words[1:]  # the first one may begin further left
    out = []
    if words:
        out.append(words[-1])
        if len(words) > 1:
            out.append(" ".join(words[-2:]))
        elif begin == line:
            out.append("\n" + words[-1])
    stop = text.find("\n", end, end + CONTEXT_CHARS)
    after = text[end : stop if stop >= 0 else end + CONTEXT_CHARS].lstrip(_AROUND)
    if after[:1].isspace() and (follow := after.split(None, 2)) and (len(follow) > 1 or stop >= 0 or end + CONTEXT_CHARS >= len(text)):
        out.append(" " + follow[0])
    return [p for p in (x.translate(_LOWER) for x in out) if any(c.isalpha() for c in p)]


def identifiers(text: str, taken: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Spans of identifier tokens outside the ``taken`` spans."""
    spans = sorted((a, b) for _, a, b in taken)
    at = 0
    for m in _TOKEN.finditer(text):
        start, end = m.span()
        cut = max(text.rfind("=", start, end - 1), text.rfind(":", start, end - 1))
        if cut >= 0 and any(c.isdigit() or c == "@" for c in text[cut + 1 : end]):
            start = cut + 1
        while start < end and text[start] in _AROUND:
            start += 1
        while end > start and text[end - 1] in _AROUND:
            end -= 1
        while at < len(spans) and spans[at][1] <= start:
            at += 1
        if end - start >= MIN_LENGTH and not (at < len(spans) and spans[at][0] < end):
            yield start, end


_SPAN = pa.struct([("k", pa.int32()), ("s", pa.int32()), ("e", pa.int32())])


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("row_hash"))


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, row_hash, base spans, and per seed or identifier its patterns, instance, kind (null for identifiers) and span."""
    mention = pa.struct([("patterns", pa.list_(pa.string())), ("instance", pa.string()), ("kind", pa.int32()), ("s", pa.int32()), ("e", pa.int32())])

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            spans, mentions = [], []
            for text in texts_of(batch):
                base = base_spans(text)
                found = []
                for kind, a, b in [*base, *((None, a, b) for a, b in identifiers(text, base))]:
                    patterns = contexts(text, a, b)
                    if patterns:
                        found.append({"patterns": patterns, "instance": text[a:b].lower(), "kind": kind, "s": a, "e": b})
                spans.append([{"k": k, "s": a, "e": b} for k, a, b in base])
                mentions.append(found)
            columns = [batch.column("doc_id"), batch.column("row_hash"), pa.array(spans, pa.list_(_SPAN)), pa.array(mentions, pa.list_(mention))]
            yield pa.record_batch(columns, names=["doc_id", "row_hash", "base", "mentions"])

        return step

    schema = "doc_id long, row_hash long, base array<struct<k int, s int, e int>>, mentions array<struct<patterns array<string>, instance string, kind int, s int, e int>>"
    return map_batches(_keyed(docs), make, schema)


def specific(docs: DataFrame, candidates: DataFrame, followed: DataFrame, least: float) -> DataFrame:
    """Of ``candidates(pattern)`` those whose words mostly stand next to an identifier or seed.

    ``followed(pattern, times)`` counts those places; all places are counted
    by a pass over the texts with a filter of fixed size, whose hits are then
    joined exactly.
    """
    bits = candidates.select(F.pmod(F.xxhash64("pattern"), F.lit(FILTER_BITS)).cast("int").alias("bit")).distinct().toArrow().column("bit").to_numpy()
    marked = np.zeros(FILTER_BITS, dtype=bool)
    marked[bits] = True
    packed = np.packbits(marked, bitorder="little").tobytes()

    def make():
        table = packed

        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            seen: dict[str, int] = {}
            digest = xxhash.xxh64_intdigest
            for text in texts_of(batch):
                places: Counter[str] = Counter()
                for line in text.translate(_LOWER).split("\n"):
                    words = line.split()
                    if not words:
                        continue
                    places["\n" + words[0]] += 1
                    places.update(words)
                    places.update([" " + w for w in words[1:]])
                    places.update(map(" ".join, zip(words, words[1:], strict=False)))
                for p, n in places.items():
                    bit = digest(p.encode("utf-8", "surrogatepass"), HASH_SEED) & (FILTER_BITS - 1)
                    if table[bit >> 3] >> (bit & 7) & 1:
                        seen[p] = seen.get(p, 0) + n
            if seen:
                yield pa.record_batch([pa.array(list(seen)), pa.array(list(seen.values()), pa.int64())], names=["pattern", "times"])

        return step

    places = map_batches(docs.select("text"), make, "pattern string, times long").groupBy("pattern").agg(F.sum("times").alias("places"))
    known = candidates.join(followed, "pattern").join(places, "pattern", "left")
    return known.where(F.col("times") >= F.lit(least) * F.coalesce("places", "times")).select("pattern")


def reachable(edges: DataFrame, seeded: DataFrame, rounds: int, support: float, share: float) -> DataFrame:
    """pattern, times: all patterns that could be good in any round.

    The same rounds with every pattern taken as specific and voting for each
    kind it passes for, so beliefs are bounds from above; one pass over the
    texts then tells which of these patterns are specific.
    """
    kinds, slack = range(len(KINDS)), 1e-9  # against the order of sums; the rounds themselves are strict
    beliefs = seeded
    for left in reversed(range(rounds)):
        sums = beliefs.groupBy("pattern").agg(F.count("*").alias("n"), F.sum("times").alias("times"), *(F.sum(f"b{k}").alias(f"b{k}") for k in kinds))
        passes = [(F.col(f"b{k}") >= support - slack) & (F.col(f"b{k}") / F.col("n") >= share - slack) for k in kinds]
        doubts = [F.when(p, F.log1p(-F.least(F.col(f"b{k}") / F.col("n"), F.lit(0.999)))).alias(f"d{k}") for k, p in zip(kinds, passes, strict=True)]
        reached = materialise(sums.where(F.coalesce(*(F.when(p, True) for p in passes), F.lit(False))).select("pattern", "times", *doubts), "reached")
        if left:
            votes = edges.where("kind is null").join(reached.drop("times"), "pattern").groupBy("instance").agg(*((1 - F.exp(F.coalesce(F.sum(f"d{k}"), F.lit(0.0)))).alias(f"v{k}") for k in kinds))
            beliefs = _learned(edges, votes)
    return reached.select("pattern", "times")


def _learned(edges: DataFrame, votes: DataFrame) -> DataFrame:
    """The edges with the belief in each kind: certain at seeds, the votes for their instances at others."""
    kinds = range(len(KINDS))
    beliefs = (F.when(F.col("kind") == k, 1.0).when(F.col("kind").isNotNull(), 0.0).otherwise(F.coalesce(f"v{k}", F.lit(0.0))).alias(f"b{k}") for k in kinds)
    return edges.join(votes, "instance", "left").select("pattern", "times", *beliefs)


def bootstrap(docs: DataFrame, scanned: DataFrame, *, rounds: int = ROUNDS, support: float = SUPPORT, share: float = SHARE, least_specific: float = SPECIFIC) -> DataFrame:
    """Discovered spans: doc_id, row_hash, k, s, e, from the mentions of ``scan``."""
    mentions = scanned.select("doc_id", "row_hash", F.explode("mentions").alias("m")).select("doc_id", "row_hash", "m.*")
    mentions = mentions.select("*", F.explode("patterns").alias("pattern")).drop("patterns")
    # One edge per pattern and instance: copies of a document count once.
    edges = materialise(mentions.groupBy("pattern", "instance").agg(F.max("kind").alias("kind"), F.count("*").alias("times")), "edges")
    kinds = range(len(KINDS))
    seeded = edges.select("*", *(F.when(F.col("kind") == k, 1.0).otherwise(0.0).alias(f"b{k}") for k in kinds))

    def patterns(beliefs: DataFrame) -> DataFrame:
        sums = beliefs.groupBy("pattern").agg(F.count("*").alias("n"), F.sum("times").alias("times"), *(F.sum(f"b{k}").alias(f"b{k}") for k in kinds))
        best = F.greatest(*(F.struct(F.col(f"b{k}").alias("b"), F.lit(-k).alias("k")) for k in kinds))
        return sums.select("pattern", "n", "times", best.alias("best")).select("pattern", "times", (-F.col("best.k")).alias("kind"), F.col("best.b").alias("believed"), (F.col("best.b") / F.col("n")).alias("score"))

    candidates = reachable(edges, seeded, rounds, support, share)
    usable = materialise(specific(docs, candidates.select("pattern"), candidates, least_specific), "specific")
    beliefs = seeded
    for _ in range(rounds):
        good = patterns(beliefs).where((F.col("believed") >= support) & (F.col("score") >= share)).join(usable, "pattern", "left_semi")
        good = materialise(good.select("pattern", F.col("kind").alias("k"), "score"), "patterns")
        doubt = F.log1p(-F.least("score", F.lit(0.999)))
        votes = edges.where("kind is null").join(good, "pattern").groupBy("instance").agg(*(F.coalesce(F.sum(F.when(F.col("k") == k, doubt)), F.lit(0.0)).alias(f"d{k}") for k in kinds))
        votes = materialise(votes.select("instance", *((1 - F.exp(f"d{k}")).alias(f"v{k}") for k in kinds)), "votes")
        beliefs = _learned(edges, votes)
    good = good.withColumnsRenamed({"score": "pattern_score"})
    found = mentions.where("kind is null").join(good, "pattern").join(votes, "instance")
    score = F.element_at(F.array(*(F.col(f"v{k}") for k in kinds)), F.col("k") + 1)
    # The patterns of one place may speak for several kinds: the best one counts.
    best = found.select("*", score.alias("score")).where(F.col("score") >= share).groupBy("doc_id", "row_hash", "s", "e").agg(F.max(F.struct("score", (-F.col("k")).alias("k"))).alias("best"))
    return best.select("doc_id", "row_hash", (-F.col("best.k")).cast("int").alias("k"), "s", "e")


def _with_found(base: DataFrame, found: DataFrame, row_hash: str = "row_hash", name: str = "found") -> DataFrame:
    """``base`` with the found spans of its rows as column ``name``; ``row_hash`` is its column with the hash of the text."""
    id_, hash_ = unused(base, "f_id"), unused(base, "f_hash")
    grouped = found.groupBy(F.col("doc_id").alias(id_), F.col("row_hash").alias(hash_)).agg(F.collect_list(F.struct("k", "s", "e")).alias(name))
    on = F.col("doc_id").eqNullSafe(F.col(id_)) & F.col(row_hash).eqNullSafe(F.col(hash_))
    return base.join(grouped, on, "left").drop(id_, hash_)


def _written(spans: Column) -> Column:
    """kind:start:end, comma-joined, by kind and start."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"], x["e"])), ",")


def find(docs: DataFrame, **options: float) -> DataFrame:
    """Personal data in every row of ``docs(doc_id, text)``.

    Returns doc_id, row_hash (xxhash64 of the text), ``base`` (spans of the
    base patterns) and ``spans`` (these and the discovered ones), both sorted
    arrays of (k: index into KINDS, s, e) in code points. Null text is empty;
    rows with equal doc_id and text get equal spans; other columns are
    ignored; no rows give no rows.
    """
    scanned = materialise(scan(docs), "scan")
    found = materialise(bootstrap(docs, scanned, **options), "found")
    rows = _with_found(scanned.select("doc_id", "row_hash", "base"), found)
    none = F.array().cast("array<struct<k int, s int, e int>>")
    return rows.select("doc_id", "row_hash", "base", F.array_sort(F.concat("base", F.coalesce("found", none))).alias("spans"))


def digest(found: DataFrame) -> DataFrame:
    """The counts and digests of ``find``'s rows."""

    def count(k: int) -> Column:
        return F.size(F.filter("base", lambda x: x["k"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    counts = map(count, range(len(KINDS)))
    return found.select("doc_id", *counts, F.sha2(_written(F.col("base")), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with every span as <KIND>; overlapping spans become one, named by the first."""
    out, at = [], 0
    for s, e, k in sorted((s, e, k) for k, s, e in spans):
        if s >= at:
            out += [text[at:s], f"<{KINDS[k].upper()}>"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, **options: float) -> DataFrame:
    """``docs`` with all personal data masked in ``text``, and ``n_chars`` (if there) set to the new length; null text stays null."""
    scanned = materialise(scan(docs), "scan")
    found = materialise(bootstrap(docs, scanned, **options), "found")
    row_hash, name = unused(docs, "row_hash"), unused(docs, "found")
    rows = _with_found(docs.withColumn(row_hash, F.xxhash64("text")).withColumn("doc_id", F.col("doc_id").cast("long")), found, row_hash, name)
    columns = docs.columns
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}

    def make():
        def step(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            new = []
            for text, extra in zip(batch.column("text").to_pylist(), batch.column(name).to_pylist(), strict=True):
                new.append(None if text is None else masked(text, [*base_spans(text), *((x["k"], x["s"], x["e"]) for x in extra or [])]))
            yield pa.record_batch([pa.array(new, pa.string()) if c == "text" else batch.column(c) for c in columns], names=columns)

        return step

    out = map_batches(rows.select(*columns, name), make, ", ".join(f"`{c}` {kinds[c]}" for c in columns))
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in columns else out
