"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import functools
import gc
import re
import uuid
from array import array
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

#: Entries a worker keeps in a memo before it starts afresh (memory bound, never a result bound).
MEMO_ENTRIES = 500_000
#: Bytes of text whose chunks are looked up together.
GROUP_BYTES = 4_000_000
#: New chunks that one call of the library encodes.
JOINED = 100


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/cadenza-llm/{name}-{uuid.uuid4().hex[:12]}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back.

    Cuts the lineage like a reliable checkpoint (a lost executor loses
    nothing), prunes columns on later reads, and gives the planner a
    measured size for its join choices.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, or the first of name_, name__, ... that is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def filesystem(uri: str):
    """(file system, path) of a shared folder; any store that pyarrow knows."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], Iterable[pa.RecordBatch]]], schema: str) -> DataFrame:
    """``mapInArrow`` with per-task set-up: ``make()`` runs once in the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        step = make()
        for batch in batches:
            if batch.num_rows:
                yield from step(batch)

    return df.mapInArrow(run, schema)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Texts of a batch, null as empty."""
    return [x or "" for x in batch.column(column).to_pylist()]


#: Unicode white space, which the pre-tokenizer and Python see alike. Python's class also holds \\x1c-\\x1f, which it does not.
_SPACE = r"\t\n\x0b\f\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_RUN = re.compile(r"\s{2,}")
_ODD = re.compile("[\x1c-\x1f]")
#: Letters below this are letters for Python and the pre-tokenizer alike.
_PLAIN = "\u0250"


def _byte_alphabet() -> dict[int, str]:
    """The character that byte-level BPE writes for each byte: itself where it shows, else one of a range of its own."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)).difference(shown))
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class MemoEncoder:
    """Byte-level BPE ids by the ``tokenizers`` library, as little-endian uint32 bytes.

    The pre-tokenizer of byte-level BPE always starts a new piece at a single
    space before a non-space, so a text without whitespace runs is the
    concatenation of its space-led chunks. Likewise a line break between
    non-spaces is a piece of its own, so it begins a chunk without a space,
    and so is a full stop or comma after a letter at the end of a chunk. Of a
    whitespace run before a non-space all but the last character form one
    piece, so runs cut a text into stretches without any.

    A group of texts is split and dictionary-encoded by Arrow; each distinct
    chunk that is not known yet is encoded by the library once, many in one
    call (words of letters, each one piece by itself, without the
    pre-tokenizer), and the ids of all chunks are gathered from one buffer. Texts with
    strings of special tokens, which the library finds before all else, go to
    it whole.
    """

    def __init__(self, path: str, entries: int = MEMO_ENTRIES):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.bare = Tokenizer.from_file(path)  # for words already written in the byte alphabet
        self.bare.pre_tokenizer = None
        for t in (self.tokenizer, self.bare):
            t.model._resize_cache(0)  # the memo takes its place
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        alphabet = _byte_alphabet()
        self.lead, self.line = alphabet[0x20], alphabet[0x0A]
        self.spaced = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.spaced[[i for token, i in vocabulary.items() if token.startswith(self.lead)]] = True
        self.broken = np.zeros(len(self.spaced), dtype=bool)
        self.broken[vocabulary[self.line]] = True
        self.letters = {c: "".join(alphabet[b] for b in chr(c).encode()) for c in range(0x80, ord(_PLAIN))}
        special = [re.escape(t.content) for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.special = re.compile("|".join(special) or "(?!)")
        self.unusual = "|".join([f"[{_SPACE}]{{2}}", r"[\x1c-\x1f]", *special])
        self.entries = entries
        self.space, self.newline = self._library([" "])[0], self._library(["\n"])[0]
        self.marks = {x: self._library([x])[0] for x in ".,"}
        self.runs: dict[str, bytes] = {}
        self.old: tuple[dict[str, int], array, array, array] = ({}, array("I"), array("q"), array("i"))
        self._afresh()

    def _afresh(self) -> None:
        """A new memo: chunk (led by a space or a line break) or head of a text -> number of its entry in the buffer."""
        self.memo: dict[str, int] = {}
        self.heads: dict[str, int] = {}
        self.ids, self.start, self.size = array("I"), array("q"), array("i")
        self._add([])

    def _add(self, ids: list[int]) -> int:
        self.start.append(len(self.ids))
        self.size.append(len(ids))
        self.ids.extend(ids)
        return len(self.start) - 1

    def _add_many(self, chunks: list[str], size: np.ndarray, ids: np.ndarray) -> None:
        """Entries of different chunks with ``size`` ids each."""
        first = len(self.start)
        self.start.frombytes((len(self.ids) + np.cumsum(size) - size).astype(np.int64).tobytes())
        self.size.frombytes(size.astype(np.int32).tobytes())
        self.ids.frombytes(ids.astype(np.uint32).tobytes())
        self.memo.update(zip(chunks, range(first, first + len(chunks)), strict=True))

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _numbers(self, chunks: list[str]) -> np.ndarray:
        """Entries of different chunks; new ones are learned. What is met again comes over from the memo before this one."""
        found = list(map(self.memo.get, chunks))
        if None in found:
            missing = [k for k, n in enumerate(found) if n is None]
            self._learn([chunks[k] for k in missing])
            for k in missing:
                found[k] = self.memo[chunks[k]]
        return np.array(found, dtype=np.int64)

    def _learn(self, new: list[str]) -> None:
        memo, marks = self.memo, self.marks
        # What the memo before this one knows comes over, in one go.
        known = list(map(self.old[0].get, new))
        kept = [x for x, n in zip(new, known, strict=True) if n is not None]
        if kept:
            numbers = np.array([n for n in known if n is not None], dtype=np.int64)
            self._add_many(kept, *_entries(*self.old[1:], numbers))
            new = [x for x, n in zip(new, known, strict=True) if n is None]
        rest: dict[str, list[str]] = {" ": [], "\n": []}  # by what leads the chunk
        words: dict[str, dict[str, None]] = {" ": {}, "\n": {}}
        marked: list[tuple[str, str]] = []
        for x in new:
            base = x[:-1] if x[-1:] in marks and x[-2:-1] < _PLAIN and x[-2:-1].isalpha() else x
            lead = "\n" if base[:1] == "\n" else " "
            word = base[1:] if lead == "\n" else base
            if word.isalpha() and (word.isascii() or max(word) < _PLAIN):
                if base is not x:
                    marked.append((x, base))
                if base not in memo:
                    words[lead][base] = None
            elif not x or x == "\n":  # at the very end of a text
                memo[x] = self._add(self.newline if x else self.space)
            else:
                rest[lead].append(x)
        for lead, begins in ((" ", self.spaced), ("\n", self.broken)):
            written = [x if x[:1] == "\n" else " " + x for x in rest[lead]]
            self._learn_joined(rest[lead], written, self.tokenizer, begins)
            bases = list(words[lead])
            letters = [x if x.isascii() else x.translate(self.letters) for x in bases]
            written = [self.line + x[1:] if lead == "\n" else self.lead + x for x in letters]
            self._learn_joined(bases, written, self.bare, begins)
        if marked:
            size, ids = _entries(self.ids, self.start, self.size, np.array([memo[base] for _, base in marked], dtype=np.int64))
            longer = np.empty(len(ids) + len(size), dtype=np.uint32)
            last = np.cumsum(size + 1) - 1
            inner = np.ones(len(longer), dtype=bool)
            inner[last] = False
            longer[inner], longer[last] = ids, [marks[x[-1]][0] for x, _ in marked]
            self._add_many([x for x, _ in marked], size + 1, longer)

    def _learn_joined(self, chunks: list[str], written: list[str], tokenizer, begins: np.ndarray) -> None:
        """Encode different chunks, many in one call; each begins at an id that ``begins`` marks."""
        for at in range(0, len(chunks), JOINED):
            ids = np.array(tokenizer.encode_batch_fast(["".join(written[at : at + JOINED])], add_special_tokens=False)[0].ids, dtype=np.uint32)
            cuts, part = np.flatnonzero(begins[ids]), chunks[at : at + JOINED]
            if len(cuts) != len(part):
                raise ValueError("a vocabulary whose pieces cross the start of a chunk")
            self._add_many(part, np.diff(cuts, append=len(ids)), ids)

    def encode_column(self, column: pa.Array) -> list[bytes]:
        """Ids of every text of an Arrow column (null: empty), in groups of bounded size."""
        texts = pc.fill_null(column.cast(pa.large_string()), "")
        ends = np.cumsum(pc.binary_length(texts).to_numpy())
        out: list[bytes] = []
        at = 0
        while at < len(texts):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + GROUP_BYTES, side="right")))
            out += self._group(texts.slice(at, stop - at))
            at = stop
        return out

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        return self.encode_column(pa.array(texts, pa.large_string()))

    def encode(self, text: str) -> bytes:
        return self.encode_batch([text])[0]

    def _group(self, texts: pa.Array) -> list[bytes]:
        if 2 * (len(self.memo) + len(self.heads)) > self.entries:
            self.old = self.memo, self.ids, self.start, self.size
            self._afresh()
        unusual = pc.match_substring_regex(texts, self.unusual)
        if not pc.any(unusual).as_py():
            return self._chunked(texts)
        # Parts of unusual texts: bytes, or the number of a stretch without whitespace runs.
        parts: dict[int, list[bytes | int]] = {}
        stretches: list[str] = []
        for row in np.flatnonzero(unusual.to_numpy(zero_copy_only=False)).tolist():
            parts[row] = self._parts(texts[row].as_py(), stretches)
        usual = iter(self._chunked(texts.filter(pc.invert(unusual))))
        ids = self._chunked(pa.array(stretches, pa.large_string()))
        return [
            b"".join(p if isinstance(p, bytes) else ids[p] for p in parts[row]) if row in parts else next(usual) for row in range(len(texts))
        ]

    def _parts(self, text: str, stretches: list[str]) -> list[bytes | int]:
        if _ODD.search(text) or self.special.search(text):
            return [_raw(self._library([text])[0])]
        parts: list[bytes | int] = []

        def stretch(part: str) -> None:
            if part:
                parts.append(len(stretches))
                stretches.append(part)

        at = 0
        for m in _RUN.finditer(text):
            stretch(text[at : m.start()])
            at = m.end() if m.end() == len(text) else m.end() - 1
            parts.append(self._run(text[m.start() : at]))
        stretch(text[at:])
        return parts

    def _run(self, blank: str) -> bytes:
        if blank not in self.runs:
            if len(self.runs) > 10_000:
                self.runs.clear()
            self.runs[blank] = _raw(self._library([blank])[0])
        return self.runs[blank]

    def _chunked(self, texts: pa.Array) -> list[bytes]:
        """Ids of texts without whitespace runs."""
        if not len(texts):
            return []
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        chunks, bounds = lists.flatten(), lists.offsets.to_numpy()
        first = bounds[:-1]
        heads = chunks.take(pa.array(first)).to_pylist()
        new = sorted(set(heads).difference(self.heads))
        self.heads.update(zip(new, map(self._add, self._library(new)), strict=True))
        coded = chunks.dictionary_encode()
        entry = self._numbers(coded.dictionary.to_numpy(zero_copy_only=False).tolist())[coded.indices.to_numpy()]
        entry[first] = list(map(self.heads.__getitem__, heads))
        length, ids = _entries(self.ids, self.start, self.size, entry)
        raw = ids.astype("<u4").tobytes()
        stops = (4 * np.cumsum(length)[bounds[1:] - 1]).tolist()
        return [raw[a:b] for a, b in zip([0, *stops[:-1]], stops, strict=True)]


def _entries(ids: array, start: array, size: array, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number of ids of each entry, all their ids one after the other)."""
    length = np.frombuffer(size, dtype=np.int32)[numbers].astype(np.int64)
    place = np.repeat(np.frombuffer(start, dtype=np.int64)[numbers] - np.cumsum(length) + length, length)
    place += np.arange(len(place))
    return length, np.frombuffer(ids, dtype=np.uint32)[place] if len(place) else np.empty(0, dtype=np.uint32)


def _raw(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


@functools.cache
def memo_encoder(path: str) -> MemoEncoder:
    """One encoder per Python worker: workers are reused, so its memo serves many tasks."""
    return MemoEncoder(path)


def release() -> None:
    """Called by tasks without an encoder: a reused worker lets go of an earlier operator's memo."""
    if memo_encoder.cache_info().currsize:
        memo_encoder.cache_clear()
        gc.collect()


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges(a, b)`` (longs): rows (node, root), root the smallest node.

    Alternating large-star and small-star rounds; every round is one written
    table, and the per-node minima are tables of their own, so that a node
    with very many edges stays on a join side that adaptive execution splits.
    """
    lo, hi = F.least("a", "b"), F.greatest("a", "b")
    e = materialise(edges.where("a <> b").select(hi.alias("a"), lo.alias("b")).distinct(), "edges")
    seen = _signature(e)
    while seen[0]:
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = materialise(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "minima")
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        large = materialise(large, "large")
        least = materialise(large.groupBy("a").agg(F.min("b").alias("m")), "minima")
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        e = materialise(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), "edges")
        now = _signature(e)
        if now == seen:
            break
        seen = now
    return e.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(
        e.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _signature(edges: DataFrame) -> tuple:
    h = F.xxhash64("a", "b")
    return tuple(edges.agg(F.count("*"), F.sum(F.shiftright(h, 20)), F.sum(h.bitwiseAND(F.lit(0xFFFFF)))).first())
