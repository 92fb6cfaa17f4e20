"""SentencePiece encoding with byte spans in the original text, and decoding.

``Normaliser`` rewrites a text by longest prefixes of the model's compiled
character map (a double-array trie) and records for every normalised
character the original byte that it starts at. ``Encoder`` segments the
normalised text by byte-pair merges in the order of the pieces' scores and
projects every piece to its original byte span.

Where no piece of the vocabulary has a word start inside, words are
independent: each distinct word is segmented once per worker. A character
that occurs in no longer piece likewise separates what is around it.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import texts_of

SPACE = "▁"
#: Words that a worker keeps before it starts afresh (a memory bound only).
MEMO_WORDS = 800_000
_RUNS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


class CharacterMap:
    """The compiled map: uint32 size of the trie, the double-array trie, then NUL-ended replacements."""

    def __init__(self, blob: bytes):
        size = int.from_bytes(blob[:4], "little") if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if size else []
        self.texts = blob[4 + size :]

    def longest(self, raw: bytes, at: int) -> tuple[int, bytes] | None:
        """(length, replacement) of the longest key that ``raw`` has at ``at``."""
        units, found = self.units, None
        if not units:
            return None
        node = _offset(units[0])
        for i in range(at, len(raw)):
            node ^= raw[i]
            if node >= len(units) or units[node] & 0x800000FF != raw[i]:
                break
            leaf = units[node] >> 8 & 1
            node ^= _offset(units[node])
            if leaf:
                found = (i + 1 - at, units[node] & 0x7FFFFFFF)
        if found is None:
            return None
        return found[0], self.texts[found[1] : self.texts.index(b"\0", found[1])]


def _offset(unit: int) -> int:
    return (unit >> 10) << ((unit & 0x200) >> 6)


class Normaliser:
    """Normalisation by a model's specification, with source alignment."""

    def __init__(self, charsmap: bytes, *, dummy_prefix: bool = True, squeeze: bool = False, escape: bool = True):
        self.map = CharacterMap(charsmap)
        self.dummy_prefix, self.squeeze = dummy_prefix, squeeze
        self.space = SPACE if escape else " "
        #: Spaces become word starts one by one and nothing else changes.
        self.plain = not self.map.units and not squeeze and escape and dummy_prefix

    def __call__(self, text: str) -> tuple[str, list[int]]:
        """(normalised text, original byte at which each of its characters starts, and the end)."""
        raw = text.encode("utf-8")
        pieces: list[tuple[str, int, int]] = []  # replacement, original start and end
        at = 0
        while at < len(raw):
            hit = self.map.longest(raw, at)
            if hit is None:
                lead = raw[at]
                width = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
                hit = width, raw[at : at + width]
            pieces.append((hit[1].decode("utf-8"), at, at + hit[0]))
            at += hit[0]
        if not raw:
            return "", [0]
        first = 0
        if self.squeeze:
            while first < len(pieces) and not pieces[first][0].strip(" "):
                first += 1
            if first == len(pieces):
                return "", [0]
        out: list[str] = []
        source: list[int] = []
        if self.dummy_prefix:
            out.append(self.space)
            source.append(pieces[first][1])
        after_space = self.squeeze
        for new, begin, _ in pieces[first:]:
            if after_space:
                new = new.lstrip(" ")
            for c in new:
                out.append(self.space if c == " " else c)
                source.append(begin)
            if new:
                after_space = self.squeeze and new.endswith(" ")
        end = pieces[-1][2]
        if self.squeeze:
            while out and out[-1] == self.space:
                out.pop()
                end = source.pop()
        return "".join(out), [*source, end]


class Encoder:
    """A sentencepiece BPE model: pieces, merges, byte fallback and decoding."""

    def __init__(self, path: str, entries: int = MEMO_WORDS):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        with open(path, "rb") as f:
            model = pb.ModelProto.FromString(f.read())
        kind, spec = pb.ModelProto.SentencePiece, model.normalizer_spec
        if model.trainer_spec.model_type != pb.TrainerSpec.BPE or model.trainer_spec.treat_whitespace_as_suffix:
            raise ValueError("only BPE models with word starts are supported")
        if any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in model.pieces):
            raise ValueError("models with user-defined or unused pieces are not supported")
        self.normalise = Normaliser(spec.precompiled_charsmap, dummy_prefix=spec.add_dummy_prefix, squeeze=spec.remove_extra_whitespaces, escape=spec.escape_whitespaces)
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == kind.NORMAL}
        self.scores = {p.piece: p.score for p in model.pieces if p.type == kind.NORMAL}
        self.unknown = next(i for i, p in enumerate(model.pieces) if p.type == kind.UNKNOWN)
        self.bytes = [next(i for i, p in enumerate(model.pieces) if p.type == kind.BYTE and p.piece == f"<0x{b:02X}>") for b in range(256)] if model.trainer_spec.byte_fallback else None
        self.joins = {c for p in self.ids if len(p) > 1 for c in p}
        self.by_word = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in self.ids)
        self.processor = sentencepiece.SentencePieceProcessor(model_file=path)
        self.entries = entries
        self.memo: dict[str, tuple[tuple[int, ...], tuple[int, ...]]] = {}  # word -> ids, source bytes under each

    def merge(self, word: str) -> list[str]:
        """Pieces of a stretch of normalised text: the best-scored neighbouring pair first, the leftmost of equals."""
        scores, parts = self.scores, list(word)
        if len(parts) <= 32:
            while len(parts) > 1:
                best, at = None, -1
                for i in range(len(parts) - 1):
                    s = scores.get(parts[i] + parts[i + 1])
                    if s is not None and (best is None or s > best):
                        best, at = s, i
                if best is None:
                    break
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            return parts
        after, before = [*range(1, len(parts)), -1], [*range(-1, len(parts) - 1)]
        heap = [(-s, i, p) for i in range(len(parts) - 1) if (s := scores.get(p := parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, p = heapq.heappop(heap)
            j = after[i] if parts[i] else -1
            if j < 0 or parts[i] + parts[j] != p:
                continue  # one side has been merged meanwhile
            parts[i], parts[j], after[i] = p, "", after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b >= 0 and (s := scores.get(q := parts[a] + parts[b])) is not None:
                    heapq.heappush(heap, (-s, a, q))
        return [p for p in parts if p]

    def pieces(self, word: str) -> Iterator[str]:
        """Pieces of a stretch; characters that no longer piece holds stand alone."""
        at = 0
        for i, c in enumerate(word):
            if c not in self.joins:
                if i > at:
                    yield from self.merge(word[at:i])
                yield c
                at = i + 1
        if at < len(word):
            yield from self.merge(word[at:])

    def _ids(self, word: str) -> tuple[tuple[int, ...], tuple[int, ...]]:
        """Ids of a word of a plainly normalised text, and how many source bytes lie under each.

        A word start is one space; of the bytes of an unknown character the
        last piece has the width.
        """
        out: list[int] = []
        widths: list[int] = []
        for p in self.pieces(word):
            i = self.ids.get(p)
            if i is not None:
                out.append(i)
                widths.append(len(p.encode("utf-8")) - 2 * p.count(SPACE))
            else:
                raw = p.encode("utf-8")
                out += [self.bytes[b] for b in raw]
                widths += [0] * (len(raw) - 1) + [len(raw) - 2 * p.count(SPACE)]
        return tuple(out), tuple(widths)

    def _known(self, word: str) -> tuple[tuple[int, ...], tuple[int, ...]]:
        found = self.memo.get(word)
        if found is None:
            if len(self.memo) >= self.entries:
                self.memo.clear()
            lines = word.split("\n") if "\n" in word and "\n" not in self.joins else None
            if lines and len(lines) == 2:  # the two sides of a line break are words that recur
                parts = self._known(lines[0]), self._ids("\n"), self._known(lines[1])
                found = tuple(tuple(chain.from_iterable(x)) for x in zip(*parts, strict=True))
            else:
                found = self._ids(word)
            self.memo[word] = found
        return found

    def encode(self, text: str) -> tuple[list[int], np.ndarray, np.ndarray]:
        """(ids, first bytes, end bytes) of a text's pieces, as ``spans`` has them; words are looked up whole where they can be."""
        if not (self.normalise.plain and self.by_word and self.bytes):
            found = self.spans(text)
            return [x[0] for x in found], np.array([x[1] for x in found], dtype=np.int64), np.array([x[2] for x in found], dtype=np.int64)
        if not text:
            return [], np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        normal = SPACE + text.replace(" ", SPACE)
        if SPACE * 2 in normal:
            words = _RUNS.findall(normal)
        else:
            words = [SPACE + w for w in normal.split(SPACE)[1:]]
        try:
            found = list(map(self.memo.__getitem__, words))
        except KeyError:
            found = list(map(self._known, words))
        ids = list(chain.from_iterable(x[0] for x in found))
        widths = np.fromiter(chain.from_iterable(x[1] for x in found), dtype=np.int64, count=len(ids))
        if SPACE in text:  # a word start that the text itself holds has three bytes, not one
            return ids, *self._spans_of(text)
        widths[0] -= 1  # the dummy prefix has no source
        ends = np.cumsum(widths)
        return ids, ends - widths, ends

    def _spans_of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        found = self.spans(text)
        return np.array([x[1] for x in found], dtype=np.int64), np.array([x[2] for x in found], dtype=np.int64)

    def spans(self, text: str) -> list[tuple[int, int, int]]:
        """(id, first byte, end byte) of every piece in the original UTF-8 text.

        Of the bytes of an unknown character the last piece has its span, the
        others an empty one at its start.
        """
        normal, source = self.normalise(text)
        out: list[tuple[int, int, int]] = []
        at = 0
        for word in _RUNS.findall(normal) if self.by_word else [normal] if normal else []:
            for p in self.pieces(word):
                begin, end = source[at], source[at + len(p)]
                at += len(p)
                i = self.ids.get(p)
                if i is not None:
                    out.append((i, begin, end))
                elif self.bytes:
                    *some, last = (self.bytes[b] for b in p.encode("utf-8"))
                    out += [(b, begin, begin) for b in some] + [(last, begin, end)]
                elif out and out[-1][0] == self.unknown:
                    out[-1] = (self.unknown, out[-1][1], end)
                else:
                    out.append((self.unknown, begin, end))
        return out

    def decode(self, ids: list[int]) -> str:
        return self.processor.decode(ids)


@functools.cache
def encoder(path: str) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(path)


#: Columns that ``encode`` can return besides doc_id.
OUTPUTS = {
    "n_tokens": "long",
    "ids": "array<int>",
    "begins": "array<int>",
    "ends": "array<int>",
    "decoded": "string",
    "ids_sha256": "string",
    "decoded_sha256": "string",
    "spans_crc32": "long",
}


def encode(docs: DataFrame, model: str, outputs: tuple[str, ...] = ("n_tokens", "ids", "begins", "ends", "decoded")) -> DataFrame:
    """Encode ``docs(doc_id, text)`` with the sentencepiece model at ``model``.

    ``begins`` and ``ends`` are the byte spans of the pieces in the original
    text, ``decoded`` is the text that the ids decode to, the digests are hex
    SHA-256 of the comma-joined ids and of the decoded text, ``spans_crc32`` is
    the crc32 of (begin, end) pairs as little-endian uint32. Null text is
    empty and has no ids; repeated rows and null ids pass as they come; other
    columns are ignored; no rows give no rows.
    """
    kinds = {"long": pa.int64(), "array<int>": pa.list_(pa.int32()), "string": pa.string()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model)
        decimal = [str(i) for i in range(enc.processor.get_piece_size())]
        for b in batches:
            rows: list[dict] = []
            for text in texts_of(b):
                ids, begins, ends = enc.encode(text)
                row = {"n_tokens": len(ids), "ids": ids, "begins": begins, "ends": ends}
                if "spans_crc32" in outputs:
                    row["spans_crc32"] = zlib.crc32(np.stack([begins, ends], axis=1).astype("<u4").tobytes())
                if "ids_sha256" in outputs:
                    row["ids_sha256"] = hashlib.sha256(",".join(map(decimal.__getitem__, ids)).encode()).hexdigest()
                if "decoded" in outputs or "decoded_sha256" in outputs:
                    row["decoded"] = enc.decode(ids)
                    row["decoded_sha256"] = hashlib.sha256(row["decoded"].encode("utf-8")).hexdigest()
                rows.append({k: row[k] for k in outputs})
            columns = [pa.array([r[k] for r in rows], kinds[OUTPUTS[k]]) for k in outputs]
            yield pa.record_batch([b.column("doc_id"), *columns], names=["doc_id", *outputs])

    schema = ", ".join(["doc_id long", *(f"{k} {OUTPUTS[k]}" for k in outputs)])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, schema)
