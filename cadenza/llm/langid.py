"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads the bytes of a whole text (lower-cased, runs of white space
as one space) in both directions, labels every position with a distribution
over languages, and is trained in numpy by backpropagation through time on the
mean cross-entropy of all positions. States run on across words and lines. A
text of more than ``WINDOW`` bytes is read in windows of that many: each
starts ``OVERLAP`` bytes before and ends ``OVERLAP`` bytes after the positions
that it labels, so that both states are warm there, and every position is
labelled by exactly one window. A document's probabilities are the mean of the
labels of all its positions.

Training rows are a bounded sample: about ``DOCS_PER_LANGUAGE`` documents of
each language, chosen by the hash of their id, and of each at most
``PASSAGES_PER_DOC`` passages of ``PASSAGE`` bytes, spread over the whole text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise, release, texts_of

#: Positions that one run labels, and the bytes read before and after them.
WINDOW = 512
OVERLAP = 32
HIDDEN = 8
EMBED = 8
DOCS_PER_LANGUAGE = 300
PASSAGES_PER_DOC = 6
PASSAGE = 64
EPOCHS = 3
BATCH = 32
RATE = 0.01
SEED = 7
UNKNOWN = "und"
#: Windows run side by side, and bytes of texts that a task cuts up at a time (memory bounds only).
ROWS = 512
BYTES = 4 << 20
#: Counts of languages up to this size are broadcast.
BROADCAST_BYTES = 8 << 20

_LETTER = re.compile(r"[^\W\d_]")


def positions(text: str) -> bytes:
    """The bytes of a whole text that the network reads."""
    return b" ".join(text.lower().encode("utf-8", "surrogatepass").split())


def windows(data: bytes) -> list[tuple[bytes, int, int]]:
    """(bytes read, first labelled place, end of the labelled places) of each window, in order."""
    out = []
    for at in range(0, len(data), WINDOW):
        first = max(0, at - OVERLAP)
        out.append((data[first : at + WINDOW + OVERLAP], at - first, min(at + WINDOW, len(data)) - first))
    return out


@dataclass
class Network:
    """Weights: byte embedding, per direction an input, a recurrent and a bias block for (update, reset, candidate), and the output layer."""

    labels: list[str]
    weights: dict[str, np.ndarray]

    @staticmethod
    def fresh(labels: list[str], seed: int = SEED) -> Network:
        rng = np.random.default_rng(seed)
        w = {"embed": rng.normal(0, 0.5, (256, EMBED))}
        for d in "fb":
            w[f"x{d}"] = rng.normal(0, 1 / np.sqrt(EMBED), (EMBED, 3 * HIDDEN))
            w[f"h{d}"] = rng.normal(0, 1 / np.sqrt(HIDDEN), (HIDDEN, 3 * HIDDEN))
            w[f"b{d}"] = np.zeros(3 * HIDDEN)
        w["out"] = rng.normal(0, 1 / np.sqrt(2 * HIDDEN), (2 * HIDDEN, len(labels)))
        w["bias"] = np.zeros(len(labels))
        return Network(labels, {k: v.astype(np.float32) for k, v in w.items()})


def pad(batch: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows from long to short: (time, row) byte codes, the place of each row in ``batch``, and how many rows each step still has."""
    lengths = np.array([len(b) for b in batch])
    order = np.argsort(-lengths, kind="stable")
    width = max(int(lengths.max()), 1)
    codes = np.frombuffer(b"".join(batch[i].ljust(width, b"\0") for i in order), dtype=np.uint8).reshape(len(batch), width)
    active = len(batch) - np.searchsorted(lengths[order][::-1], np.arange(width), side="right")
    return codes.T.astype(np.intp, order="C"), order, active


def _softsign(x: np.ndarray) -> None:
    """x / (1 + abs(x)) in place: the activation of the gates and the candidate, a fraction of the cost of tanh."""
    size = np.abs(x)
    size += 1
    x /= size


def _run(net: Network, codes: np.ndarray, active: np.ndarray, d: str, keep: bool = False) -> tuple[np.ndarray, list]:
    """(time, unit, row) hidden states of one direction, zero beyond a row's end."""
    w, h_n = net.weights, HIDDEN
    table = np.ascontiguousarray((w["embed"] @ w[f"x{d}"] + w[f"b{d}"]).T)  # every byte's share of the gates, once
    recurrent = np.ascontiguousarray(w[f"h{d}"].T)
    gates, candidate = recurrent[: 2 * h_n], recurrent[2 * h_n :]
    time, rows = codes.shape
    states, saved = np.zeros((time, h_n, rows), dtype=table.dtype), []
    h = np.zeros((h_n, rows), dtype=table.dtype)
    for t in range(time) if d == "f" else range(time - 1, -1, -1):
        n = active[t]
        h = h[:, :n]
        x = table.take(codes[t, :n], axis=1, mode="clip")
        zr = gates @ h
        zr += x[: 2 * h_n]
        _softsign(zr)
        zr *= 0.5
        zr += 0.5
        z, r = zr[:h_n], zr[h_n:]
        rh = r * h
        c = candidate @ rh
        c += x[2 * h_n :]
        _softsign(c)
        if keep:
            saved.append((t, n, h, z, r, rh, c))
        step = c - h
        step *= z
        np.add(h, step, out=states[t, :, :n])
        h = states[t]
    return states, saved


def _softmax(x: np.ndarray) -> np.ndarray:
    """Over the labels of (time, label, row) logits."""
    e = np.exp(x - x.max(axis=1, keepdims=True))
    e /= e.sum(axis=1, keepdims=True)
    return e


def gradients(net: Network, batch: list[bytes], target: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Mean cross-entropy over all positions and its gradients, through time in both directions."""
    w, h_n = net.weights, HIDDEN
    codes, order, active = pad(batch)
    target, rows = target[order], np.arange(len(batch))
    mask = (rows[None, :] < active[:, None]).astype(w["out"].dtype)
    forward, saved_f = _run(net, codes, active, "f", keep=True)
    backward, saved_b = _run(net, codes, active, "b", keep=True)
    both = np.concatenate([forward, backward], axis=1)
    delta = _softmax(w["out"].T @ both + w["bias"][:, None])
    count = mask.sum()
    loss = float(-(np.log(delta[:, target, rows] + 1e-12) * mask).sum() / count)
    delta[:, target, rows] -= 1
    delta *= mask[:, None, :] / count
    g = {k: np.zeros_like(v) for k, v in w.items()}
    g["out"] = np.tensordot(both, delta, axes=([0, 2], [0, 2]))
    g["bias"] = delta.sum(axis=(0, 2))
    d_both = w["out"] @ delta
    for d, saved, share in (("f", saved_f, d_both[:, :h_n]), ("b", saved_b, d_both[:, h_n:])):
        rec = w[f"h{d}"]
        d_h = np.zeros((h_n, len(batch)), dtype=rec.dtype)
        parts = []
        for t, n, h, z, r, rh, c in reversed(saved):
            d_new = d_h[:, :n] + share[t, :, :n]
            d_c = d_new * z * (1 - np.abs(c)) ** 2
            d_rh = rec[:, 2 * h_n :] @ d_c
            d_zr = np.concatenate([d_new * (c - h), d_rh * h]) * 0.5 * (1 - np.abs(2 * np.concatenate([z, r]) - 1)) ** 2
            g[f"h{d}"][:, : 2 * h_n] += h @ d_zr.T
            g[f"h{d}"][:, 2 * h_n :] += rh @ d_c.T
            parts.append((codes[t, :n], np.concatenate([d_zr, d_c]).T))
            d_h[:, :n] = d_new - d_new * z + d_rh * r + rec[:, : 2 * h_n] @ d_zr
        table_grad = _by_byte(np.concatenate([k for k, _ in parts]), np.concatenate([v for _, v in parts]))
        g["embed"] += table_grad @ w[f"x{d}"].T
        g[f"x{d}"] = w["embed"].T @ table_grad
        g[f"b{d}"] = table_grad.sum(axis=0)
    return loss, g


def _by_byte(codes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Sum of the rows of each byte."""
    order = np.argsort(codes, kind="stable")
    present, first = np.unique(codes[order], return_index=True)
    out = np.zeros((256, rows.shape[1]), dtype=rows.dtype)
    if len(present):
        out[present] = np.add.reduceat(rows[order], first, axis=0)
    return out


def train(samples: list[tuple[bytes, str]], *, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> Network:
    """Fit a network to (passage, language) samples with Adam. Languages weigh alike, whatever their share."""
    labels = sorted({lang for _, lang in samples})
    net = Network.fresh(labels, seed)
    by_label = [[s for s, lang in samples if lang == name and s] for name in labels]
    size = max((len(x) for x in by_label), default=0)
    rng = np.random.default_rng(seed)
    first = {k: np.zeros_like(v) for k, v in net.weights.items()}
    second = {k: np.zeros_like(v) for k, v in net.weights.items()}
    step, total = 0, epochs * (-(-size * len(labels) // BATCH))
    for _ in range(epochs):
        rows = [(s, k) for k, own in enumerate(by_label) for s in (own[i % len(own)] for i in range(size if own else 0))]
        rows = [rows[i] for i in rng.permutation(len(rows))]
        for at in range(0, len(rows), BATCH):
            part = rows[at : at + BATCH]
            _, g = gradients(net, [s for s, _ in part], np.array([k for _, k in part]))
            step += 1
            lr = rate * max(0.05, 1 - step / max(total, 1))
            for k, v in g.items():
                v = np.clip(v, -1, 1)
                first[k] = 0.9 * first[k] + 0.1 * v
                second[k] = 0.999 * second[k] + 0.001 * v * v
                hat = first[k] / (1 - 0.9**step) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
                net.weights[k] = (net.weights[k] - lr * hat).astype(np.float32)
    return net


def pooled(net: Network, texts: list[bytes]) -> np.ndarray:
    """Sum of the position probabilities of each text, one row per text."""
    out = np.zeros((len(texts), len(net.labels)))
    cut = [(i, *w) for i, data in enumerate(texts) for w in windows(data)]
    cut.sort(key=lambda w: len(w[1]))  # windows of like length together
    for at in range(0, len(cut), ROWS):
        part = cut[at : at + ROWS]
        codes, order, active = pad([w[1] for w in part])
        owner, first, end = (np.array([part[i][k] for i in order]) for k in (0, 2, 3))
        states = [_run(net, codes, active, d)[0] for d in "fb"]
        found = np.zeros((len(net.labels), len(part)))
        for t in range(0, len(codes), 64):
            place = np.arange(t, min(t + 64, len(codes)))[:, None]
            labelled = (place >= first) & (place < end)
            logits = net.weights["out"][:HIDDEN].T @ states[0][t : t + 64] + net.weights["out"][HIDDEN:].T @ states[1][t : t + 64]
            found += (_softmax(logits + net.weights["bias"][:, None]) * labelled[:, None, :]).sum(axis=0)
        np.add.at(out, owner, found.T)
    return out


def passages(text: str, limit: int = PASSAGES_PER_DOC) -> list[bytes]:
    """At most ``limit`` passages of ``PASSAGE`` bytes at even distances over the whole text, those with a letter."""
    data = positions(text)
    count = min(limit, -(-len(data) // PASSAGE))
    last = max(0, len(data) - PASSAGE)
    starts = [last * i // max(count - 1, 1) for i in range(count)]
    found = [data[at : at + PASSAGE] for at in starts]
    return [s for s in found if _LETTER.search(s.decode("utf-8", "ignore"))]


def sample(docs: DataFrame, usable: Column, *, docs_per_language: int = DOCS_PER_LANGUAGE, passages_per_doc: int = PASSAGES_PER_DOC) -> list[tuple[bytes, str]]:
    """The bounded training sample: (passage, language) of labelled rows for which ``usable`` holds."""
    rows = docs.select(F.col("doc_id").cast("long"), "text", F.col("lang").cast("string")).where(usable & F.col("lang").isNotNull() & F.col("text").isNotNull())
    counts = materialise(rows.groupBy("lang").agg(F.count("*").alias("rows")), "languages")
    size = counts.agg(F.sum(F.octet_length("lang") + 16)).first()[0] or 0
    # Small counts go to the texts; else Spark chooses how the two sides meet.
    chosen = rows.join(F.broadcast(counts) if size <= BROADCAST_BYTES else counts, "lang")
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / F.lit(1_000_003.0)
    chosen = chosen.where(share * F.col("rows") < F.lit(float(docs_per_language)))
    # One row of a chosen doc_id, however often it comes: the sample is bounded by ids, whatever repeats.
    chosen = chosen.groupBy("lang", "doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("first")).select("lang", "first.text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(lang, s) for lang, text in zip(b.column("lang").to_pylist(), texts_of(b), strict=True) for s in passages(text, passages_per_doc)]
            if out:
                yield pa.record_batch([pa.array(c) for c in zip(*out, strict=True)], names=["lang", "passage"])

    found = chosen.mapInArrow(run, "lang string, passage binary").toArrow()
    pairs = zip(found.column("passage").to_pylist(), found.column("lang").to_pylist(), strict=True)
    return sorted(pairs)


def predict(docs: DataFrame, net: Network) -> DataFrame:
    """doc_id, lang_pred, score and row_hash for every row of ``docs(doc_id, text)``.

    ``score`` is the pooled probability of lang_pred. Null texts and texts
    without a letter (and all texts if nothing was learned) get ``und`` and
    score 0.
    """
    labels, weights = net.labels, net.weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        model = Network(labels, weights)
        for b in batches:
            texts = texts_of(b)
            names = [UNKNOWN] * len(texts)
            scores = [0.0] * len(texts)
            known = [i for i, text in enumerate(texts) if labels and _LETTER.search(text)]
            for part in _groups(known, texts):
                p = pooled(model, [positions(texts[i]) for i in part])
                p /= p.sum(axis=1, keepdims=True)
                for i, best, score in zip(part, p.argmax(axis=1).tolist(), p.max(axis=1).tolist(), strict=True):
                    names[i], scores[i] = labels[best], score
            yield pa.record_batch([b.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64()), b.column("row_hash")], names=["doc_id", "lang_pred", "score", "row_hash"])

    rows = docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("row_hash"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double, row_hash long")


def _groups(rows: list[int], texts: list[str]) -> Iterator[list[int]]:
    """``rows`` in runs whose texts hold about ``BYTES`` characters (a longer text is a run of its own)."""
    part: list[int] = []
    size = 0
    for i in rows:
        if part and size + len(texts[i]) > BYTES:
            yield part
            part, size = [], 0
        part.append(i)
        size += len(texts[i])
    if part:
        yield part


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text leaves 1 modulo 3 (a null id is never learned from)."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def identify(docs: DataFrame, *, docs_per_language: int = DOCS_PER_LANGUAGE) -> DataFrame:
    """Learn from the labelled rows of ``docs(doc_id, text, lang)`` that are not held out, and predict every row.

    Returns doc_id, held_out, lang_pred, score and row_hash (xxhash64 of the
    text). Repeated rows give repeated rows, other columns are ignored, and no
    rows give no rows.
    """
    usable = ~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull()
    net = train(sample(docs, usable, docs_per_language=docs_per_language))
    found = predict(docs, net)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "row_hash")
