"""Language identification by a bidirectional gated recurrent network over bytes, trained in numpy.

Texts are cut into windows of WINDOW bytes; a forward and a backward gated recurrent layer read each window, a
softmax layer labels every position, and a document's probabilities are the mean over the positions of all its
windows. Training is backpropagation through time with Adam on windows of a bounded sample: at most SAMPLE
documents of each language in expectation (those with the least hashes), one window each, and one for each doc_id
however many rows it has; the sample goes to the driver and its size does not grow with the input. Only text and lang of documents outside the held-out fold are
learned from; prediction sees the text alone.

A text that is null or has no letter is `und` with score 0. Without any labelled training document every text is
`und`. A null doc_id stays null and is in no fold. Repeated rows give repeated results; other columns are ignored; an empty table gives no rows. Whole texts
are read, however long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import small_batches, tidy

HIDDEN, WINDOW, SAMPLE, TRAIN_BYTES = 8, 128, 600, 64
RESULT = "doc_id long, held_out boolean, lang_pred string, score double"


def _init(classes: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    h = HIDDEN
    p = {}
    for d in ("f", "b"):
        p[f"E{d}"] = rng.normal(0, 0.3, (3 * h, 256))
        p[f"U{d}"] = rng.normal(0, 0.3, (3 * h, h))
        p[f"c{d}"] = np.zeros((h, 1))
    p["V"] = rng.normal(0, 0.3, (classes, 2 * h))
    p["o"] = np.zeros((classes, 1))
    return p


def _run(p: dict, d: str, x: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """States (time, hidden, batch) of one direction over bytes x (time, batch)."""
    h = np.zeros((HIDDEN, x.shape[1]))
    states, saved = [], []
    for t in range(len(x)):
        a = p[f"E{d}"][:, x[t]]
        g = p[f"U{d}"] @ h
        zr = 1 / (1 + np.exp(-(a[: 2 * HIDDEN] + g[: 2 * HIDDEN])))
        z, r = zr[:HIDDEN], zr[HIDDEN:]
        u = g[2 * HIDDEN :] + p[f"c{d}"]
        n = np.tanh(a[2 * HIDDEN :] + r * u)
        new = n + z * (h - n)
        if keep:
            saved.append((h, z, r, u, n))
        h = new
        states.append(h)
    return np.stack(states), saved


def _back(p: dict, d: str, x: np.ndarray, dh: np.ndarray, saved: list, grad: dict) -> None:
    """Backpropagation through time for one direction; dh: gradient at each state from the labels."""
    run = np.zeros_like(dh[0])
    for t in reversed(range(len(x))):
        h, z, r, u, n = saved[t]
        g = dh[t] + run
        dn = g * (1 - z) * (1 - n * n)
        dz = g * (h - n) * z * (1 - z)
        dr = dn * u * r * (1 - r)
        a = np.concatenate((dz, dr, dn))
        np.add.at(grad[f"E{d}"].T, x[t], a.T)
        rec = np.concatenate((dz, dr, dn * r))
        grad[f"U{d}"] += rec @ h.T
        grad[f"c{d}"] += (dn * r).sum(axis=1, keepdims=True)
        run = g * z + p[f"U{d}"].T @ rec


def train(windows: np.ndarray, labels: np.ndarray, classes: int, steps: int = 250, batch: int = 256, seed: int = 7) -> dict[str, np.ndarray]:
    """Fit the network to windows (n, bytes) whose every position has the window's label."""
    rng = np.random.default_rng(seed)
    p = _init(classes, rng)
    m, v = ({k: np.zeros_like(w) for k, w in p.items()} for _ in range(2))
    by = [np.flatnonzero(labels == c) for c in range(classes)]
    for step in range(1, steps + 1):
        pick = np.concatenate([rng.choice(own, -(-batch // classes)) for own in by])  # languages in equal parts
        x, y = windows[pick].T.astype(np.int64), labels[pick]
        f, sf = _run(p, "f", x, True)
        b, sb = _run(p, "b", x[::-1], True)
        s = np.concatenate((f, b[::-1]), axis=1)
        e = np.einsum("ch,thb->tcb", p["V"], s) + p["o"]
        e = np.exp(e - e.max(axis=1, keepdims=True))
        e /= e.sum(axis=1, keepdims=True)
        e[:, y, np.arange(len(y))] -= 1
        e /= e.shape[0] * e.shape[2]
        grad = {k: np.zeros_like(w) for k, w in p.items()}
        grad["V"] = np.einsum("tcb,thb->ch", e, s)
        grad["o"] = e.sum(axis=(0, 2))[:, None]
        ds = np.einsum("ch,tcb->thb", p["V"], e)
        _back(p, "f", x, ds[:, :HIDDEN], sf, grad)
        _back(p, "b", x[::-1], ds[::-1, HIDDEN:], sb, grad)
        norm = np.sqrt(sum((g * g).sum() for g in grad.values()))
        scale = min(1.0, 1.0 / (norm + 1e-12))
        rate = 0.03 * min(1.0, 2 - 2 * step / (steps + 1))
        for k in p:
            g = grad[k] * scale
            m[k] += 0.1 * (g - m[k])
            v[k] += 0.01 * (g * g - v[k])
            p[k] -= rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)
    return p


class Network:
    """The trained network in single precision; gates are computed through one tanh, of halved inputs."""

    def __init__(self, p: dict[str, np.ndarray]):
        half = np.r_[np.full(2 * HIDDEN, 0.5), np.ones(HIDDEN)][:, None]
        self.E = [np.ascontiguousarray(p[f"E{d}"] * half, np.float32) for d in "fb"]
        self.U = [np.ascontiguousarray(p[f"U{d}"] * half, np.float32) for d in "fb"]
        self.c = [p[f"c{d}"].astype(np.float32) for d in "fb"]
        self.V, self.o = p["V"].astype(np.float32), p["o"].astype(np.float32)
        self.classes = len(self.o)

    def positions(self, x: np.ndarray, valid: np.ndarray) -> np.ndarray:
        """Sums of the positions' probabilities, (classes, batch); x and valid: (time, batch)."""
        steps, n, h = len(x), x.shape[1], HIDDEN
        score = np.empty((steps, self.classes, n), np.float32)
        a, g = np.empty((3 * h, n), np.float32), np.empty((3 * h, n), np.float32)
        for d in range(2):
            V = np.ascontiguousarray(self.V[:, d * h : (d + 1) * h])
            state = np.zeros((h, n), np.float32)
            for t in range(steps) if d == 0 else reversed(range(steps)):
                np.take(self.E[d], x[t], axis=1, out=a, mode="clip")
                np.matmul(self.U[d], state, out=g)
                gate = a[: 2 * h]
                gate += g[: 2 * h]
                np.tanh(gate, out=gate)
                gate += 1
                gate *= 0.5
                new, u = a[2 * h :], g[2 * h :]
                u += self.c[d]
                u *= gate[h:]
                new += u
                np.tanh(new, out=new)
                state -= new
                state *= gate[:h]
                state += new
                if d == 0:
                    np.matmul(V, state, out=score[t])
                else:
                    score[t] += V @ state
                    if not valid[t].all():
                        # padding comes last: the backward layer starts afresh where the text ends
                        state *= valid[t]
        score += self.o
        score -= score.max(axis=1, keepdims=True)
        np.exp(score, out=score)
        score /= score.sum(axis=1, keepdims=True)
        score *= valid[:, None, :]
        return score.sum(axis=0, dtype=np.float64)

    def documents(self, texts: list[bytes], at_once: int = 2048) -> np.ndarray:
        """Pooled probabilities (documents, classes), over every byte of every text."""
        out = np.zeros((len(texts), self.classes))
        rows: list[np.ndarray] = []
        owner: list[np.ndarray] = []
        held = 0

        def flush(last: bool) -> None:
            nonlocal rows, owner, held
            x, own = np.concatenate(rows), np.concatenate(owner)
            size = len(x) // at_once * at_once if not last else len(x)
            for lo in range(0, size, at_once):
                part = np.ascontiguousarray(x[lo : min(lo + at_once, size)].T)
                sums = self.positions(np.maximum(part, 0), (part >= 0).astype(np.float32))
                np.add.at(out, own[lo : min(lo + at_once, size)], sums.T)
            rows, owner, held = [x[size:]], [own[size:]], len(x) - size

        for i, text in enumerate(texts):
            if not text:
                continue
            n = -(-len(text) // WINDOW)
            x = np.full(n * WINDOW, -1, np.int16)
            x[: len(text)] = np.frombuffer(text, np.uint8)
            rows.append(x.reshape(n, WINDOW))
            owner.append(np.full(n, i))
            held += n
            if held >= 4 * at_once:
                flush(False)
        if held:
            flush(True)
        total = out.sum(axis=1, keepdims=True)
        return np.divide(out, total, out=np.zeros_like(out), where=total > 0)


def _held_out(doc_id: Column) -> Column:
    return (F.crc32(doc_id.cast("string").cast("binary")) % 5) == 0


def fit(docs: DataFrame, sample: int = SAMPLE) -> tuple[list[str], dict[str, np.ndarray] | None]:
    """Languages and trained weights, from at most `sample` documents of each language in expectation."""
    known = docs.filter(~F.coalesce(_held_out(F.col("doc_id")), F.lit(True)) & F.col("lang").isNotNull() & (F.col("lang") != "und") & F.col("text").rlike("\\p{L}"))
    counts = {r.lang: r.n for r in known.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row for each language
    if not counts:
        return [], None
    share = F.create_map(*(F.lit(x) for lang, n in sorted(counts.items()) for x in (lang, min(1.0, sample / n))))
    draw = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    place = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.greatest(F.lit(1), F.char_length("text") - TRAIN_BYTES)).cast("int") + 1
    drawn = known.filter(draw < share[F.col("lang")]).select("doc_id", F.struct("lang", F.substring("text", place, F.lit(4 * TRAIN_BYTES)).alias("t")).alias("own"))
    rows = drawn.groupBy("doc_id").agg(F.min("own").alias("own")).select("doc_id", "own.*").collect()
    langs = sorted(counts)
    windows, labels = [], []
    for row in sorted(rows, key=lambda r: (r.doc_id, r.lang, r.t)):
        data = row.t.encode()
        for lo in range(0, max(1, len(data) - TRAIN_BYTES + 1), TRAIN_BYTES):
            piece = data[lo : lo + TRAIN_BYTES]
            windows.append(np.frombuffer(piece.ljust(TRAIN_BYTES), np.uint8))
            labels.append(langs.index(row.lang))
    labels = np.array(labels)
    have = sorted(set(labels.tolist()))  # a language none of whose documents was drawn is not learned
    langs = [langs[i] for i in have]
    return langs, train(np.stack(windows), np.searchsorted(have, labels), len(langs))


def _predict(langs: list[str], weights: dict | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        net = Network(weights) if weights else None
        for batch in batches:
            texts = batch.column("text").to_pylist()
            if net:
                letters = np.array([any(map(str.isalpha, t or "")) for t in texts], bool)
                probs = net.documents([t.encode() if ok else b"" for t, ok in zip(texts, letters.tolist())])
                best = probs.argmax(axis=1)
                pred = [langs[b] if ok else "und" for b, ok in zip(best.tolist(), letters.tolist())]
                score = np.where(letters, np.clip(probs.max(axis=1), 0, 1), 0.0)
            else:
                pred, score = ["und"] * len(texts), np.zeros(len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(pred, pa.string()), pa.array(score)], names=["doc_id", "held_out", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, model: tuple[list[str], dict | None]) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every row of `docs` (doc_id, text)."""
    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(_held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "text")
    return rows.mapInArrow(tidy(_predict(*model)), RESULT)


def keep(docs: DataFrame, model: tuple[list[str], dict | None]) -> DataFrame:
    """The rows of `docs`, with all their columns, whose text is in a known language: `und` is rejected.
    Where no network could be learned, only texts that are null or have no letter are.

    The text itself decides, so the same network labels it in the scan; no join back is needed. Repeated rows stay
    or go together, rows without doc_id are judged like others; columns may have any names; an empty table stays empty.
    """
    small_batches(docs.sparkSession)
    langs, weights = model
    if weights is None:
        return docs.filter(F.col("text").rlike(r"\p{L}"))

    id_at, text_at = docs.columns.index("doc_id"), docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = _predict(langs, weights)
        for batch in batches:
            part = pa.RecordBatch.from_arrays([batch.column(id_at), pa.array([False] * batch.num_rows), batch.column(text_at)], names=["doc_id", "held_out", "text"])
            pred = next(predict(iter([part]))).column("lang_pred").to_pylist()
            yield batch.filter(pa.array([p != "und" for p in pred], pa.bool_()))

    # names may hold dots, which a plan would take for fields
    plain = docs.toDF(*(f"_{i}" for i in range(len(docs.columns))))
    return plain.mapInArrow(tidy(run), plain.schema).toDF(*docs.columns)
