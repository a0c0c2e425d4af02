"""Language identification by a bidirectional gated recurrent network over bytes.

A forward and a backward GRU read the UTF-8 bytes of a text; a softmax over both states labels every position, and
the document's probabilities are the mean of its positions'. The network is small (``hidden`` units a direction), so
numpy runs it over every byte of every text: texts are cut into windows of ``window`` bytes, each read from a zero
state in both directions, and thousands of windows advance together. It is trained in numpy by backpropagation
through time on a bounded sample of labelled texts.

Defined results: null text, or text without letters: ``und`` with score 0. Repeated rows give repeated results.
Extra columns are ignored. With no labelled row the model knows no language and every row is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Texts, leased, text_slices

UNKNOWN = "und"


@dataclass(frozen=True)
class LangIdConfig:
    hidden: int = 6
    window: int = 128
    lanes: int = 1024  #: windows that advance together
    sample_rows: int = 4000  #: bound of the labelled sample, in documents (least hash first)
    sample_windows: int = 3  #: windows taken of each sampled document
    train_window: int = 64
    batch: int = 256
    steps: int = 350
    rate: float = 0.02
    seed: int = 7


@dataclass
class LangModel:
    langs: list[str]
    #: per direction: table (256, 3H) = embedding times input weights plus bias; recurrent (3H, H); gates z, r, n
    tables: list[np.ndarray] = field(default_factory=list)
    recurrent: list[np.ndarray] = field(default_factory=list)
    out_w: np.ndarray | None = None
    out_b: np.ndarray | None = None


# ---------------------------------------------------------------- the network


def _softsign(x: np.ndarray, work: np.ndarray) -> None:
    np.abs(x, out=work)
    work += 1.0
    x /= work


def _run(table: np.ndarray, u: np.ndarray, codes: np.ndarray, keep: bool):
    """States (T, H, B) of one direction over codes (T, B); with ``keep`` also what the backward pass needs.

    Softsign s(x) = x / (1 + |x|) stands for tanh and (1 + s(x)) / 2 for the sigmoid: a fifth of their time.
    """
    t_len, b = codes.shape
    h_dim = u.shape[1]
    states = np.empty((t_len, h_dim, b), np.float32)
    h = np.zeros((h_dim, b), np.float32)
    uzr, un = u[: 2 * h_dim], u[2 * h_dim :]
    columns = np.ascontiguousarray(table.T)
    kept = []
    g = np.empty((3 * h_dim, b), np.float32)
    zr = np.empty((2 * h_dim, b), np.float32)
    wide = np.empty_like(zr)
    for t in range(t_len):
        np.take(columns, codes[t], axis=1, out=g, mode="clip")
        np.matmul(uzr, h, out=zr)
        zr += g[: 2 * h_dim]
        _softsign(zr, wide)
        zr += 1.0
        zr *= 0.5
        z, r = zr[:h_dim], zr[h_dim:]
        rh = r * h
        n = un @ rh
        n += g[2 * h_dim :]
        _softsign(n, wide[:h_dim])
        if keep:
            kept.append((h, z.copy(), r.copy(), rh, n))
        new = h - n
        new *= z
        new += n
        states[t] = new
        h = states[t] if not keep else new
    return states, kept


def _back(u: np.ndarray, kept, codes: np.ndarray, grad_states: np.ndarray):
    """Gradients of the table and the recurrent weights, through all time steps."""
    t_len, b = codes.shape
    h_dim = u.shape[1]
    d_table = np.zeros((256, 3 * h_dim), np.float32)
    d_u = np.zeros_like(u)
    d_h = np.zeros((h_dim, b), np.float32)
    uz, ur, un = u[:h_dim], u[h_dim : 2 * h_dim], u[2 * h_dim :]
    pre = np.empty((t_len, 3 * h_dim, b), np.float32)
    for t in range(t_len - 1, -1, -1):
        h, z, r, rh, n = kept[t]
        d_h = d_h + grad_states[t]
        d_n = d_h * (1 - z) * (1 - np.abs(n)) ** 2
        d_z = d_h * (h - n) * 0.5 * (1 - np.abs(2 * z - 1)) ** 2
        d_rh = un.T @ d_n
        d_r = d_rh * h * 0.5 * (1 - np.abs(2 * r - 1)) ** 2
        d_u[:h_dim] += d_z @ h.T
        d_u[h_dim : 2 * h_dim] += d_r @ h.T
        d_u[2 * h_dim :] += d_n @ rh.T
        pre[t, :h_dim], pre[t, h_dim : 2 * h_dim], pre[t, 2 * h_dim :] = d_z, d_r, d_n
        d_h = d_h * z + d_rh * r + uz.T @ d_z + ur.T @ d_r
    flat = codes.reshape(-1)
    rows = pre.transpose(0, 2, 1).reshape(-1, 3 * h_dim)
    for k in range(3 * h_dim):
        d_table[:, k] = np.bincount(flat, weights=rows[:, k], minlength=256)
    return d_table, d_u


def _softmax(x: np.ndarray, axis: int) -> np.ndarray:
    x = x - x.max(axis=axis, keepdims=True)
    np.exp(x, out=x)
    x /= x.sum(axis=axis, keepdims=True)
    return x


def train_network(codes: np.ndarray, labels: np.ndarray, langs: list[str], cfg: LangIdConfig) -> LangModel:
    """Backpropagation through time with Adam over windows ``codes`` (N, T) and their class ``labels`` (N)."""
    rng = np.random.default_rng(cfg.seed)
    h, k, n = cfg.hidden, len(langs), len(codes)
    p = {}
    for d in (0, 1):
        p[f"t{d}"] = rng.normal(0, 0.3, (256, 3 * h)).astype(np.float32)
        p[f"u{d}"] = rng.normal(0, 0.5 / np.sqrt(h), (3 * h, h)).astype(np.float32)
    p["w"] = rng.normal(0, 0.3, (k, 2 * h)).astype(np.float32)
    p["b"] = np.zeros(k, np.float32)
    m1 = {x: np.zeros_like(v) for x, v in p.items()}
    m2 = {x: np.zeros_like(v) for x, v in p.items()}
    for step in range(1, cfg.steps + 1):
        pick = rng.integers(0, n, min(cfg.batch, n))
        c = np.ascontiguousarray(codes[pick].T).astype(np.intp)
        y = labels[pick]
        t_len, b = c.shape
        f_states, f_kept = _run(p["t0"], p["u0"], c, True)
        back = c[::-1]
        b_states, b_kept = _run(p["t1"], p["u1"], back, True)
        both = np.concatenate([f_states, b_states[::-1]], axis=1)  # (T, 2H, B)
        prob = _softmax(np.matmul(p["w"], both) + p["b"][:, None], axis=1)
        prob[:, y, np.arange(b)] -= 1.0
        prob /= t_len * b
        grad = {"w": np.tensordot(prob, both, axes=([0, 2], [0, 2])), "b": prob.sum(axis=(0, 2))}
        d_both = np.matmul(p["w"].T, prob)
        grad["t0"], grad["u0"] = _back(p["u0"], f_kept, c, d_both[:, :h])
        grad["t1"], grad["u1"] = _back(p["u1"], b_kept, back, np.ascontiguousarray(d_both[::-1, h:]))
        norm = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
        clip = min(1.0, 1.0 / (norm + 1e-12))
        rate = cfg.rate * (0.5 * (1 + np.cos(np.pi * step / cfg.steps)) + 0.02)
        for x, g in grad.items():
            g = g * clip
            m1[x] = 0.9 * m1[x] + 0.1 * g
            m2[x] = 0.999 * m2[x] + 0.001 * g * g
            p[x] -= (rate * (m1[x] / (1 - 0.9**step)) / (np.sqrt(m2[x] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return LangModel(langs, [p["t0"], p["t1"]], [p["u0"], p["u1"]], p["w"], p["b"])


def position_sums(model: LangModel, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sum over each window's positions of the class probabilities, (K, B); codes (T, B), windows end at ``lengths``.

    Windows are read forward from their first byte and backward from their last, so shorter windows are stored
    right-aligned for the backward run.
    """
    t_len, b = codes.shape
    fwd, _ = _run(model.tables[0], model.recurrent[0], codes, False)
    at = lengths[None, :] - 1 - np.arange(t_len)[:, None]
    back = codes[np.maximum(at, 0), np.arange(b)[None, :]] if lengths.min() < t_len else codes[::-1]
    bwd, _ = _run(model.tables[1], model.recurrent[1], back, False)
    h = model.recurrent[0].shape[1]
    wf, wb = model.out_w[:, :h], model.out_w[:, h:]
    k = len(model.langs)
    total = np.zeros((k, b), np.float32)
    full = lengths.min() == t_len
    lanes = np.arange(b)
    for t in range(t_len):
        s = wf @ fwd[t]
        s += wb @ (bwd[t_len - 1 - t] if full else bwd[np.maximum(at[t], 0), :, lanes].T)
        s += model.out_b[:, None]
        np.exp(s, out=s)
        s /= s.sum(axis=0)
        total += s if full else s * (t < lengths)
    return total


def document_probabilities(model: LangModel, texts: Texts, cfg: LangIdConfig) -> np.ndarray:
    """(documents, K) mean position probabilities over every byte of each text; rows of zeros for empty texts."""
    size = np.diff(texts.offsets)
    n_win = -(-size // cfg.window)
    owner = np.repeat(np.arange(len(size)), n_win)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(n_win) - n_win, n_win)
    start = texts.offsets[:-1][owner] + nth * cfg.window
    length = np.minimum(texts.offsets[1:][owner] - start, cfg.window)
    sums = np.zeros((len(model.langs), len(size)))
    by_length = np.argsort(-length, kind="stable")
    padded = np.concatenate([texts.data, np.zeros(cfg.window, np.uint8)])
    n_full = int((length == cfg.window).sum())
    cuts = sorted({*range(0, n_full, cfg.lanes), n_full, *range(n_full, len(owner), cfg.lanes), len(owner)})
    for a, b in zip(cuts[:-1], cuts[1:]):
        rows = by_length[a:b]
        if not len(rows):
            continue
        t_len = int(length[rows[0]])
        codes = padded[start[rows][None, :] + np.arange(t_len)[:, None]].astype(np.intp)
        part = position_sums(model, codes, length[rows])
        for j in range(len(model.langs)):
            sums[j] += np.bincount(owner[rows], weights=part[j], minlength=len(size))
    return (sums / np.maximum(size, 1)).T


def has_letters(raw: bytes) -> bool:
    """Whether the text has a Unicode letter; ASCII letters are seen without decoding."""
    if any(65 <= c <= 90 or 97 <= c <= 122 for c in raw[:64]):
        return True
    return any(ch.isalpha() for ch in raw.decode("utf-8", "replace"))


# ---------------------------------------------------------------- Spark


def fit(docs: DataFrame, cfg: LangIdConfig = LangIdConfig()) -> LangModel | None:
    """Train on at most ``cfg.sample_rows`` of the given labelled rows (columns doc_id, text, lang).

    The sample is the rows with the least hash of (doc_id, text), repeated rows once: the same at every partitioning. Of each, up to
    ``sample_windows`` windows of bytes reach the driver, never whole texts.
    """
    spread, size, take = F.xxhash64("doc_id", "text"), cfg.train_window, cfg.sample_windows

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, rows = batch.column("lang").to_pylist(), batch.column("spread").to_pylist()
            out = []
            for texts in text_slices(batch.column("text")):
                for i in range(len(texts)):
                    raw, k = texts.raw(i), texts.lo + i
                    rng = np.random.default_rng(rows[k] & 0x7FFFFFFF)
                    for _ in range(take if len(raw) > size else min(1, len(raw))):
                        at = int(rng.integers(0, max(len(raw) - size, 0) + 1))
                        out.append((langs[k], raw[at : at + size].ljust(size, b" ")))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in out], pa.string()), pa.array([x for _, x in out], pa.binary())], ["lang", "bytes"]
            )

    labelled = docs.where("lang is not null and text is not null and text rlike '\\\\p{L}'").select("text", "lang", spread.alias("spread"))
    keys = labelled.select("spread").orderBy("spread").limit(cfg.sample_rows)
    bound = keys.agg(F.max("spread")).first()[0]
    if bound is None:
        return None
    rows = labelled.where(F.col("spread") <= bound).dropDuplicates(["spread"]).mapInArrow(leased("text", cut), "lang string, bytes binary").orderBy("lang", "bytes").collect()
    if not rows:
        return None
    langs = sorted({r.lang for r in rows})
    codes = np.frombuffer(b"".join(bytes(r.bytes) for r in rows), np.uint8).reshape(len(rows), size)
    return train_network(codes, np.array([langs.index(r.lang) for r in rows]), langs, cfg)


def predict(docs: DataFrame, model: LangModel | None, cfg: LangIdConfig = LangIdConfig()) -> DataFrame:
    """(doc_id, lang_pred, score, probabilities) of every row of (doc_id, text)."""

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            pred, score, probs = [UNKNOWN] * n, np.zeros(n), [[]] * n
            for texts in text_slices(batch.column("text")):
                if model is None:
                    continue
                p = document_probabilities(model, texts, cfg)
                best = p.argmax(axis=1)
                for i in range(len(texts)):
                    if len(raw := texts.raw(i)) and has_letters(raw):
                        k = texts.lo + i
                        pred[k], score[k] = model.langs[best[i]], min(1.0, float(p[i, best[i]]))
                        probs[k] = p[i].tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(pred, pa.string()), pa.array(score), pa.array(probs, pa.list_(pa.float64()))],
                ["doc_id", "lang_pred", "score", "probabilities"],
            )

    schema = "doc_id long, lang_pred string, score double, probabilities array<double>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(leased("text", label), schema)
