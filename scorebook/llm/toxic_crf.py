"""Toxic spans by a linear-chain conditional random field over words.

Training labels are per document, so token labels are derived first, from two kinds of evidence over all labelled
texts of the training sample: 4-byte grams (word edges marked) that occur in toxic documents and hardly in others, and
stems (word starts of 5 to 7 bytes) that a text repeats at a rate of one in ``sparse`` words or denser. A single
occurrence of a stem may be chance in a language that builds words freely; its repetition is the evidence there. What is
marked has a bound on chance, or is as far from it as the best there is, and marks as strongly as it can be trusted
(``_evidence``). A two-state chain (clean, toxic) is then fitted to these tokens by gradient
ascent on the conditional likelihood (forward-backward expectations): hashed word, gram and repeated-stem weights, a
bias and a 2 x 2 transition matrix. Scoring runs
forward-backward over all words of a text, in log-free scaled form: words are laid out in blocks, the blocks' transfer
matrices are chained, and every block then gets its incoming messages, so that all blocks of a slice advance together.
The document score is the largest marginal of its words, so that long texts do not add up small doubts; words with
marginal 0.5 or more are the offending spans, as byte offsets.

Defined results: null and empty texts score 0 and have no span. Null labels are not learned from. Without toxic (or
without clean) labelled rows nothing is tagged and every score is 0. Repeated rows and extra columns change nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Roller, Texts, leased, materialise, mix, text_slices, word_spans

BLOCK = 32
STEMS = (5, 6, 7)  # bytes of a word's start; at most 7, as a stem and its length share one 64-bit number
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_INSIDE = np.zeros(256, dtype=bool)
_INSIDE[list(range(97, 123)) + list(range(48, 58)) + list(range(128, 256))] = True


@dataclass(frozen=True)
class CrfConfig:
    sample_rows: int = 10_000  #: bound of the labelled sample, in documents of each class (least hash first)
    bits: int = 18  #: hashed features: 2^bits grams and 2^bits words
    min_share: float = 0.98  #: least share of toxic documents among those with a gram that marks toxic words
    stem_share: float = 0.8  #: the same for repeated stems, whose chance repetitions in clean texts are never quite none
    sparse: int = 128  #: a repeated stem starts at least one word in so many of its text
    false_grams: float = 0.05  #: grams (and as many stems) that may be marked by chance, over all of the sample
    train_tokens: int = 120_000  #: bound of the tokens the chain is fitted to, half of them at most in passages around tagged words
    steps: int = 60
    rate: float = 0.5


@dataclass
class CrfModel:
    gram: np.ndarray  #: 2^bits, weight of the toxic state
    word: np.ndarray
    stem: np.ndarray
    bias: float
    transition: np.ndarray  #: log potentials, from row to column; 0 clean, 1 toxic


# ---------------------------------------------------------------- features


class Features:
    """Words of a slice of texts and, for each, the hashed bucket of the word, of its 4-byte grams and of its stems.

    ``repeats`` has a bit per word and stem length: whether the text repeats the stem. It is counted over the whole
    texts unless given, as for passages that were cut from longer ones.
    """

    def __init__(self, texts: Texts, roller: Roller, cfg: CrfConfig, repeats: np.ndarray | None = None):
        bits = cfg.bits
        low = _LOWER[texts.data]
        inside = _INSIDE[low]
        self.starts, self.ends, self.first = word_spans(low, texts.offsets, inside)
        self.n_docs = len(texts)
        self.owner = np.repeat(np.arange(self.n_docs), np.diff(self.first))
        shift = np.uint64(64 - bits)
        self.word = (roller.spans(low, self.starts, self.ends) >> shift).astype(np.int64)
        # Each word is written as <space> word <space>: grams 0 .. len - 2 of 4 bytes, one at least.
        length = self.ends - self.starts
        count = np.maximum(length - 1, 1)
        self.gram_word = np.repeat(np.arange(len(length)), count)
        nth = np.arange(len(self.gram_word)) - np.repeat(np.cumsum(count) - count, count)
        at = self.starts[self.gram_word] + nth - 1  # byte place of the gram's first sign; -1 from the start is the edge
        code = np.zeros(len(at), np.uint64)
        s, e = self.starts[self.gram_word], self.ends[self.gram_word]
        for j in range(4):
            place = at + j
            sign = np.where((place >= s) & (place < e), low[np.clip(place, 0, max(len(low) - 1, 0))] if len(low) else 0, 32)
            code = (code << np.uint64(8)) | sign.astype(np.uint64)
        self.gram = (mix(code + np.uint64(1)) >> shift).astype(np.int64)
        self._stems(low, shift, cfg.sparse, repeats)

    def _stems(self, low: np.ndarray, shift: np.uint64, sparse: int, repeats: np.ndarray | None) -> None:
        length = self.ends - self.starts
        code, words, keys, kinds = np.zeros(len(length), np.uint64), [], [], []
        for j in range(max(STEMS)):
            sign = low[np.minimum(self.starts + j, len(low) - 1)] if len(low) else low
            code = (code << np.uint64(8)) | sign.astype(np.uint64)
            if j + 1 in STEMS:
                has = np.flatnonzero(length > j)
                words.append(has)
                keys.append(mix((code[has] << np.uint64(3)) | np.uint64(j + 1)))
                kinds.append(np.full(len(has), STEMS.index(j + 1), np.uint8))
        word, key, kind = np.concatenate(words), np.concatenate(keys), np.concatenate(kinds)
        if repeats is None:
            doc = self.owner[word]
            _, same, count = np.unique(mix(key ^ mix(doc.astype(np.uint64) + np.uint64(1))), return_inverse=True, return_counts=True)
            count = count[same]
            often = (count > 1) & (count * sparse >= np.diff(self.first)[doc])
            bits_of = np.bincount(word[often], weights=(1 << kind[often].astype(np.int64)), minlength=len(length))
            self.repeats = bits_of.astype(np.uint8)
        else:
            self.repeats = repeats
            often = (repeats[word] >> kind) & 1 == 1
        bucket = (key >> shift).astype(np.int64)
        self.stem_word, self.stem = word[often], bucket[often]
        self.lone_word, self.lone = word[~often], bucket[~often]


def _counts(f: Features, labels: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Documents with each gram and, after all grams, with each repeated stem: among toxic and among clean ones."""
    size = 2 << bits
    doc = np.concatenate([f.owner[f.gram_word], f.owner[f.stem_word]])
    pair = np.unique(doc * size + np.concatenate([f.gram, f.stem + (1 << bits)]))
    d, g = pair // size, pair % size
    toxic = labels[d] == 1
    return np.bincount(g[toxic], minlength=size), np.bincount(g[~toxic], minlength=size)


def _evidence(
    pos: np.ndarray, neg: np.ndarray, toxic: int, clean: int, stands: tuple[float, float], min_share: float, false: float
) -> tuple[np.ndarray, np.ndarray]:
    """(share, trust) of features with ``pos`` toxic and ``neg`` clean documents of the sample; trust is 0 below the least share.

    The classes are sampled apart: a toxic document of the sample stands for ``stands[0]`` labelled ones, a clean one for
    ``stands[1]``. Shares are those of all labelled documents; chance is that of the sample, in which features are drawn.
    A feature that has nothing to do with the label has chance at most exp(-n KL) of so large a toxic share in its n
    documents (Chernoff). Tries are the features in as many documents or more, those included that are in enough
    documents for at most ``false`` chance ones of their size or more (Tarone). Trust is one over one plus the number of
    chance features as good.
    """
    if not len(pos):
        return np.zeros(0), np.zeros(0)
    n, base = pos + neg, toxic / (toxic + clean)
    s = pos / n
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = np.where(s > 0, s * np.log(s / base), 0.0) + np.where(s < 1, (1 - s) * np.log((1 - s) / (1 - base)), 0.0)
    chance = np.where(s > base, -n * kl, 0.0)
    share = pos * stands[0] / (pos * stands[0] + neg * stands[1])
    sizes = np.unique(n)
    tries = len(n) - np.searchsorted(np.sort(n), sizes)
    able = np.flatnonzero(np.log(tries) + sizes * np.log(base) <= np.log(false))
    tried = np.maximum(tries, tries[able[0]] if len(able) else 0)[np.searchsorted(sizes, n)]
    return share, np.where(share >= min_share, 1.0 / (1.0 + tried * np.exp(chance)), 0.0)


# ---------------------------------------------------------------- the chain


def _layout(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(slot, block offsets per text): word i of the slice sits at flat place slot[i] of (blocks, BLOCK)."""
    n = np.diff(first)
    blocks = -(-n // BLOCK)
    at = np.concatenate([[0], np.cumsum(blocks)])
    nth = np.arange(first[-1]) - np.repeat(first[:-1], n)
    return np.repeat(at[:-1] * BLOCK, n) + nth, at


def forward_backward(emission: np.ndarray, transition: np.ndarray, first: np.ndarray):
    """Marginals of the toxic state, expected transitions (2 x 2) and log partition of all texts' chains.

    ``emission`` is the log potential of the toxic state per word (clean is 0). Messages are scaled to sum 1.
    """
    n_words = len(emission)
    if not n_words:
        return np.zeros(0), np.zeros((2, 2)), 0.0
    slot, at = _layout(first)
    n_blocks = int(at[-1])
    emit = np.zeros(n_blocks * BLOCK)
    used = np.zeros(n_blocks * BLOCK, dtype=bool)
    emit[slot], used[slot] = emission, True
    emit, used = emit.reshape(n_blocks, BLOCK).T.copy(), used.reshape(n_blocks, BLOCK).T.copy()
    top = np.maximum(emit, 0.0)
    e0, e1 = np.exp(-top), np.exp(emit - top)
    e0[~used] = e1[~used] = 1.0
    a = np.exp(transition)
    # A text's first word takes no transition: its incoming message is a uniform one through the identity.
    opens = np.zeros(n_blocks, dtype=bool)
    opens[at[:-1][np.diff(at) > 0]] = True

    # 1. transfer matrix of each block, rows: incoming state
    m = np.zeros((4, n_blocks))
    m[0] = m[3] = 1.0
    for t in range(BLOCK):
        step = used[t] & ~(opens & (t == 0))
        n0, n1 = m[0] * a[0, 0] + m[1] * a[1, 0], m[0] * a[0, 1] + m[1] * a[1, 1]
        n2, n3 = m[2] * a[0, 0] + m[3] * a[1, 0], m[2] * a[0, 1] + m[3] * a[1, 1]
        m = np.where(step, np.stack([n0, n1, n2, n3]), m)
        m = m * np.stack([e0[t], e1[t], e0[t], e1[t]])
        m /= m.sum(axis=0)
    # 2. chain the blocks of each text, all texts together, one block a step
    n_of = np.diff(at)
    alpha_in = np.full((2, n_blocks), 0.5)
    beta_out = np.full((2, n_blocks), 0.5)
    order = np.argsort(-n_of, kind="stable")
    longest = int(n_of.max())
    live = np.searchsorted(-n_of[order], -np.arange(1, longest), side="left")
    for k in range(1, longest):  # texts with more than k blocks
        b = at[:-1][order[: live[k - 1]]] + k
        x0, x1 = alpha_in[:, b - 1]
        y0, y1 = x0 * m[0, b - 1] + x1 * m[2, b - 1], x0 * m[1, b - 1] + x1 * m[3, b - 1]
        s = y0 + y1
        alpha_in[0, b], alpha_in[1, b] = y0 / s, y1 / s
    for k in range(longest - 1, 0, -1):
        b = at[:-1][order[: live[k - 1]]] + k
        x0, x1 = beta_out[:, b]
        y0, y1 = m[0, b] * x0 + m[1, b] * x1, m[2, b] * x0 + m[3, b] * x1
        s = y0 + y1
        beta_out[0, b - 1], beta_out[1, b - 1] = y0 / s, y1 / s
    # 3. messages inside each block
    f0, f1 = np.empty((BLOCK, n_blocks)), np.empty((BLOCK, n_blocks))
    x0, x1 = alpha_in
    log_z = 0.0
    for t in range(BLOCK):
        step = used[t] & ~(opens & (t == 0))
        y0 = np.where(step, x0 * a[0, 0] + x1 * a[1, 0], np.where(used[t], 1.0, x0)) * e0[t]
        y1 = np.where(step, x0 * a[0, 1] + x1 * a[1, 1], np.where(used[t], 1.0, x1)) * e1[t]
        s = y0 + y1
        log_z += float((np.log(s) + top[t])[used[t]].sum())
        x0, x1 = y0 / s, y1 / s
        f0[t], f1[t] = x0, x1
    marginal = np.empty((BLOCK, n_blocks))
    expected = np.zeros((2, 2))
    x0, x1 = beta_out
    for t in range(BLOCK - 1, -1, -1):
        p0, p1 = f0[t] * x0, f1[t] * x1
        marginal[t] = p1 / (p0 + p1)
        b0, b1 = e0[t] * x0, e1[t] * x1  # before the transition into t
        step = used[t] & ~(opens & (t == 0))
        q0, q1 = (f0[t - 1], f1[t - 1]) if t else alpha_in
        pair = [q0 * a[0, 0] * b0, q0 * a[0, 1] * b1, q1 * a[1, 0] * b0, q1 * a[1, 1] * b1]
        total = sum(pair)
        expected += np.array([(p / total)[step].sum() for p in pair]).reshape(2, 2)
        n0, n1 = a[0, 0] * b0 + a[0, 1] * b1, a[1, 0] * b0 + a[1, 1] * b1
        s = n0 + n1
        x0, x1 = np.where(step, n0 / s, x0), np.where(step, n1 / s, x1)
    return marginal.T.reshape(-1)[slot], expected, log_z


def emissions(model: CrfModel, f: Features) -> np.ndarray:
    total = np.bincount(f.gram_word, weights=model.gram[f.gram], minlength=len(f.word))
    total += np.bincount(f.stem_word, weights=model.stem[f.stem], minlength=len(f.word))
    return total + model.word[f.word] + model.bias


def train_chain(f: Features, tags: np.ndarray, cfg: CrfConfig) -> CrfModel:
    """Gradient ascent (AdaGrad) on the conditional log-likelihood of the token tags (0 to 1)."""
    size = 1 << cfg.bits
    model = CrfModel(np.zeros(size), np.zeros(size), np.zeros(size), -2.0, np.zeros((2, 2)))
    inner = np.ones(len(tags), dtype=bool)
    inner[f.first[:-1][np.diff(f.first) > 0]] = False
    at = np.flatnonzero(inner)
    before, after = (np.stack([1.0 - tags[i], tags[i]]) for i in (at - 1, at))
    seen = before @ after.T
    n = max(len(tags), 1)
    squares = [np.full(size, 1e-6), np.full(size, 1e-6), np.full(size, 1e-6), 1e-6, np.full((2, 2), 1e-6)]
    for _ in range(cfg.steps):
        p, expected, _ = forward_backward(emissions(model, f), model.transition, f.first)
        miss = (tags - p) / n
        grads = [
            np.bincount(f.gram, weights=miss[f.gram_word], minlength=size) - 1e-7 * model.gram,
            np.bincount(f.word, weights=miss, minlength=size) - 1e-7 * model.word,
            np.bincount(f.stem, weights=miss[f.stem_word], minlength=size) - 1e-7 * model.stem,
            float(miss.sum()),
            (seen - expected) / n,
        ]
        for i, g in enumerate(grads):
            squares[i] = squares[i] + g * g
            move = cfg.rate * g / np.sqrt(squares[i])
            if i == 0:
                model.gram += np.where(np.abs(g) > 1e-9, move, 0)
            elif i == 1:
                model.word += np.where(np.abs(g) > 1e-9, move, 0)
            elif i == 2:
                model.stem += np.where(np.abs(g) > 1e-9, move, 0)
            elif i == 3:
                model.bias += float(move)
            else:
                model.transition = model.transition + np.clip(move, -0.5, 0.5)
    return model


def score_texts(model: CrfModel, texts: Texts, roller: Roller, cfg: CrfConfig):
    """Per text: score and (starts, lengths, marginals) of its offending words."""
    f = Features(texts, roller, cfg)
    p, _, _ = forward_backward(emissions(model, f), model.transition, f.first)
    top = np.zeros(len(texts))
    has = np.flatnonzero(np.diff(f.first))
    if len(has):
        top[has] = np.maximum.reduceat(p, f.first[:-1][has])
    bad = np.flatnonzero(p >= 0.5)
    doc = f.owner[bad]
    return top, doc, f.starts[bad] - texts.offsets[doc], (f.ends - f.starts)[bad], p[bad]


# ---------------------------------------------------------------- Spark


def labelled_sample(docs: DataFrame, labels: DataFrame, cfg: CrfConfig) -> DataFrame:
    """(doc_id, text, label) of at most ``sample_rows`` labelled documents a class, least id hash first.

    The ids are chosen from the labels alone; the chosen table has a proven bound (2 x sample_rows rows of two
    numbers), so it is broadcast and no text is shuffled.
    """
    spread = F.xxhash64("doc_id")
    parts = [
        labels.where(F.col("label") == c).select(F.col("doc_id").cast("long").alias("doc_id"), "label").distinct()
        .orderBy(spread, "doc_id").limit(cfg.sample_rows)
        for c in (0, 1)
    ]
    chosen = parts[0].unionByName(parts[1])
    texts = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # Exact copies would count a rare gram many times over.
    return texts.join(F.broadcast(chosen), "doc_id").groupBy(F.xxhash64("text").alias("h"), "label").agg(
        F.min_by("text", "doc_id").alias("text"), F.min("doc_id").alias("doc_id")
    ).select("doc_id", "text", "label")


def label_weights(labels: DataFrame, cfg: CrfConfig) -> dict[int, float]:
    """How many labelled documents each sampled one of a class stands for."""
    ids = labels.where("doc_id is not null and label in (0, 1)").select("label", "doc_id").distinct()
    counts = {r["label"]: r["count"] for r in ids.groupBy("label").count().collect()}
    return {c: max(counts.get(c, 0) / cfg.sample_rows, 1.0) for c in (0, 1)}


def fit(docs: DataFrame, labels: DataFrame, cfg: CrfConfig = CrfConfig()) -> CrfModel | None:
    """Learn from (doc_id, text) and (doc_id, label); see the module text for how words get their tags."""
    size = 1 << cfg.bits

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller(23)
        pos, neg = np.zeros(2 * size, np.int64), np.zeros(2 * size, np.int64)
        for batch in batches:
            lab = batch.column("label").to_numpy(zero_copy_only=False)
            for t in text_slices(batch.column("text")):
                a, b = _counts(Features(t, roller, cfg), lab[t.lo : t.lo + len(t)], cfg.bits)
                pos += a
                neg += b
        hit = np.flatnonzero(pos + neg)
        yield pa.RecordBatch.from_arrays([pa.array(hit), pa.array(pos[hit]), pa.array(neg[hit])], ["feature", "pos", "neg"])

    sample = labelled_sample(docs, labels, cfg)
    found = (
        sample.mapInArrow(leased("text", count), "feature long, pos long, neg long").groupBy("feature")
        .agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).toArrow()  # at most 2 x 2^bits rows
    )
    share = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    stands = label_weights(labels, cfg)
    if not found.num_rows or not share.get(1) or not share.get(0):
        return None
    feature, pos, neg = (found.column(c).to_numpy() for c in ("feature", "pos", "neg"))
    shares, trust = np.zeros(len(feature)), np.zeros(len(feature))
    for kind, least in ((feature < size, cfg.min_share), (feature >= size, cfg.stem_share)):
        shares[kind], trust[kind] = _evidence(pos[kind], neg[kind], share[1], share[0], (stands[1], stands[0]), least, cfg.false_grams)
    # One rule at every size: what is trusted about as much as the best feature tags, as strongly as it is trusted.
    marks = np.zeros(2 * size)
    marks[feature] = np.where(trust >= trust.max() / (1.0 + cfg.false_grams), shares * trust, 0.0)
    if not marks.any():
        return None
    texts, repeats = training_passages(sample, marks, cfg)
    data = np.frombuffer(b"".join(texts), np.uint8)
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    given = np.frombuffer(b"".join(repeats), np.uint8)
    f = Features(Texts(data, off, 0, np.ones(len(texts), bool)), Roller(23), cfg, given)
    return train_chain(f, tag_words(f, marks), cfg)


def training_passages(sample: DataFrame, marks: np.ndarray, cfg: CrfConfig) -> tuple[list[bytes], list[bytes]]:
    """The chain's training sequences and their words' repeat flags: half the tokens at most around tagged words, as many clean.

    Half of the clean ones may be around lone stems, or more where there are too few others.
    """
    schema = "kind int, spread long, passage binary, repeats binary"
    seq = materialise(sample.sparkSession, sample.mapInArrow(leased("text", _sequences(marks, cfg)), schema), "toxic-passages")
    bound = cfg.train_tokens // 24
    kinds = [seq.where(F.col("kind") == k).orderBy("spread", "passage").limit(bound).collect() for k in range(3)]
    plain, lone, tagged = kinds
    tagged = tagged[: max(bound // 2, 1)]
    rest = max(bound // 2, 1)
    lone = lone[: max(rest // 2, rest - len(plain))]
    texts, repeats = [], []
    for r in (*tagged, *lone, *plain[: rest - len(lone)]):
        texts.append(bytes(r.passage))
        repeats.append(bytes(r.repeats))
    return texts, repeats


def tag_words(f: Features, marks: np.ndarray) -> np.ndarray:
    """For each word the largest mark (0 to 1) of its grams and repeated stems."""
    tags, size = np.zeros(len(f.word)), len(marks) // 2
    for word, mark in ((f.gram_word, marks[f.gram]), (f.stem_word, marks[size + f.stem])):
        at = np.flatnonzero(mark)
        np.maximum.at(tags, word[at], mark[at])
    return tags


def _sequences(marks: np.ndarray, cfg: CrfConfig, reach: int = 12):
    """Cuts a passage of 2 x reach words of each text: around a tagged word, else around one with a marked stem that the
    text does not repeat (the chain must tell the two apart), else at a hashed place."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller, stems = Roller(23), marks[len(marks) // 2 :]
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            kinds, keys, out, flags = [], [], [], []
            for t in text_slices(batch.column("text")):
                f = Features(t, roller, cfg)
                tagged = np.flatnonzero(tag_words(f, marks))
                lone = np.unique(f.lone_word[stems[f.lone] > 0])
                spread = mix(ids[t.lo : t.lo + len(t)].astype(np.uint64))
                for i in range(len(t)):
                    a, b = int(f.first[i]), int(f.first[i + 1])
                    if a == b:
                        continue
                    mid, kind = a + int(spread[i]) % (b - a), 0
                    for code, places in ((2, tagged), (1, lone)):
                        hits = places[np.searchsorted(places, a) : np.searchsorted(places, b)]
                        if len(hits):
                            mid, kind = int(hits[int(spread[i]) % len(hits)]), code
                            break
                    lo, hi = max(a, mid - reach), min(b, mid + reach)
                    out.append(t.data[f.starts[lo] : f.ends[hi - 1]].tobytes())
                    kinds.append(kind)
                    flags.append(f.repeats[lo:hi].tobytes())
                    keys.append(int(spread[i] >> np.uint64(1)))
            arrays = [pa.array(kinds, pa.int32()), pa.array(keys, pa.int64()), pa.array(out, pa.binary()), pa.array(flags, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["kind", "spread", "passage", "repeats"])

    return cut


def score(docs: DataFrame, model: CrfModel | None, cfg: CrfConfig = CrfConfig(), spans: bool = True) -> DataFrame:
    """(doc_id, score, spans array<struct<start, length, marginal>>) of every row; spans are byte offsets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller(23)
        for batch in batches:
            n = batch.num_rows
            total, rows, parts = np.zeros(n), np.zeros(n, np.int64), []
            for t in text_slices(batch.column("text"), 1 << 19):
                if model is None:
                    continue
                s, doc, start, length, p = score_texts(model, t, roller, cfg)
                total[t.lo : t.lo + len(t)] = s
                if spans:
                    rows[t.lo : t.lo + len(t)] = np.bincount(doc, minlength=len(t))
                    parts.append((start, length, p))
            columns = [batch.column("doc_id"), pa.array(np.clip(total, 0.0, 1.0))]
            cat = [np.concatenate([x[j] for x in parts]) if parts else np.zeros(0, np.float64 if j == 2 else np.int64) for j in range(3)]
            items = pa.StructArray.from_arrays([pa.array(cat[0]), pa.array(cat[1]), pa.array(cat[2])], ["start", "length", "marginal"])
            ends = np.concatenate([[0], np.cumsum(rows)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*columns, pa.ListArray.from_arrays(pa.array(ends), items)], ["doc_id", "score", "spans"])

    schema = "doc_id long, score double, spans array<struct<start:long,length:long,marginal:double>>"
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(leased("text", run), schema)


def filtered(docs: DataFrame, model: CrfModel | None, cfg: CrfConfig, threshold: float) -> DataFrame:
    """The rows of ``docs``, all columns, whose text scores below the threshold; a single pass without a join."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        roller = Roller(23)
        for batch in batches:
            if not batch.num_rows:
                yield batch
            for t in text_slices(batch.column("text"), 1 << 19):  # rows leave slice by slice, so no second batch builds up
                total = score_texts(model, t, roller, cfg)[0] if model is not None else np.zeros(len(t))
                yield batch.slice(t.lo, len(t)).filter(pa.array(total < threshold))

    return docs.mapInArrow(leased("text", run), docs.schema)
