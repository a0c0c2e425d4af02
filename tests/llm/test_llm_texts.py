"""Operators on documents against brute force, with nulls, empty and long texts, ties, repeats and clashing names."""

import functools
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from scorebook.llm import common, decontaminate, langid, packing, probminhash, quality_qda, substr_dedup, toxic_crf

SCHEMA = "doc_id long, text string, anchors string, ranges string, n_chars long"


def frame(spark, rows):
    """Documents with extra columns whose names clash with internal ones."""
    return spark.createDataFrame([(i, t, "x", "y", len(t or "")) for i, t in rows], SCHEMA)


def words(n, seed, vocabulary=400):
    rng = random.Random(seed)
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


# ---------------------------------------------------------------- shared helpers


def test_word_spans_and_hashes_match_python():
    texts = ["", "a", " b  c\n", "é x y", "z" * 30, "\t", "k l m n"]
    got = []
    roller = common.Roller(1)
    for t in common.text_slices(pa.array(texts), 8):
        s, e, first = common.space_words(t)
        h = roller.spans(t.data, s, e)
        for i in range(len(t)):
            got.append([(t.data[a:b].tobytes(), int(x)) for a, b, x in zip(s[first[i]:first[i + 1]], e[first[i]:first[i + 1]], h[first[i]:first[i + 1]])])
    assert [[w for w, _ in g] for g in got] == [t.encode().split() for t in texts]
    seen = {}
    for w, h in (x for g in got for x in g):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_rollers_do_not_depend_on_place(monkeypatch):
    monkeypatch.setattr(common, "CHUNK_BYTES", 64)
    roller = common.Roller(5)
    data = np.frombuffer((b"alpha beta " * 40), np.uint8)
    starts = np.arange(0, 440, 11)
    h = roller.spans(data, starts, starts + 5)
    assert len(set(h.tolist())) == 1
    values = np.tile(np.arange(7, dtype=np.uint64), 60)
    w = roller.windows(values, 14)
    assert all(len(set(w[k::7].tolist())) == 1 for k in range(7)) and len(set(w[:7].tolist())) == 7


def test_null_strings_and_offsets():
    column = pa.array(["drop", None, "ab", "", "c"]).slice(1)
    data, offsets, valid = common.text_buffers(column)
    assert [data[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:])] == [b"", b"ab", b"", b"c"]
    assert valid.tolist() == [False, True, True, True]


# ---------------------------------------------------------------- language id


def test_gradients_match_finite_differences():
    rng = np.random.default_rng(0)
    table, u = rng.normal(0, 0.5, (256, 9)).astype(np.float32), rng.normal(0, 0.5, (9, 3)).astype(np.float32)
    codes = rng.integers(0, 4, (5, 6))
    goal = rng.normal(size=(5, 3, 6)).astype(np.float32)

    def loss(tb, uu):
        states, _ = langid._run(tb.astype(np.float32), uu.astype(np.float32), codes, True)
        return float((states * goal).sum())

    _, kept = langid._run(table, u, codes, True)
    d_table, d_u = langid._back(u, kept, codes, goal)
    for grad, at, which in [(d_table, (1, 4), 0), (d_table, (2, 7), 0), (d_u, (0, 1), 1), (d_u, (4, 2), 1), (d_u, (8, 0), 1)]:
        e = 1e-2
        hi, lo = [table.copy(), u.copy()], [table.copy(), u.copy()]
        hi[which][at] += e
        lo[which][at] -= e
        assert grad[at] == pytest.approx((loss(*hi) - loss(*lo)) / (2 * e), abs=2e-2)


def test_language_id_learns_and_handles_odd_rows(spark):
    rng = random.Random(3)
    make = {"aa": lambda: "".join(rng.choice("abcde ") for _ in range(200)), "zz": lambda: "".join(rng.choice("vwxyz ") for _ in range(200))}
    rows = [(i, make[lang](), lang) for i, lang in enumerate(["aa", "zz"] * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    cfg = langid.LangIdConfig(steps=60, sample_rows=100)
    model = langid.fit(docs.where("doc_id < 90"), cfg)
    odd = spark.createDataFrame([(1000, None, None), (1001, "", "aa"), (1002, "123 !", "aa"), (1003, "bad " * 5000, None), (1003, "bad " * 5000, None), (None, "xyz", "aa")], docs.schema)
    got = langid.predict(docs.unionByName(odd), model, cfg).collect()
    assert len(got) == 126 and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r for r in got}
    assert sum(by[i].lang_pred == lang for i, _, lang in rows) >= 118
    assert [by[i].lang_pred for i in (1000, 1001, 1002, 1003)] == ["und", "und", "und", "aa"]
    assert langid.fit(docs.where("false")) is None
    assert {r.lang_pred for r in langid.predict(docs, None).collect()} == {"und"}
    assert langid.predict(docs.where("false"), model, cfg).collect() == []


def test_windows_label_every_byte():
    cfg = langid.LangIdConfig(window=16, lanes=3, hidden=2)
    rng = np.random.default_rng(1)
    p = [rng.normal(size=s).astype(np.float32) for s in ((256, 6), (256, 6), (6, 2), (6, 2), (2, 4), (2,))]
    model = langid.LangModel(["a", "b"], p[:2], p[2:4], p[4], p[5])
    raw = [b"x" * 37, b"", b"hello world, this is it", b"y"]
    t = common.Texts(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0, *map(len, raw)]), 0, np.ones(4, bool))
    got = langid.document_probabilities(model, t, cfg)
    for i, r in enumerate(raw):
        total = np.zeros(2)
        for a in range(0, len(r), 16):
            c = np.frombuffer(r[a:a + 16], np.uint8).astype(np.intp)[:, None]
            f, _ = langid._run(model.tables[0], model.recurrent[0], c, False)
            b, _ = langid._run(model.tables[1], model.recurrent[1], c[::-1], False)
            s = np.concatenate([f, b[::-1]], axis=1)[:, :, 0] @ model.out_w.T + model.out_b
            total += (np.exp(s) / np.exp(s).sum(axis=1, keepdims=True)).sum(axis=0)
        assert got[i] == pytest.approx(total / max(len(r), 1), abs=1e-5)


def plain_gru(table, u, raw):
    """States after each byte, one number at a time."""
    def soft(x):
        return x / (1 + abs(x))

    size = u.shape[1]
    h, out = [0.0] * size, []
    for c in raw:
        g = [float(x) for x in table[c]]
        dot = [sum(float(u[k, j]) * h[j] for j in range(size)) for k in range(2 * size)]
        z = [(1 + soft(dot[k] + g[k])) / 2 for k in range(size)]
        r = [(1 + soft(dot[size + k] + g[size + k])) / 2 for k in range(size)]
        n = [soft(sum(float(u[2 * size + k, j]) * r[j] * h[j] for j in range(size)) + g[2 * size + k]) for k in range(size)]
        h = [z[k] * h[k] + (1 - z[k]) * n[k] for k in range(size)]
        out.append(h)
    return out


def test_language_id_matches_plain_network(spark):
    rng = random.Random(8)
    make = {"aa": "abcdé ", "bb": "bcdxy ", "cc": "xyzß  "}
    rows = [(i, "".join(rng.choice(make[lang]) for _ in range(rng.randint(1, 190))), lang) for i, lang in enumerate(list(make) * 14)]
    rows += [(100, None, "aa"), (101, "", "aa"), (102, "7 7", None), (None, "dab", None), (0, rows[0][1], "aa")]
    docs = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, lang string, score string")
    cfg = langid.LangIdConfig(hidden=3, window=24, steps=25, sample_rows=30, lanes=7)
    model = langid.fit(docs, cfg)
    got = Counter((r.doc_id, r.lang_pred, round(r.score, 4)) for r in langid.predict(docs, model, cfg).collect())
    want = []
    for i, text, _ in rows:
        raw, total = (text or "").encode(), [0.0] * len(model.langs)
        for a in range(0, len(raw), cfg.window):
            part = raw[a:a + cfg.window]
            f, b = plain_gru(model.tables[0], model.recurrent[0], part), plain_gru(model.tables[1], model.recurrent[1], part[::-1])[::-1]
            for state in (x + y for x, y in zip(f, b)):
                e = [math.exp(sum(float(w) * v for w, v in zip(row, state)) + float(bias)) for row, bias in zip(model.out_w, model.out_b)]
                total = [t + x / sum(e) for t, x in zip(total, e)]
        best = max(range(len(total)), key=total.__getitem__)
        known = any(c.isalpha() for c in text or "")
        want.append((i, model.langs[best] if known else "und", round(total[best] / len(raw), 4) if known else 0.0))
    assert same_rows(got, want)


def same_rows(got, want, near=2e-4):
    """Whether rows (id, value, score) agree, scores up to rounding."""
    a, b = (sorted(x, key=lambda r: (r[0] is None, r[0] or 0)) for x in (got.elements(), want))
    return [r[:2] for r in a] == [r[:2] for r in b] and all(abs(x[2] - y[2]) <= near for x, y in zip(a, b))


# ---------------------------------------------------------------- quality


def plain_statistics(text):
    raw = (text or "").encode()
    w = re.findall(rb"[^\x20\x09-\x0d]+", raw)
    lines = [x for x in raw.split(b"\n") if x]
    one, w1 = max(len(raw), 1), max(len(w), 1)

    def share(x, of):
        return math.log(x / of + 0.002)

    upper, letters = sum(65 <= c <= 90 for c in raw), sum(65 <= c <= 90 or 97 <= c <= 122 for c in raw)
    return [
        math.log1p(len(raw)), math.log1p(len(w)), math.log1p(sum(map(len, w)) / w1), share(sum(len(x) > 14 for x in w), w1),
        share(upper, max(letters, 1)), share(sum(48 <= c <= 57 for c in raw), one), share(sum(c in b"#$%&*!|@^~=+<>\\/_{}[]" for c in raw), one),
        share(w.count(b"|"), w1), share(sum(x[-1] in b"#$%&*!|@^~=+<>" for x in w), w1), share(raw.count(b"\n"), one), len(set(w)) / w1,
        share(sum(a == b for a, b in zip(w, w[1:])), w1), share(sum((n - 1) * len(x) for x, n in Counter(lines).items()), one),
        share(sum(c >= 128 for c in raw), one), share(max(raw.count(c.encode()) for c in "#$%&*!|"), one),
    ]


def test_quality_matches_plain_discriminant(spark):
    rng = random.Random(12)
    texts = ["\n".join(" ".join(rng.choice(["w", "Way", "Öl", "12", "|", "end!", "a" * 20, "x*y"][: 4 + 4 * (i % 2)]) for _ in range(rng.randint(1, 30)))
                       for _ in range(rng.randint(1, 5))) for i in range(60)] + [None, "", "\n\n", "same\nsame\n\nsame"]
    docs = frame(spark, list(enumerate(texts)) + [(3, texts[3])])
    labels = {i: i % 2 for i in range(50)}
    stats = quality_qda.statistics(docs)
    table = spark.createDataFrame([*labels.items(), (55, None), (56, 3)], "doc_id long, label int")
    cfg = quality_qda.QdaConfig()
    got = {r.doc_id: r.score for r in quality_qda.score(stats, quality_qda.fit(stats.join(table, "doc_id"), cfg), cfg).collect()}
    x = np.array([plain_statistics(t) for t in texts])
    rows = {c: x[[i for i in labels if labels[i] == c] + ([3] if c == 1 else [])] for c in (0, 1)}  # row 3 is there twice
    total = sum(map(len, rows.values()))
    pooled = sum(len(r) * r.var(axis=0) for r in rows.values()) / total
    density = {}
    for c, r in rows.items():
        cov = (1 - cfg.shrinkage) * np.cov(r.T, bias=True) + cfg.shrinkage * np.diag(pooled) + cfg.floor * np.eye(x.shape[1])
        away, inverse = x - r.mean(axis=0), np.linalg.inv(cov)
        density[c] = math.log(len(r) / total) - 0.5 * (np.linalg.slogdet(cov)[1] + np.array([v @ inverse @ v for v in away]))
    want = 1 / (1 + np.exp(-np.clip(cfg.temper * (density[1] - density[0]), -700, 700)))
    assert sorted(got) == list(range(len(texts))) and [got[i] for i in range(len(texts))] == pytest.approx(want.tolist(), abs=1e-6)


def test_quality_separates_and_scores_every_row(spark):
    good = [(i, " ".join(words(120, i)) + ".\n" + " ".join(words(60, i + 500))) for i in range(80)]
    bad = [(1000 + i, " ".join(w + "***" for w in words(100, i))) for i in range(30)] + [(2000 + i, "spam spam " * 80) for i in range(30)]
    docs = frame(spark, good + bad + [(3000, None), (3001, ""), (3002, "x" * 200_000), (0, good[0][1])])
    labels = spark.createDataFrame([(i, 1) for i, _ in good] + [(i, 0) for i, _ in bad] + [(3000, None), (9, 7)], "doc_id long, label int")
    stats = quality_qda.statistics(docs)
    model = quality_qda.fit(stats.join(labels.where("pmod(doc_id, 5) <> 0"), "doc_id"))
    got = quality_qda.score(stats, model).collect()
    assert len(got) == 144 and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.score for r in got}
    assert all(by[i] >= 0.3 for i, _ in good) and all(by[i] < 0.3 for i, _ in bad)
    one = quality_qda.fit(stats.join(labels.where("label = 1"), "doc_id"))
    assert {r.score for r in quality_qda.score(stats, one).collect()} == {1.0}
    assert {r.score for r in quality_qda.score(stats, quality_qda.fit(stats.join(labels.where("false"), "doc_id"))).collect()} == {0.5}
    assert quality_qda.statistics(docs.where("false")).collect() == []


def test_qda_posterior_is_the_density_ratio():
    rng = np.random.default_rng(2)
    k = len(quality_qda.STATISTICS)
    x = {c: rng.normal(c, 1 + c, (500, k)) for c in (0, 1)}
    model = quality_qda.QdaModel({}, {}, {}, {})
    for c in (0, 1):
        cov = np.cov(x[c].T)
        model.means[c], model.factors[c] = x[c].mean(axis=0), np.linalg.cholesky(cov)
        model.log_dets[c], model.log_priors[c] = np.linalg.slogdet(cov)[1], np.log(0.5)
    y = rng.normal(0.5, 1, (20, k))
    want = []
    for v in y:
        d = [-0.5 * (np.linalg.slogdet(np.cov(x[c].T))[1] + (v - model.means[c]) @ np.linalg.inv(np.cov(x[c].T)) @ (v - model.means[c])) for c in (0, 1)]
        want.append(1 / (1 + np.exp(d[0] - d[1])))
    assert quality_qda.posterior(model, y, quality_qda.QdaConfig(temper=1.0)) == pytest.approx(np.array(want), abs=1e-8)


# ---------------------------------------------------------------- toxicity


def test_forward_backward_matches_enumeration(monkeypatch):
    import itertools

    monkeypatch.setattr(toxic_crf, "BLOCK", 3)
    rng = np.random.default_rng(0)
    first = np.array([0, 1, 1, 5, 16, 16])
    emission, transition = rng.normal(size=16) * 2, rng.normal(size=(2, 2))
    p, expected, log_z = toxic_crf.forward_backward(emission, transition, first)
    want, pairs, total = np.zeros(16), np.zeros((2, 2)), 0.0
    for a, b in zip(first[:-1], first[1:]):
        z, q, e = 0.0, np.zeros(b - a), np.zeros((2, 2))
        for y in itertools.product((0, 1), repeat=b - a):
            w = np.exp(sum(emission[a + i] * y[i] for i in range(b - a)) + sum(transition[y[i - 1], y[i]] for i in range(1, b - a)))
            z, q = z + w, q + w * np.array(y)
            for i in range(1, b - a):
                e[y[i - 1], y[i]] += w
        if b > a:
            want[a:b], pairs, total = q / z, pairs + e / z, total + np.log(z)
    assert p == pytest.approx(want) and expected == pytest.approx(pairs) and log_z == pytest.approx(total)


def test_toxic_words_are_found_with_offsets(spark):
    rng = random.Random(5)
    rows = []
    for i in range(240):
        w = words(80, i)
        if i % 3 == 0:
            for k in rng.sample(range(80), 3):
                w[k] = rng.choice(["Grobian", "grobians", "Schuft!"])
        rows.append((i, " ".join(w)))
    odd = [(900, None), (901, ""), (902, "w1 " * 40_000 + "schuft"), (902, "w1 w2"), (None, "Grobian w3")]
    docs = frame(spark, rows + odd)
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows] + [(900, 1)], "doc_id long, label int")
    cfg = toxic_crf.CrfConfig(bits=14)
    model = toxic_crf.fit(docs, labels.where("pmod(doc_id, 5) <> 0"), cfg)
    got = toxic_crf.score(docs, model, cfg).collect()
    assert len(got) == 245
    by = {r.doc_id: r for r in got if r.doc_id not in (902, None)}
    texts = dict(rows)
    assert all((by[i].score >= 0.5) == (i % 3 == 0) for i, _ in rows)
    found = [texts[i].encode()[s.start:s.start + s.length].lower() for i, _ in rows for s in by[i].spans]
    assert set(found) <= {b"grobian", b"grobians", b"schuft"} and len(found) >= 230
    assert by[900].score == 0 and by[901].score == 0 and by[901].spans == []
    assert max(r.score for r in got if r.doc_id == 902) >= 0.5
    kept = toxic_crf.filtered(docs, model, cfg, 0.5)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows if i % 3} | {900, 901, 902}
    assert toxic_crf.fit(docs, labels.where("label = 0"), cfg) is None
    assert {r.score for r in toxic_crf.score(docs, None, cfg).collect()} == {0.0}


def built_words(n, rng, syllables):
    """Words of one to four syllables, as of a language that builds words freely."""
    return ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(n)]


LANGUAGES = {
    "listed": ("th er in on an re at en nd ti es or te of ed is it al ar st to nt ng se ha as ou io le ve".split(), ["stupid", "worthless", "trash", "clown"]),
    "built": ("ung keit lich heit ver ge be zu ein sch au ach ß ü ö ä tz pf st te und die der en er el ch ie an ab".split(), ["achlich"]),
    "signed": ("é eux ment ré ai ou tion le ê pa an vi que on tre aux eau ier elle ç è ch en oi la des re qui il ne".split(), ["réeux"]),
}


def toxic_rows(language, at, n=160, seed=0):
    """(doc_id, text, label): toxic texts repeat words of the list, or words built on its stem; clean ones may hold a single one."""
    rng, (syllables, bad) = random.Random(seed + at), LANGUAGES[language]
    rows = []
    for i in range(n):
        toxic = i % 8 == 0
        w = built_words(rng.randint(120, 400), rng, syllables)
        listed = language == "listed"
        for k in rng.sample(range(len(w)), 2 + len(w) // 60 if toxic else int(not listed and i % 5 == 0)):
            w[k] = rng.choice(bad) if listed else bad[0] + rng.choice(syllables)
        rows.append((at + i, " ".join(w), int(toxic)))
    return rows


def test_toxic_texts_are_found_in_every_language(spark):
    rows = {name: toxic_rows(name, 1000 * k, 280) for k, name in enumerate(LANGUAGES)}
    every = [r for v in rows.values() for r in v]
    docs = frame(spark, [(i, t) for i, t, _ in every])
    labels = spark.createDataFrame([(i, y) for i, _, y in every], "doc_id long, label int")
    held = {i for i, _, _ in every if i % 3 == 1}
    cfg = toxic_crf.CrfConfig()
    model = toxic_crf.fit(docs, labels.where("pmod(doc_id, 3) <> 1"), cfg)
    by = {r.doc_id: r.score for r in toxic_crf.score(docs, model, cfg, spans=False).collect()}
    for name, v in rows.items():
        bad, clean = ([by[i] >= 0.5 for i, _, y in v if i in held and y == c] for c in (1, 0))
        assert len(bad) >= 10 and sum(bad) >= 0.8 * len(bad), name
        assert sum(clean) <= 0.05 * len(clean), name


def plain_marginals(emission, transition):
    """Marginals of the toxic state of one chain, by messages of plain numbers."""
    a, n = np.exp(transition), len(emission)
    e = [np.array([1.0, math.exp(x)]) for x in emission]
    ahead, back = [e[0]], [np.ones(2)]
    for k in range(1, n):
        m = (ahead[-1] @ a) * e[k]
        ahead.append(m / m.sum())
    for k in range(n - 1, 0, -1):
        m = a @ (e[k] * back[-1])
        back.append(m / m.sum())
    return [float(f[1] * b[1] / (f @ b)) for f, b in zip(ahead, reversed(back))]


def test_toxicity_matches_plain_chain(spark):
    cfg = toxic_crf.CrfConfig(bits=12)
    rows = [r for k, name in enumerate(LANGUAGES) for r in toxic_rows(name, 1000 * k, 64)]
    docs = [(i, t) for i, t, _ in rows] + [(9000, None), (9001, ""), (9002, "#* ,"), (9003, "Stupid"), (9004, "trash " * 300)]
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, label int")
    model = toxic_crf.fit(frame(spark, docs), labels, cfg)
    got = {r.doc_id: r for r in toxic_crf.score(frame(spark, docs), model, cfg).collect()}
    roller, shift = common.Roller(23), 64 - cfg.bits

    def bucket(code):
        return int(common.mix(np.array([code], np.uint64))[0]) >> shift

    @functools.cache
    def weight(w):
        """Weight of a word and its grams; its stems' buckets."""
        data = np.frombuffer(w, np.uint8)
        total = model.bias + model.word[int(roller.spans(data, np.array([0]), np.array([len(w)]))[0]) >> shift]
        edged = b" " + w + b" " * 3
        total += sum(model.gram[bucket(int.from_bytes(edged[k:k + 4], "big") + 1)] for k in range(max(len(w) - 1, 1)))
        return total, [bucket((int.from_bytes(w[:k], "big") << 3) | k) for k in toxic_crf.STEMS]

    for i, text in docs:
        low = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
        found = list(re.finditer(rb"[a-z0-9\x80-\xff]+", low))
        stems = Counter(m[0][:k] for m in found for k in toxic_crf.STEMS if len(m[0]) >= k)
        emission = []
        for m in found:
            total, stem = weight(m[0])
            for k, at in zip(toxic_crf.STEMS, stem):
                n = stems[m[0][:k]] if len(m[0]) >= k else 0
                total += model.stem[at] if n > 1 and n * cfg.sparse >= len(found) else 0.0
            emission.append(total)
        p = plain_marginals(emission, model.transition) if found else []
        assert got[i].score == pytest.approx(max(p, default=0.0), abs=1e-9)
        sure = [(m.start(), m.end() - m.start(), q) for m, q in zip(found, p) if q >= 0.5]
        assert [(x.start, x.length) for x in got[i].spans] == [(a, n) for a, n, _ in sure]
        assert [x.marginal for x in got[i].spans] == pytest.approx([q for _, _, q in sure], abs=1e-9)
    assert any(got[i].spans for i, _ in docs)


def test_toxicity_of_empty_tables(spark):
    docs, cfg = frame(spark, [(1, "a b"), (2, None)]), toxic_crf.CrfConfig(bits=10)
    labels = spark.createDataFrame([(1, 1)], "doc_id long, label int")
    for d, y in ((docs.where("false"), labels), (docs, labels.where("false")), (docs, labels)):
        model = toxic_crf.fit(d, y, cfg)
        assert model is None and toxic_crf.filtered(d, model, cfg, 0.5).count() == d.count()
    some = toxic_crf.CrfModel(*(np.zeros(1 << cfg.bits) for _ in range(3)), -2.0, np.zeros((2, 2)))
    none = docs.where("false")
    assert toxic_crf.score(none, some, cfg).collect() == [] and toxic_crf.filtered(none, some, cfg, 0.5).collect() == []


@pytest.mark.parametrize("scale", [1, 2, 4, 64])
def test_one_rule_marks_at_every_size(scale):
    # Features in (toxic, clean) documents: two plain ones, one that is toxic by four fifths, one frequent, one rare.
    pos, neg = np.array([6, 5, 4, 20, 1]) * scale, np.array([0, 0, 1, 180, 0]) * scale
    share, trust = toxic_crf._evidence(pos, neg, 20 * scale, 180 * scale, (1.0, 1.0), 0.98, 0.05)
    assert share.tolist() == pytest.approx([1, 1, 0.8, 0.1, 1]) and trust[2] == trust[3] == 0
    assert trust[0] >= trust[1] >= trust[4] and trust[0] == trust.max() and (trust[1] > trust[4] or scale == 64)
    # More labels with the same shares only add trust, without a jump back.
    assert trust[0] >= toxic_crf._evidence(pos // scale, neg // scale, 20, 180, (1.0, 1.0), 0.98, 0.05)[1][0]


def test_class_caps_do_not_change_the_share_that_marks(spark, monkeypatch):
    rows = [(i, " ".join([*words(30, i), "schuft" if i % 8 == 0 else "ruhe", "plapper" if i % 8 == 0 or i % 8 == 1 else "still"])) for i in range(480)]
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(i, int(i % 8 == 0)) for i, _ in rows], "doc_id long, label int")
    marks = []
    monkeypatch.setattr(toxic_crf, "train_chain", lambda f, tags, cfg: marks.append({f.word[k] for k in np.flatnonzero(tags)}))
    # "plapper" is in all toxic and a seventh of the clean documents: a share of 0.5, but 0.88 with as many clean as toxic ones
    for rows_a_class in (10_000, 60):
        toxic_crf.fit(docs, labels, toxic_crf.CrfConfig(sample_rows=rows_a_class, min_share=0.8))
    assert marks[0] == marks[1] and len(marks[0]) == 1
    assert toxic_crf.label_weights(labels, toxic_crf.CrfConfig(sample_rows=60)) == {0: 7.0, 1: 1.0}


def test_few_labels_give_soft_weights(spark):
    rows = [(i, " ".join([*words(12, i, 30), "schuft" if i < 2 else "ruhe"])) for i in range(8)]
    labels = spark.createDataFrame([(i, int(i < 2)) for i, _ in rows], "doc_id long, label int")
    cfg = toxic_crf.CrfConfig()
    model = toxic_crf.fit(frame(spark, rows), labels, cfg)
    by = {r.doc_id: r.score for r in toxic_crf.score(frame(spark, rows), model, cfg).collect()}
    assert model is not None and max(by[i] for i in range(2, 8)) < min(by[0], by[1]) and max(by.values()) < 0.5


def test_training_passages_are_balanced_by_tag(spark):
    rows = [(i, " ".join([*words(30, i), "schuft" if i < 100 else "ruhe"]), int(i < 100)) for i in range(400)]
    sample = spark.createDataFrame(rows, "doc_id long, text string, label int")
    cfg = toxic_crf.CrfConfig(train_tokens=24 * 40)
    f = toxic_crf.Features(next(common.text_slices(pa.array(["schuft"]))), common.Roller(23), cfg)
    marks = np.zeros(2 << cfg.bits)
    marks[f.gram[1]] = 1.0
    texts, repeats = toxic_crf.training_passages(sample, marks, cfg)
    assert sum(b"schuft" in t for t in texts) == 20 and len(texts) == len(repeats) == 40


# ---------------------------------------------------------------- substring dedup


def brute_removed(rows, size):
    first, out = {}, []
    for i, t in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        w = (t or "").encode().split()
        for k in range(len(w) - size + 1):
            first.setdefault(tuple(w[k:k + size]), i)
    for i, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - size + 1):
            if i is not None and first[tuple(w[k:k + size])] < i:
                gone[k:k + size] = [True] * size
        out.append((i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()))
    return sorted(out, key=str)


def repeat_rows():
    passage, other = words(70, 1), words(55, 2)
    rows = [(i, " ".join(words(90, 100 + i) + passage + words(5, i))) for i in range(6)]
    rows += [(10, " ".join(other)), (11, "  ".join(other)), (12, " ".join(other[:49])), (13, "same " * 300), (14, "same " * 120)]
    rows += [(20, None), (21, ""), (22, " \n\t "), (23, rows[0][1]), (23, rows[0][1]), (None, rows[0][1]), (24, " ".join(words(20_000, 7)))]
    return rows + [(25, "x " + rows[-1][1])]


@pytest.mark.parametrize("size", [50, 7])
def test_repeated_passages_go(spark, size):
    rows = repeat_rows()
    got = substr_dedup.remove_repeats(spark, frame(spark, rows), substr_dedup.SubstringConfig(size)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == brute_removed(rows, size)
    assert all(sum(x.hi - x.lo for x in r.removed) == r.n_removed for r in got)


def test_large_ids_beside_null_ids_keep_the_first_copy(spark):
    passage = " ".join(words(60, 1))
    rows = [((1 << 60) + 1, passage), ((1 << 60) + 3, "a " + passage), (None, passage)]
    got = substr_dedup.remove_repeats(spark, frame(spark, rows).coalesce(1)).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in got), key=str) == brute_removed(rows, 50)


def test_cleaned_keeps_columns_and_untouched_texts(spark):
    rows = repeat_rows()
    docs = frame(spark, rows)
    out = substr_dedup.cleaned(spark, docs)
    assert out.columns == docs.columns and out.schema == docs.schema
    want = {(i, k) for (i, n, gone, k) in brute_removed(rows, 50) if gone and gone < n}
    got = out.collect()
    assert {(r.doc_id, r.text) for r in got if r.doc_id in {i for i, _ in want}} == want
    assert all(r.n_chars == len(r.text or "") and r.anchors == "x" for r in got)
    assert (11, "  ".join(words(55, 2))) not in {(r.doc_id, r.text) for r in got}
    assert {20, 21, 22, None} <= {r.doc_id for r in got}
    assert substr_dedup.cleaned(spark, docs.where("false")).collect() == []


def test_levels_drop_what_repeats_at_no_shorter_length(spark):
    """Windows alone at 12 words never reach the level of 25, and those alone there never that of 50."""
    line, part = words(16, 1, 10_000), words(30, 2, 10_000)
    rows = [(i, " ".join(words(200, 50 + i, 10_000) + line + words(200, 90 + i, 10_000))) for i in range(8)]
    rows += [(20 + i, " ".join(words(100, 70 + i, 10_000) + part + words(60, 80 + i, 10_000))) for i in range(4)]
    rows += [(40 + i, " ".join(words(60, 3, 10_000))) for i in range(2)]
    cfg, docs = substr_dedup.SubstringConfig(), frame(spark, rows)
    assert cfg.lengths() == [12, 25] and substr_dedup.SubstringConfig(7).lengths() == [3]
    levels = substr_dedup.level_survivors(spark, docs, cfg)
    every = substr_dedup.document_anchors(docs.select("doc_id", "text"), cfg).count()
    holders = [{r.doc_id // 20 for r in rows.select("doc_id").distinct().collect()} for _, rows in levels]
    assert [n for n, _ in levels] == [12, 25] and every > 3 * levels[0][1].count() > 3 * levels[1][1].count()
    assert holders[1] <= holders[0] and 2 in holders[1]  # the passage of 60 words; lines of 16 words end at 12
    # Without the level of 12 more anchors reach the one of 25; the result is the same.
    one = substr_dedup.level_survivors(spark, docs, substr_dedup.SubstringConfig(first_length=20))
    assert [n for n, _ in one] == [25] and one[0][1].select("w25").distinct().count() == levels[1][1].select("w25").distinct().count()
    got = [sorted(map(str, substr_dedup.remove_repeats(spark, docs, substr_dedup.SubstringConfig(first_length=k)).collect())) for k in (4, 8, 20)]
    assert got[0] == got[1] == got[2]
    # Nothing in common: the loop ends at its first level.
    alone = frame(spark, [(i, " ".join(words(100, 300 + i, 1_000_000))) for i in range(3)])
    assert [n for n, _ in substr_dedup.level_survivors(spark, alone, cfg)] == [12]
    assert [r.n_removed for r in substr_dedup.remove_repeats(spark, alone).collect()] == [0] * 3


def test_doubling_goes_on_until_nothing_repeats(spark):
    shared = words(230, 9, 10_000)
    rows = [(1, " ".join(shared)), (2, "y " + " ".join(shared)), (3, " ".join(words(100, 4, 10_000) + shared[:60])), (4, " ".join(words(90, 5, 10_000)))]
    got = {r.doc_id: r.longest for r in substr_dedup.longest_repeats(spark, frame(spark, rows)).collect()}
    assert got == {1: 200, 2: 200, 3: 50}


# ---------------------------------------------------------------- decontamination


def brute_hits(text, items, window):
    w = decontaminate.normal_words((text or "").encode())
    hit, found = set(), set()
    for i, t in items:
        iw = decontaminate.normal_words((t or "").encode())
        n = min(window, len(iw))
        for k in range(len(iw) - n + 1 if iw else 0):
            for j in range(len(w) - n + 1):
                if w[j:j + n] == iw[k:k + n]:
                    hit.update(range(j, j + n))
                    found.add(str(i))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("shard_bytes", [1 << 20, 60])
def test_contamination_matches_brute_force(spark, shard_bytes):
    items = [(2, "The quick, brown fox"), (10, " ".join(words(14, 3, 50))), (11, " ".join(words(14, 3, 50))), (3, None), (4, "  "), (5, "É-É 7"), (None, "w1")]
    rows = [(1, "THE QUICK brown-fox! the quick"), (2, None), (3, ""), (4, " ".join(["a"] + words(14, 3, 50)[2:] + ["b"])), (5, "xx ÉÉ É É 7, thequick brown fox"),
            (6, "w1 " * 3000 + "the quick brown fox"), (6, "w1"), (None, "the quick brown fox")]
    docs, bench = frame(spark, rows), spark.createDataFrame(items, "item_id long, text string")
    cfg = decontaminate.DecontaminateConfig(window=10, shard_bytes=shard_bytes)
    found = decontaminate.contamination(spark, docs, bench, cfg)
    want = sorted(((i, *brute_hits(t, [x for x in items if x[0] is not None], 10)[:2], hashlib.sha256(",".join(brute_hits(t, [x for x in items if x[0] is not None], 10)[2]).encode()).hexdigest()) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r.items_sha256) for r in decontaminate.digest(found).collect()), key=str) == want
    left = decontaminate.clean(spark, docs, bench, cfg)
    assert left.columns == docs.columns and sorted((r.doc_id for r in left.collect()), key=str) == sorted((i for i, n, h, _ in want if not h), key=str)
    spans = {r.doc_id: [(s.start, s.length) for s in r.spans] for r in decontaminate.spans(found.where("doc_id = 1")).collect()}
    assert spans == {1: [(0, 19)]}
    none = decontaminate.digest(decontaminate.contamination(spark, docs, bench.where("false"), cfg)).collect()
    assert {r.n_hit for r in none} == {0}


# ---------------------------------------------------------------- ProbMinHash


def test_registers_estimate_probability_jaccard():
    a = {k: 1 + k % 3 for k in range(200)}
    b = {k: 1 + (k + k // 50) % 3 for k in range(60, 260)}
    mixed = {k: common.mix(np.array([k], np.uint64))[0] for k in range(260)}

    def arrays(s):
        order = sorted(s, key=lambda k: mixed[k])
        return np.array([mixed[k] for k in order], np.uint64), np.array([s[k] for k in order])

    (x, wa), (y, wb) = arrays(a), arrays(b)
    exact = probminhash.probability_jaccard(x, wa, y, wb)
    brute = sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in set(a) | set(b)) for d in set(a) & set(b))
    assert exact == pytest.approx(brute)
    m = 4000
    regs = probminhash.registers(2, np.repeat([0, 1], [len(x), len(y)]), np.concatenate([x, y]), np.concatenate([wa, wb]).astype(float), m)
    assert (regs[0] == regs[1]).mean() == pytest.approx(exact, abs=4 * (exact * (1 - exact) / m) ** 0.5)


def brute_groups(rows, size=5, limit=0.8):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().lower().split() if i is not None else []
        sets[i] = Counter(tuple(w[k:k + size]) for k in range(max(len(w) - size + 1, 1))) if w else Counter()
    ids = sorted(i for i in sets if i is not None)
    group = {i: i for i in ids}
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            a, b = sets[i], sets[j]
            if a and b and sum(1 / sum(max(a[e] / a[d], b[e] / b[d]) for e in set(a) | set(b)) for d in set(a) & set(b)) >= limit - 1e-12:
                old, new = max(group[i], group[j]), min(group[i], group[j])
                group = {k: new if g == old else g for k, g in group.items()}
    return group


def test_near_duplicates_match_brute_force(spark):
    base = words(200, 1)
    rows = [(5, " ".join(base)), (7, " ".join(base).upper()), (7, " ".join(base).upper()), (9, " ".join(base[:100] + ["new"] + base[101:]))]
    for i in range(40):  # near copies that need not be near each other
        w = list(base)
        for k in random.Random(i).sample(range(200), 1 + i % 6):
            w[k] = f"edit{i}x{k}"
        rows.append((100 + i, " ".join(w)))
    chain = words(120, 2)
    for i in range(6):  # each near the next, the ends far apart
        rows.append((300 - i, " ".join(chain[4 * i:4 * i + 100])))
    rows += [(400, "a b"), (401, "A  b"), (402, "a c"), (500, None), (501, ""), (502, " "), (None, " ".join(base)), (None, None), (600, " ".join(words(9000, 3)))]
    got = probminhash.near_duplicates(spark, frame(spark, rows), probminhash.MinHashConfig(block=4))
    out = got.documents.collect()
    assert len(out) == len(rows)
    want = brute_groups(rows)
    assert {r.doc_id: r.group_id for r in out if r.doc_id is not None} == want
    assert all(r.kept == (r.doc_id == r.group_id) for r in out if r.doc_id is not None)
    assert all(r.group_id is None and r.kept for r in out if r.doc_id is None)
    assert all(r.similarity >= 0.8 - 1e-12 for r in got.links.collect())
    assert probminhash.near_duplicates(spark, frame(spark, rows).where("false")).documents.collect() == []


# ---------------------------------------------------------------- packing


def test_pack_uses_every_token_once_without_padding():
    rng = random.Random(1)
    for n in (0, 1, 3, 50, 400):
        lengths = [rng.choice([1, 2, 40, 255, 256, 257, 700, 1025, 2047, 2048, 2049, 9000]) for _ in range(n)]
        rows = packing.pack(lengths, (2048, 1024, 512, 256))
        used = Counter()
        for size, pieces in rows:
            assert size & (size - 1) == 0 and size <= 2048 and sum(p.length for p in pieces) == size
            for p in pieces:
                assert p.length > 0
                used.update((p.doc, k) for k in range(p.start, p.start + p.length))
        assert len(used) == sum(lengths) and set(used.values()) <= {1}


def test_packed_does_not_depend_on_batches(spark):
    import public_tokenizers

    cfg = packing.PackingConfig(public_tokenizers.path("word_bpe_49k.json"), buffer_docs=50)
    docs = frame(spark, [(i, f"line {i} " * (i % 90)) for i in range(300)]).coalesce(1)
    want = sorted(packing.packed(docs, cfg).collect())
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    spark.conf.set(setting, "7")
    try:
        assert sorted(packing.packed(docs, cfg).collect()) == want
    finally:
        spark.conf.unset(setting)


def test_written_sends_small_batches(spark, tmp_path):
    from pyspark.sql import functions as F

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes]), pa.array([b.num_rows])], ["size", "n"])

    docs = spark.range(6000, numPartitions=1).select(F.repeat(F.lit("x"), 2000).alias("text"))
    got = common.written(spark, docs.mapInArrow(sizes, "size long, n long"), f"{tmp_path}/sizes").collect()
    assert sum(r.n for r in got) == 6000 and max(r.size for r in got) < 1.1 * common.BATCH_BYTES
    assert spark.conf.get(common.BATCH_SETTING, None) is None
    spark.conf.set(common.BATCH_SETTING, "100m")  # the session's own size holds
    try:
        assert len(common.written(spark, docs.mapInArrow(sizes, "size long, n long"), f"{tmp_path}/one").collect()) == 1
        assert spark.conf.get(common.BATCH_SETTING) == "100m"
    finally:
        spark.conf.unset(common.BATCH_SETTING)


def test_packed_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    own = Tokenizer.from_file(path)
    rng = random.Random(0)
    signs = "abcXYZ éÉöß×÷'\n\t 019.,!<|>_µªºÂ日́\x1c\x85"
    texts = [None, "", " ", "it's a DOG'S life 12 <|endoftext|>x", "word " * 5000] + ["".join(rng.choice(signs) for _ in range(rng.randint(1, 80))) for _ in range(300)]
    rows = list(enumerate(texts)) + [(None, "null id")]
    got = packing.packed(frame(spark, rows).repartition(3), packing.PackingConfig(path, buffer_docs=50)).collect()
    ids = {i: np.array(own.encode(t or "", add_special_tokens=False).ids + [1], "<u4") for i, t in rows}
    for i in ids:
        at = 0
        for r in sorted((r for r in got if r.doc_id == i), key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids[i])
            assert r.ids_crc32 == zlib.crc32(ids[i][at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids[i])
    rows_of = {}
    for r in got:
        rows_of.setdefault(r.sequence_id, []).append((r.offset, r.length, r.tier))
    for pieces in rows_of.values():
        at = 0
        for offset, length, tier in sorted(pieces):
            assert offset == at
            at += length
        assert at == tier <= 2048 and at & (at - 1) == 0
    assert len(rows_of) == len({(r.sequence_id, r.step_group) for r in got})  # a sequence is in one group
    assert packing.packed(frame(spark, rows).where("false"), packing.PackingConfig(path)).collect() == []


def test_step_groups_are_full_over_all_partitions(spark):
    rng = random.Random(3)
    rows, nth, sequence = [], Counter(), 0
    for part in (0, 1, 2, 5, 9):
        for _ in range(rng.randint(1, 60)):
            size = rng.choice([2048, 1024, 512, 256, 64, 2, 1])
            cut = rng.randint(1, size)
            for at, n in ((0, cut), (cut, size - cut)):
                if n:
                    rows.append((sequence, 0, n, 0, n, sequence, at, size, part, nth[part, size]))
            nth[part, size] += 1
            sequence += 1
    made = spark.createDataFrame(rows, f"{packing.PIECES}, part long, nth long").repartition(4)
    got = packing.step_groups(made, 4096).collect()
    assert sorted((r.sequence_id, r.offset, r.length) for r in got) == sorted((r[5], r[6], r[2]) for r in rows)
    assert len({(r.sequence_id, r.step_group) for r in got}) == sequence
    tokens, tiers = Counter(), {}
    for r in got:
        tokens[r.step_group] += r.length
        tiers.setdefault(r.step_group, set()).add(r.tier)
    short = [g for g, n in tokens.items() if n != 4096]
    assert len(short) <= 1 and all(tokens[g] < 4096 and g == max(x for x in tokens if not x % 2**32) for g in short)
    assert all(tiers[g] == {g % 2**32} for g in tokens if g % 2**32)
    assert packing.step_groups(made.where("false"), 4096).collect() == []
    with pytest.raises(ValueError, match="powers of two"):
        packing.packed(made.select("doc_id"), packing.PackingConfig("", tiers=(1000,)))


def test_linked_copies_are_not_dealt_to_each_other(spark):
    cfg = probminhash.MinHashConfig()
    comps = [1] * 5000 + [7001] + [7002] * 300
    rows = [(3, 0, i, c, b"p", [0], len(comps)) for i, c in enumerate(comps)]
    schema = "key long, band int, doc_id long, comp long, prints binary, bands array<long>, n long"
    dealt = probminhash.chunk_pairs(spark.createDataFrame(rows, schema), cfg).select("lo", "hi", "doc_id", "comp").collect()
    assert len(dealt) == 5000 * 2 + 301 * 22  # all chunk pairs would be over 110,000 rows
    held = {}
    for r in dealt:
        held.setdefault((r.lo, r.hi), []).append(r)
    met = {(min(a.doc_id, b.doc_id), max(a.doc_id, b.doc_id)) for g in held.values() for a in g if a.comp != 1 for b in g if a.comp != b.comp}
    assert len(met) == 5000 * 301 + 300  # every pair of documents of two components meets
    alone = spark.createDataFrame([(3, 0, i, 1, b"p", [0], 9) for i in range(9)], schema)
    assert probminhash.chunk_pairs(alone, cfg).collect() == []


def test_deduplicated_keeps_texts_that_share_an_id(spark):
    a, b, c = (" ".join(words(60, k)) for k in (1, 2, 3))
    schema = "doc_id long, text string, lang string, __x int"
    rows = [(1, a, "en", 1), (5, a, "en", 2), (5, b, "en", 3), (9, c, "de", 4), (9, c, "aa", 5), (None, a, "en", 6), (7, None, "en", 7), (8, "", "en", 8), (5, None, "en", 9)]
    got = sorted((r[3] for r in probminhash.deduplicated(spark, spark.createDataFrame(rows, schema)).collect()))
    assert got == [1, 3, 5, 6, 7, 8, 9]
    # Near copies of both texts of one id go to their own groups.
    near = rows[:3] + [(10, b + " more", "en", 20), (11, a + " more", "en", 21), (4, c + " x", "en", 22), (9, c, "en", 23)]
    for _ in range(2):
        got = sorted(r[3] for r in probminhash.deduplicated(spark, spark.createDataFrame(near, schema).repartition(3)).collect())
        assert got == [1, 3, 22]
    assert probminhash.deduplicated(spark, spark.createDataFrame([], schema)).collect() == []


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_the_tokenizers_own(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    own, encoder = Tokenizer.from_file(path), packing.TextTokenizer(path)
    texts = ["Hello World, it's 2024!", "", "Ünïcode Ça — test", "a  b\n\nc\t1 23", "x<|endoftext|>y", "ALL CAPS", " lead"]
    got = encoder.encode(next(common.text_slices(pa.array(texts))))
    assert [x.tolist() for x in got] == [own.encode(t, add_special_tokens=False).ids for t in texts]
    assert encoder.known_rules == (name == "word_bpe_49k.json")


def test_bounded_piece_cache_gives_the_same_ids(monkeypatch):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    texts = pa.array([" ".join(words(300, i)) for i in range(20)])
    one, two = packing.TextTokenizer(path), packing.TextTokenizer(path)
    whole = [x.tolist() for t in common.text_slices(texts) for x in one.encode(t)]
    monkeypatch.setattr(packing, "CACHE_PIECES", 10)
    assert whole == [x.tolist() for t in common.text_slices(texts, 2000) for x in two.encode(t)]
