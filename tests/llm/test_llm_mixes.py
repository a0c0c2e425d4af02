"""Source mixing, filter interactions and vector codes against plain versions of them."""

import dataclasses
import hashlib
import itertools
import math
import os
import random
import re
import sys
from collections import Counter, defaultdict

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from scorebook.llm import code_cells, filter_audit, mixing, queries  # noqa: E402

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SF001 = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- mixing


def documents(rng):
    sources = [None, "", "a", "b", "ab", "é", "zz", "one word", "none"]
    rows = []
    for i in range(260):
        s = "a" if i % 3 == 0 else sources[rng.randrange(7)]
        rows.append((i, " ".join(["w"] * rng.randrange(0, 60)), s))
    rows += [(1000, " \t x\n" * 4000, "b"), (1001, "x", "one word"), (1002, None, "none"), (1003, " \n ", "none")]
    rows += [(None, "a b c", "a")] * 5 + [(7, "again and again", "zz")] * 6
    return rows


def plain_targets(sizes, weights, percent, repeats):
    """Resharing by hand: cap what is above, give the excess to the others by weight, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    mix = percent * sum(sizes.values()) / 100
    capped = set()
    while True:
        free = [s for s in order if s not in capped]
        left = mix - sum(repeats * sizes[s] for s in capped)
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        above = {s for s in free if share[s] > repeats * sizes[s]}
        if not above:
            return {**share, **{s: float(repeats * sizes[s]) for s in capped}}, order
        capped |= above


@pytest.mark.parametrize("small_tasks", [False, True])
def test_mix_matches_plain_version(spark, small_tasks):
    rows = documents(random.Random(3))
    cfg = mixing.MixConfig(block_words=16)
    docs = spark.createDataFrame([(*r, 5, "x") for r in rows], "doc_id long, text string, source string, row int, slot string").repartition(4)
    mix = mixing.mixed(spark, docs, cfg, partitions=5, single_task_rows=2 if small_tasks else 1_000_000)
    got = mixing.takings(mix).collect()

    size = lambda t: len(WORD.findall(t or ""))
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += size(t)
    targets, order = plain_targets(dict(sizes), cfg.weights, cfg.percent, cfg.max_repeats)
    assert Counter((r.doc_id, r.size) for r in got) == Counter((i, size(t)) for i, t, _ in rows)
    assert math.isclose(sum(targets.values()), 1.5 * sum(sizes.values()))

    # The same streams by hand: documents in their order, two turns, cut at the target.
    placed = [r.asDict() for r in mix.documents.withColumn("order", F.xxhash64("doc_id", "size", F.lit(cfg.seed))).collect()]
    want = Counter()
    for s in order:
        words, at = math.floor(targets[s] + 0.5), 0
        for r in sorted((r for r in placed if r["source"] == s and r["size"]),
                        key=lambda r: (r["order"], r["doc_id"] is not None, r["doc_id"] or 0, r["size"])):
            n = sum(max(0, min(at + turn * sizes[s] + r["size"], words) - (at + turn * sizes[s])) for turn in range(2))
            want[(r["doc_id"], r["size"], sizes[s], round(targets[s], 6), n)] += 1
            at += r["size"]
        for r in placed:
            if r["source"] == s and not r["size"]:
                want[(r["doc_id"], 0, sizes[s], round(targets[s], 6), 0)] += 1
    assert Counter((r.doc_id, r.size, r.source_size, round(r.target, 6), r.taken) for r in got) == want
    assert all(r.taken <= 2 * r.size for r in got)

    # The schedule: van der Corput points through cumulative blocks, each slot filled without gaps.
    blocks = [-(-math.floor(targets[s] + 0.5) // cfg.block_words) for s in order]
    total, bits = sum(blocks), (sum(blocks) - 1).bit_length()
    owner = [i for i, k in enumerate(blocks) for _ in range(k)]
    slots = sorted((int(f"{v:0{bits}b}"[::-1], 2), owner[v]) for v in range(total))
    pieces = mix.pieces.collect()
    held = defaultdict(list)
    for p in pieces:
        held[(p.slot, p.sid)].append((p.offset, p.length))
    assert sorted(held) == slots
    short = 0
    for spans in held.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        short += at < cfg.block_words
    assert short <= len(order)  # only the last block of a source may be shorter
    for part in (total // 4, total // 2):  # any head of the mix is close to the weights
        seen = Counter(s for _, s in slots[:part])
        assert all(abs(seen[i] - blocks[i] * part / total) <= 1 + bits for i in range(len(order)))
    # No word of a document is taken three times.
    times = Counter((p.row, w) for p in pieces for w in range(p.start, p.start + p.length))
    assert max(times.values()) <= 2


def test_mix_agrees_with_itself_on_another_layout(spark):
    rows = documents(random.Random(5))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    run = lambda d, p: sorted(map(str, mixing.takings(mixing.mixed(spark, d, partitions=p)).collect()))
    assert run(docs.coalesce(1), 1) == run(docs.orderBy(F.rand(1)).repartition(6), 4)


def test_mix_of_nothing(spark):
    schema = "doc_id long, text string, source string"
    assert mixing.takings(mixing.mixed(spark, spark.createDataFrame([], schema))).collect() == []
    got = mixing.takings(mixing.mixed(spark, spark.createDataFrame([(1, None, None), (2, " ", "a")], schema))).collect()
    assert sorted((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in got) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_mix_of_given_tables_meets_targets(spark):
    got = queries.op11_mixing(spark, SF001).groupBy("source_size", "target").agg(F.sum("taken").alias("n"), F.sum("size").alias("size")).collect()
    assert all(abs(r.n - r.target) <= 0.5 + 1e-6 * r.target or r.n % round(r.target) == 0 for r in got)


# ---------------------------------------------------------------- filter interactions


def failures(rows):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(first.get(t or "", i), i)
    for i, t, s in rows:
        t = t or ""
        words = WORD.findall(t)
        fails = "A" * (len(words) < 50) + "B" * (100 * len(set(words)) < 65 * len(words))
        fails += "C" * (100 * len(re.findall("[A-Z]", t)) > 5 * len(t)) + "D" * bool(re.search(r"[#$%&*|]", t))
        yield i, s or "", fails + "E" * (i is not None and first.get(t, i) < i)


def plain_audit(rows, labels):
    good = {i for i, q, _ in labels if i is not None and q == 1}
    toxic = {i for i, _, x in labels if i is not None and x == 1}
    docs = list(failures(rows))
    out, removed = {}, Counter()
    for part in {p for _, p, _ in docs}:
        for p in itertools.permutations("ABCDE"):
            left = [(i, f) for i, q, f in docs if q == part]
            every = list(left)
            for step, f in enumerate(p, 1):
                gone = [(i, m) for i, m in left if f in m]
                left = [(i, m) for i, m in left if f not in m]
                out[(part, "".join(p), step)] = [
                    len(left), len(gone), sum(f in m for _, m in every) - len(gone), sum(m == f for _, m in every),
                    sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)]
                removed[(part, f)] += len(gone)
    return {k: (*v, removed[(k[0], k[1][k[2] - 1])]) for k, v in out.items()}


def test_filter_audit_matches_simulated_orders(spark):
    rng = random.Random(8)
    base = [" ".join(rng.choice(["word%d" % k for k in range(rng.choice([5, 400]))]) for _ in range(rng.randrange(20, 90))) for _ in range(25)]
    base += [b.upper() for b in base[:6]] + [b + " 5 $" for b in base[:9]] + ["", None, " \t", "É" * 30, "A" * 5 + "b" * 95, "A" * 6 + "b" * 94, "x " * 49, "x " * 50]
    rows = [(i, rng.choice(base), rng.choice([None, "", "s", "s", "s", "t"])) for i in range(150)]
    rows += [(3, rows[3][1], "s"), (3, rows[9][1], "s"), (None, base[0], "s"), (None, base[0], "t"), (None, None, None), (200, "same", "u"), (200, "same", "u")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 160, 2)] + [(4, 1, 0), (4, 0, 1), (None, 1, 1)]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, source string, part string, mask int").repartition(5)
    marks = spark.createDataFrame([(*r, 2) for r in labels], "doc_id long, quality int, toxic int, n int")
    got = {(r.part, r.filter_order, r.step): tuple(r)[3:] for r in filter_audit.audit(spark, docs, marks).collect()}
    assert got == plain_audit(rows, labels)


def test_filter_audit_of_nothing_and_other_filters(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    marks = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(spark, docs, marks).collect() == []
    one = spark.createDataFrame([(1, None, None)], docs.schema)
    assert {r.kept for r in filter_audit.audit(spark, one, marks).where("step = 5").collect()} == {0}
    counts = spark.createDataFrame([("p", 0, 4, 0, 0), ("p", 3, 2, 1, 0), ("p", 2, 1, 0, 1)], "part string, mask int, n long, good long, toxic long")
    got = {(r.filter_order, r.step): (r.kept, r.removed, r.shapley) for r in filter_audit.interactions(spark, counts, "XY").collect()}
    assert got == {("XY", 1): (5, 2, 2), ("XY", 2): (4, 1, 4), ("YX", 1): (4, 3, 4), ("YX", 2): (4, 0, 2)}
    with pytest.raises(ValueError, match="1 to 7"):
        filter_audit.interactions(spark, counts, "ABCDEFGH")


def test_mask_intervals_cover_each_rank_once():
    names = filter_audit.orders("ABCDE")
    assert names == sorted(names)
    for mask in range(32):
        spans = filter_audit.mask_intervals(mask, 5)
        step_of = {}
        for step, state, lo, hi in spans:
            if state == "removed":
                for r in range(lo, hi):
                    assert r not in step_of
                    step_of[r] = step
        want = {r: next(k for k, f in enumerate(o, 1) if mask >> (ord(f) - 65) & 1) for r, o in enumerate(names)} if mask else {}
        assert step_of == want


# ---------------------------------------------------------------- vector codes


def plain_codes(rows, cfg):
    top = 1 << 28  # of 16 components
    kept = [(i, l, [max(-top, min(top, math.floor(cfg.scale * x))) for x in v]) for i, l, v in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    packed = lambda v: np.array(v, "<i4").tobytes()
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, packed(r[2])))
    kept = [r for r in kept if len(r[2]) == len(kept[0][2])]
    width = -(-len(kept[0][2]) // cfg.parts)
    cut = [[(v + [0] * (cfg.parts * width))[p * width : (p + 1) * width] for p in range(cfg.parts)] for _, _, v in kept]
    books = [[list(c[p]) for c in cut[: cfg.entries]] for p in range(cfg.parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda p, x: min((far(x, e), k) for k, e in enumerate(books[p]))
    for _ in range(cfg.rounds):
        for p in range(cfg.parts):
            mine = defaultdict(list)
            for c in cut:
                mine[near(p, c[p])[1]].append(c[p])
            for k, xs in mine.items():
                books[p][k] = [sum(x) // len(xs) for x in zip(*xs)]
    out, by_label = [], Counter()
    for (i, l, _), c in zip(kept, cut):
        found = [near(p, c[p]) for p in range(cfg.parts)]
        out.append([i, l, "".join("%02x" % k for _, k in found), sum(d for d, _ in found)])
        by_label[l] += out[-1][3]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((i, c, e, by_label[l], sha) for i, l, c, e in out)


def coded(spark, rows, cfg):
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, label int, embedding array<float>, code int").repartition(3)
    return Counter(tuple(r) for r in code_cells.compressed(spark, df, cfg).collect())


@pytest.mark.parametrize("cell,cells", [(1024, 1 << 16), (200, 30), (1, 1 << 16), (1 << 30, 8)])
def test_codes_match_plain_quantisation(spark, cell, cells):
    rng = np.random.default_rng(6)
    f32 = lambda v: [float(np.float32(x)) for x in v]
    rows = [(int(i), int(i) % 4 if i % 5 else None, f32(rng.normal(size=16) * 0.2)) for i in rng.permutation(150) + 5]
    rows += [(9, 1, rows[0][2]), (9, 1, rows[0][2]), (None, 2, f32(rng.normal(size=16))), (400, None, f32([0.0] * 16)), (401, 3, f32([3e4, -3e38] * 8))]
    rows += [(1, 1, None), (0, 1, [0.5] * 15 + [None]), (2, 2, [0.5] * 15 + [float("nan")]), (3, 2, [float("inf")] * 16), (402, 7, [0.25] * 3), (403, 7, [])]
    cfg = code_cells.CodeConfig(cell=cell, cells=cells)
    assert coded(spark, rows, cfg) == plain_codes([r for r in rows if r[0] not in (402, 403)], cfg)


def test_codes_of_few_and_odd_vectors(spark):
    cfg = code_cells.CodeConfig()
    assert coded(spark, [(1, 1, None)], cfg) == Counter()
    rows = [(5, None, [0.1] * 10), (2, None, [0.3] * 10), (8, 1, [0.1] * 10)]  # ten components, three rows
    assert coded(spark, rows, cfg) == plain_codes(rows, cfg)
    wide = [(i, 1, [((7 * i + k) % 11) / 3 for k in range(300)]) for i in range(40)]
    wide = [(i, l, [float(np.float32(x)) for x in v]) for i, l, v in wide]
    assert coded(spark, wide, dataclasses.replace(cfg, rounds=2)) == plain_codes(wide, dataclasses.replace(cfg, rounds=2))


def test_cells_skip_dominated_entries_only():
    rng = np.random.default_rng(2)
    points, book = rng.integers(-900, 900, size=(3000, 3)), rng.integers(-900, 900, size=(16, 3))
    cells = code_cells.Cells(book, 128, 500)
    near = cells.candidates(points)
    exact = ((points[:, None, :] - book[None]) ** 2).sum(axis=2)
    assert near[exact == exact.min(axis=1)[:, None]].all()  # ties included
    assert near.mean() < 0.6
    entry, best = cells.nearest(points, distances=True)
    assert (entry == exact.argmin(axis=1)).all() and (best == exact.min(axis=1)).all()
