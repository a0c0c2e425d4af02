"""Operators on embeddings, urls and WARC records, components, and the pipeline, against brute force."""

import dataclasses
import gzip
import os
import random
import sys
from collections import Counter

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from scorebook.llm import components, ego_join, queries, url_filter, warc_merkle  # noqa: E402
from scorebook.llm.common import materialise, scratch, scratch_scope  # noqa: E402
from scorebook.session import scratch_path, scratch_root  # noqa: E402


def test_components_match_union_find(spark):
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (2000, 1999)]
    links += [(3000, 3001 + i) for i in range(200)] + [(1, 2), (2, 1), (1, 2)]
    group = {x: x for pair in links for x in pair}
    for _ in range(len(links)):
        for a, b in links:
            group[a] = group[b] = min(group[a], group[b])
    want = {x: g for x, g in group.items() if any(x in p and p[0] != p[1] for p in links)}
    got = {r.node: r.component for r in components.connected_components(spark, spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == want
    assert components.connected_components(spark, spark.createDataFrame([], "u long, v long")).collect() == []


# ---------------------------------------------------------------- embeddings


def brute_links(rows, cosine):
    ok = {}
    for i, v in rows:
        if i is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v):
            x = np.zeros(8)
            x[:len(v)] = v
            x = x / np.abs(x).max()
            ok[i] = x / np.sqrt((x * x).sum())
    ids = list(ok)
    near = {i: [j for j in ids if j != i and ok[i] @ ok[j] >= cosine] for i in ids}
    comp = {i: i for i, _ in rows if i is not None}
    for _ in range(len(ids)):
        for i in ids:
            for j in near[i]:
                comp[i] = comp[j] = min(comp[i], comp[j])
    return {i: (len(near.get(i, ())), comp[i], comp[i] == i) for i in comp}


@pytest.mark.parametrize("tile_bytes", [1, 10_000, 1 << 27])
def test_grid_order_join_matches_brute_force(spark, tile_bytes):
    rng = np.random.default_rng(4)
    rows = []
    for c in range(12):
        centre = rng.normal(size=8)
        rows += [(100 * c + i, (centre + rng.normal(size=8) * 0.05 * (i % 7)).tolist()) for i in range(25)]
    rows += [(5000 + i, rows[0][1]) for i in range(9)] + [(6000 + i, rng.normal(size=8).tolist()) for i in range(60)]
    rows += [(7000, None), (7001, []), (7002, [0.0] * 8), (7003, [1.0, None, 2.0]), (7004, [float("nan")] * 8), (7005, [float("inf"), 1.0]), (7006, [1e-200, 2e-200]), (7007, [1.0, 2.0])]
    table = spark.createDataFrame([(i, v, i, 1) for i, v in rows] + [(None, [1.0, 2.0], 0, 1)], "vec_id long, embedding array<double>, label long, copies int")
    cfg = ego_join.EgoConfig(block=20, leaf=4, fan=2, axes=3, box_axes=4, tile_bytes=tile_bytes, tasks=5)
    got = ego_join.near_duplicates(spark, table, cfg).collect()
    assert len(got) == len(rows) + 1
    assert {r.vec_id: (r.n_links, r.component_id, r.kept) for r in got if r.vec_id is not None} == brute_links(rows, 0.95)
    again = ego_join.near_duplicates(spark, table.unionByName(table.where("vec_id = 6000")), cfg).where("vec_id = 6000").collect()
    assert [(r.n_links, r.component_id) for r in again] == [(1, 6000), (1, 6000)]
    assert ego_join.near_duplicates(spark, table.where("false"), cfg).collect() == []


def test_far_intervals_are_skipped(spark):
    rows = [(i, [1.0, 0.0, 0.01 * (i % 3)]) for i in range(64)] + [(100 + i, [0.0, 1.0, 0.01 * (i % 3)]) for i in range(64)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    cfg = ego_join.EgoConfig(block=16, fan=2, axes=2, box_axes=2)
    good = ego_join.usable(table).withColumn("copies", ego_join.F.lit(1).cast("long"))
    axes = ego_join.principal_axes(good, 3)
    assert axes.T @ axes == pytest.approx(np.eye(3))
    blocks = ego_join.sequence_blocks(spark, ego_join.grid_order(good, axes, cfg), 3, cfg)
    assert blocks.count() == 8 and {r.n for r in blocks.collect()} == {16}
    assert ego_join.block_pairs(blocks, cfg).count() == 2 * (4 * 5 // 2)


@pytest.mark.parametrize("n, width", [(1, 1), (7, 2), (25, 5), (40, 4)])
def test_tiles_hold_each_block_pair_once(spark, n, width):
    pairs = {(a, b) for b in range(n) for a in range(b + 1) if (a * 7 + b) % 5}
    table = spark.createDataFrame(sorted(pairs) or [(0, 0)], "a long, b long")
    rows = ego_join.tile_members(table, width).collect()
    dealt = [(r.tile, r.block, p) for r in rows for p in r.partners]
    assert sorted((a, b) for _, a, b in dealt) == sorted(pairs or {(0, 0)})
    here = {(r.tile, r.block) for r in rows}
    assert len(here) == len(rows) and all({(t, a), (t, b)} <= here for t, a, b in dealt)
    side = -(-n // width)
    assert max(r.tile for r in rows) < side * (side + 1) // 2
    assert max(Counter(r.tile for r in rows).values()) <= 2 * width
    assert max(Counter(r.block for r in rows).values()) <= side


def test_tile_width_is_bounded_by_bytes():
    cfg = ego_join.EgoConfig()
    assert [ego_join.tile_width(n, 64, cfg) for n in (0, 1, 5, 25, 10_000)] == [1, 1, 2, 5, 64]
    assert ego_join.tile_width(10_000, 4096, cfg) == 1


# ---------------------------------------------------------------- urls


def test_url_parts_and_rules(spark):
    cases = {
        "http://WWW.Example.com/en/1?x=/es/": ("www.example.com", "/en/1", "www.example.com/en/"),
        "https://a.example.com/en/2#t": ("a.example.com", "/en/2", "example.com/en/"),
        "https://example.com/fr": ("example.com", "/fr", "com/"),
        "https://notexample.com/en/": ("notexample.com", "/en/", "com/"),
        "x://com": ("com", "", None), "x://com/": ("com", "/", "com/"), "http://É.NET/es/ü": ("É.net", "/es/ü", "net/es/"),
        "http://b.org?u=://c.com/": ("b.org", "", None), "http://m.net/fr": ("m.net", "/fr", None), "noscheme/en/": ("", "", None),
        "://x.net/fr/": ("x.net", "/fr/", "net/fr/"), "": ("", "", None), None: ("", "", None), "http:///p": ("", "/p", None),
    }
    pages = spark.createDataFrame([(i, u, "<p>alpha beta</p>", "k") for i, u in enumerate(cases)] + [(None, "http://q.net/es/", None, "k")], "page_id long, url string, html string, host string")
    got = url_filter.judged(spark, pages, url_filter.UrlConfig(queries.URL_RULES)).collect()
    assert len(got) == len(cases) + 1
    by = {r.page_id: r for r in got}
    verdict = dict((rule, v) for v, rule in queries.URL_RULES)
    for i, (host, path, rule) in enumerate(cases.values()):
        assert (by[i].host, by[i].path, by[i].rule) == (host, path, rule)
        assert by[i].verdict == verdict[rule] if rule else by[i].verdict in ("allow", "block")
    assert by[None].verdict == "block"
    assert all(r.n_words > 0 for r in got if r.rule is None and r.verdict == "block")  # nothing is blocked by a prior
    assert url_filter.judged(spark, pages.where("false"), url_filter.UrlConfig(queries.URL_RULES)).collect() == []


def test_viterbi_is_the_best_split():
    counts, total = {"free": 50, "bets": 40, "bet": 60, "s": 5, "freeb": 1, "ets": 2}, 1000

    def cost(w):
        return np.log(counts[w] / total) if w in counts else np.log(10.0 / total) - len(w) * np.log(10.0)

    def splits(t):
        return [[t[:k], *r] for k in range(1, len(t) + 1) for r in (splits(t[k:]) if t[k:] else [[]])]

    for label in ("freebets", "betsfree", "xfreeq", "q"):
        seen = {(i, n): counts[label[i:i + n]] for i in range(len(label)) for n in range(1, len(label) - i + 1) if label[i:i + n] in counts}
        got = url_filter.viterbi(label, seen, total, 20)
        assert "".join(got) == label and sum(map(cost, got)) == pytest.approx(max(sum(map(cost, s)) for s in splits(label)))
    assert url_filter.viterbi("freebets", {(0, 4): 50, (4, 4): 40}, total, 20) == ["free", "bets"]


def test_segmented_words_decide(spark):
    good = [(i, f"http://green{'field' if i % 2 else 'house'}.com/a", None) for i in range(30)]
    bad = [(100 + i, f"http://pill{'shop' if i % 2 else 'store'}.net/es/b", None) for i in range(30)]
    text = "<p>" + "green field house pill shop store market " * 30 + "</p>"
    ask = [(900, "http://pillmarket.org/c", text), (901, "http://greenmarket.org/c", None)]
    pages = spark.createDataFrame(good + bad + ask, "page_id long, url string, html string")
    by = {r.page_id: r for r in url_filter.judged(spark, pages, url_filter.UrlConfig(queries.URL_RULES)).collect()}
    assert by[900].rule is None and (by[900].verdict, by[901].verdict) == ("block", "allow")


def test_host_words_decide_on_the_given_pages(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    cfg = url_filter.UrlConfig(queries.URL_RULES)
    whole = {r.page_id: r for r in url_filter.judged(spark, pages, cfg).collect()}
    paths = {r.page_id: r for r in url_filter.judged(spark, pages, dataclasses.replace(cfg, host_words=False)).collect()}
    free = [i for i, r in whole.items() if r.rule is None]
    assert {paths[i].verdict for i in free} == {"allow"}
    assert sum(whole[i].verdict == "block" for i in free) >= 5  # by their hosts' words alone
    assert all(whole[i].n_words > 0 for i in free if whole[i].verdict == "block")
    by_host = {}
    for i in free:
        by_host.setdefault(whole[i].host, set()).add(whole[i].verdict)
    assert {"allow"} in by_host.values() and {"block"} in by_host.values()  # hosts are judged apart
    plain = dataclasses.replace(cfg, seeds=())
    assert all(r.verdict == "allow" or r.n_words for r in url_filter.judged(spark, pages, plain).where("rule is null").collect())


def test_url_parts_and_rules_match_sql(spark):
    from harness import duck

    sf = "/root/testdata/sf0.01"
    parts = "regexp_extract(url, '://([^/?#]*)', 1) AS h, regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path"
    fits = lambda rule: "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '/{1}')".format(*rule.split("/", 1))
    longest = sorted(queries.URL_RULES, key=lambda r: -len(r[1]))
    case = lambda what: "CASE " + " ".join(f"WHEN {fits(r[1])} THEN '{what(r)}'" for r in longest) + " END"
    sql = f"""WITH u AS (SELECT page_id, {parts} FROM pages), v AS (SELECT page_id, translate(coalesce(h, ''), '{url_filter.UPPER}', '{url_filter.LOWER}') AS host, coalesce(path, '') AS path FROM u)
              SELECT page_id, host, path, {case(lambda r: r[1])} AS rule, {case(lambda r: r[0])} AS verdict FROM v"""
    want = {r[0]: r[1:] for r in duck(sf).execute(sql).fetchall()}
    got = queries.op4_url_filter(spark, sf).collect()
    assert len(got) == len(want)
    for r in got:
        host, path, rule, verdict = want[r.page_id]
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict == (verdict or r.verdict)


# ---------------------------------------------------------------- WARC


def _plan_nodes(node):
    yield node
    kids = node.children()
    for i in range(kids.size()):
        yield from _plan_nodes(kids.apply(i))


def test_writing_replicas_holds_each_page_once_in_sort_and_window(spark):
    pages = spark.createDataFrame([(i, f"http://h/{i}", "x" * i) for i in range(9)], "page_id long, url string, html string")
    payloads = {"a": warc_merkle.F.col("html"), "b": warc_merkle.F.concat("html", warc_merkle.F.lit("~"))}
    frame = warc_merkle.rolled(pages, warc_merkle.MerkleConfig(), payloads)
    plan = frame._jdf.queryExecution().optimizedPlan()
    held = []
    for node in _plan_nodes(plan):
        if node.nodeName() in ("Window", "Sort"):
            out = node.output()
            types = [(out.apply(i).name(), out.apply(i).dataType().simpleString()) for i in range(out.size())]
            assert all(t in ("string", "bigint", "int") for _, t in types), types  # no arrays of records
            held.append(sorted(n for n, t in types if t == "string" and not n.startswith("_w")))
    assert held == [["replica", "value"], ["html", "url"]]


def test_equal_ids_stand_in_order_of_their_records(spark):
    rows = [(1, "a", "x"), (1, "a\tb", "y"), (1, "a", "w"), (1, "a", "xx"), (1, None, None), (1, "", ""), (1, "a\r\nb", "z"), (None, "q", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = scratch_path(spark, "warc")
    warc_merkle.write_warc(pages, path, warc_merkle.MerkleConfig(shard_bytes=400))
    whole = {(r.shard, r.file): warc_merkle.unpacked(bytes(r.content)) for r in spark.read.format("binaryFile").option(
        "recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(path).select(
        warc_merkle.F.regexp_extract("path", r"shard=(-?\d+)", 1).alias("shard"), warc_merkle.F.regexp_extract("path", r"file=(\d+)", 1).alias("file"), "content").collect()}
    found = [raw[at:at + n] for key, raw in sorted(whole.items()) if key[0] == "0" for at, n, _ in warc_merkle.parse(raw)]
    assert len(found) == 7 and found == sorted(found)
    assert sorted(found) == sorted(
        ("WARC/1.0\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:1>\r\nWARC-Date: 2024-01-01T00:00:00Z\r\nWARC-Target-URI: "
         + (u or "").replace("\r\n", "") + f"\r\nContent-Type: text/html\r\nContent-Length: {len(t or '')}\r\n\r\n{t or ''}\r\n\r\n").encode()
        for i, u, t in rows if i == 1)


def test_audit_finds_exactly_the_damage(spark):
    pages = [(i, f"http://h/{i}", "<p>" + "x" * (i % 50) + "é</p>") for i in range(120)] + [(3, None, None), (None, "u\r\nv", "line\n\nline"), (7, "http://h/7", "WARC/1.0\r\ninside")]
    cfg = warc_merkle.MerkleConfig(shard_ids=50, fan=3)
    left, right = (spark.createDataFrame(p, "page_id long, url string, html string") for p in
                   (pages, [(i, u, "<p>gone</p>" if i == 63 else "<q>" + t[3:] if i in (0, 49, 50) else t) for i, u, t in pages]))
    a, b = scratch_path(spark, "warc"), scratch_path(spark, "warc")
    warc_merkle.write_warc(left, a, cfg)
    warc_merkle.write_warc(right, b, cfg)
    rows = warc_merkle.audited(spark, a, b, cfg).collect()
    assert len(rows) == len(pages) and sum(r.page_id is None for r in rows) == 1
    ours, theirs = warc_merkle.fixity(spark, a).collect(), warc_merkle.fixity(spark, b).collect()
    other = {(r.shard, r.file, r.seq): r.leaf for r in theirs}
    assert {(r.shard, r.seq) for r in rows if r.damaged} == {(r.shard, r.seq) for r in ours if other.get((r.shard, r.file, r.seq)) != r.leaf}
    assert {r.page_id for r in rows if r.damaged} >= {0, 49, 50, 63}
    assert not any(r.damaged for r in warc_merkle.audited(spark, a, a, cfg).collect())
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "part-*").load(a).collect()
    whole = b"".join(warc_merkle.unpacked(bytes(f.content)) for f in files)
    assert whole.count(b"WARC/1.0\r\nWARC-Type") == len(pages)
    plain = scratch_path(spark, "warc")
    warc_merkle.write_warc(left, plain, dataclasses.replace(cfg, compression="none"))
    assert not any(r.damaged for r in warc_merkle.audited(spark, a, plain, cfg).collect())
    empty = scratch_path(spark, "warc")
    warc_merkle.write_warc(left.where("false"), empty, cfg)
    assert warc_merkle.audited(spark, empty, empty, cfg).collect() == []


def test_audit_reports_records_that_only_one_replica_has(spark):
    cfg = warc_merkle.MerkleConfig(shard_ids=50, fan=3)
    pages = spark.createDataFrame([(i, f"http://h/{i}", "x" * (i % 9)) for i in range(170)], "page_id long, url string, html string")
    whole, part = scratch_path(spark, "warc"), scratch_path(spark, "warc")
    warc_merkle.write_warc(pages, whole, cfg)
    warc_merkle.write_warc(pages.where("page_id < 90 or page_id >= 150"), part, cfg)  # a shard cut off, the next one missing
    for a, b in ((part, whole), (whole, part)):
        rows = warc_merkle.audited(spark, a, b, cfg).collect()
        assert sorted(r.page_id for r in rows) == list(range(170))
        assert sorted(r.page_id for r in rows if r.damaged) == list(range(90, 150))
        assert all(r.sha256 and r.length > 0 for r in rows)


def test_files_are_rolled_by_bytes_and_nulls_spread(spark):
    pages = [(i, "u", "x" * (400 if i % 10 else 3000)) for i in range(100)] + [(None, f"n{i}", "y") for i in range(50)]
    cfg = warc_merkle.MerkleConfig(shard_bytes=5000, fan=2)
    a, b = scratch_path(spark, "warc"), scratch_path(spark, "warc")
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)
    warc_merkle.write_warc(df, a, cfg)
    warc_merkle.write_warc(df.where("page_id is null or page_id <> 50"), b, cfg)
    leaves = warc_merkle.fixity(spark, a).collect()
    sizes, last = {}, {}
    for r in leaves:
        sizes[(r.shard, r.file)] = sizes.get((r.shard, r.file), 0) + r.length
        last[(r.shard, r.file)] = max(last.get((r.shard, r.file), 0), r.length)
    assert len({f for s, f in sizes if s == 0}) > 5 and all(n - last[k] <= 5000 for k, n in sizes.items())
    assert len({r.shard for r in leaves if r.page_id is None}) > 10 and len(leaves) == 150
    assert [r.page_id for r in sorted((r for r in leaves if r.shard == 0), key=lambda r: (r.file, r.seq))] == list(range(100))
    rows = warc_merkle.audited(spark, a, b, cfg).collect()
    assert 50 in {r.page_id for r in rows if r.damaged} and not any(r.damaged for r in rows if r.page_id is not None and r.page_id < 40)


def test_audit_plan_does_not_grow(spark):
    leaf = lambda n: spark.range(n).selectExpr("id % 3 AS shard", "0 AS file", "id div 3 AS seq", "sha2(cast(id as string), 256) AS leaf")
    for n in (900, 20_000):
        a = leaf(n)
        b = a.withColumn("leaf", warc_merkle.F.when((warc_merkle.F.col("seq") == 77), "x").otherwise(a.leaf))
        found = warc_merkle.audit(spark, a, b)
        assert found._jdf.queryExecution().executedPlan().toString().count("Exchange") == 0  # each step was written
        assert sorted((r.shard, r.seq) for r in found.collect()) == [(0, 77), (1, 77), (2, 77)]


def test_a_broken_gzip_file_ends_at_the_damage():
    raw = gzip.compress(os.urandom(200_000))
    assert warc_merkle.unpacked(raw) == gzip.decompress(raw)
    hurt = raw[:100_000] + b"\xff" * 50 + raw[100_050:]
    assert 0 < len(warc_merkle.unpacked(hurt)) <= 200_000


def test_every_gzip_member_is_read():
    first, second = b"one" * 6, b"two" * 6
    whole = gzip.compress(first) + gzip.compress(second) + gzip.compress(b"")
    assert warc_merkle.unpacked(whole) == first + second
    big = [os.urandom(100_000) for _ in range(4)]
    assert warc_merkle.unpacked(b"".join(map(gzip.compress, big))) == b"".join(big)
    assert warc_merkle.unpacked(gzip.compress(first) + gzip.compress(second)[:-12]).startswith(first)


def test_parse_picks_up_after_a_broken_header():
    one = b"WARC/1.0\r\nWARC-Record-ID: <urn:page:1>\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    two = one.replace(b":1>", b":2>")
    assert [(o, n, i) for o, n, i in warc_merkle.parse(one + two)] == [(0, len(one), "1"), (len(one), len(two), "2")]
    broken = one.replace(b"Length: 3", b"Length: z")
    assert [i for _, _, i in warc_merkle.parse(broken + two)] == ["1", "2"]
    assert sum(n for _, n, _ in warc_merkle.parse(broken + two + b"rest")) == len(broken + two) + 4


# ---------------------------------------------------------------- queries and pipeline


def test_every_query_is_registered():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 14)] == [1] * 13 and "pipeline" in names
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_queries_match_sql(spark, name):
    from harness import compare, duck

    got = compare(spark, name, "/root/testdata/sf0.001", duck("/root/testdata/sf0.001"))
    assert got["check"] == "ok", got


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    lang = queries.op1_language_id(spark, sf).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r.lang == r.lang_pred for r in lang]) >= 0.98
    for query, label, least in ((queries.op3_quality, "quality", 0.95), (queries.op6_toxicity, "toxic", 0.9)):
        rows = query(spark, sf).where("held_out").join(labels, "doc_id").collect()
        assert np.mean([r[label] == r.predicted for r in rows]) >= least


def test_toxicity_stage_rejects_toxic_documents(spark):
    # Learnt on enough labels; with a few dozen, no gram is surely toxic and nothing is rejected.
    import corpus_pipeline as cp

    sf = "/root/testdata/sf0.01"
    kept = {r.doc_id for r in cp.toxicity(spark, cp.table(spark, sf, "documents"), sf).select("doc_id").collect()}
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    assert {i for i, t in toxic.items() if t == 0} <= kept
    assert np.mean([i not in kept for i, t in toxic.items() if t == 1]) >= 0.6


def test_pipeline_stages_match_brute_force(spark):
    import corpus_pipeline as cp
    from test_llm_texts import brute_groups, brute_hits, brute_removed

    sf = "/root/testdata/sf0.001"
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs = cp.table(spark, sf, "documents")
    extra = spark.createDataFrame([(None, None, None, None, None), (9_000_001, "", "en", "s", 0), (9_000_002, None, "en", "s", None)], docs.schema)
    docs = materialise(spark, docs.unionByName(extra).unionByName(docs.limit(1)), "docs")
    for name, stage in cp.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        after = materialise(spark, stage(spark, docs, sf), name)
        if name == "toxicity":
            judged = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
            kept = {r.doc_id for r in after.collect()}
            assert {i for i, t in judged.items() if t == 0} <= kept and {None, 9_000_001, 9_000_002} <= kept
            assert all(judged.get(i) != 0 for i, _ in set(before) - {(r.doc_id, r.text) for r in after.collect()})
        elif name == "near_dedup":
            group = brute_groups(before)
            assert sorted((r.doc_id for r in after.collect()), key=str) == sorted([i for i in group if group[i] == i] + [None], key=str)
        elif name == "substring_dedup":
            want = {i: (k if gone else dict(before)[i]) for i, n, gone, k in brute_removed(before, 50) if not gone or gone < n}
            assert {r.doc_id: r.text for r in after.collect()} == want
        elif name == "decontamination":
            assert {r.doc_id for r in after.collect()} == {i for i, t in before if not brute_hits(t, bench, 10)[1]}
        else:
            assert {r.doc_id for r in after.collect()} == {i for i, _ in before}
        if name != "packing":
            assert after.columns == list(cp.COLUMNS)
        docs = after


def folders(spark):
    root = scratch_root(spark)
    return set(os.listdir(root[len("file:"):] if root.startswith("file:") else root))


def test_scratch_scopes_remove_their_own_tables(spark):
    before = folders(spark)
    with scratch_scope(spark):
        outer = materialise(spark, spark.range(3).toDF("doc_id"), "outer")
        with pytest.raises(ValueError), scratch_scope(spark):
            materialise(spark, outer, "inner")
            scratch(spark, "never-written")
            raise ValueError
        assert len(folders(spark) - before) == 1 and outer.count() == 3
    assert folders(spark) == before
    kept = materialise(spark, spark.range(2).toDF("doc_id"), "kept")
    assert len(folders(spark) - before) == 1 and kept.count() == 2


def test_pipeline_leaves_its_stages_only(spark):
    import corpus_pipeline as cp

    before = folders(spark)
    out = cp.run(spark, "/root/testdata/sf0.001")
    left = sorted(name.rsplit("-", 1)[0] for name in folders(spark) - before)
    assert left == sorted(f"pipeline-{name}" for name, _ in cp.STAGES) and out.count() > 0
