"""Operators on several rows: similarity join, decontamination, WARC, chat, pipeline, oracles."""

import hashlib
import io
import os
import random
import re
from collections import defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from murmur.llm import chat, decontam, jaccard_join, queries, warc
from murmur.llm.shingles import fingerprint, shingle_sets

SF0001 = "/root/testdata/sf0.001"
DOC = "doc_id long, text string"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_queries_equal_their_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "embeddings"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF0001}/{t}.parquet'")
    want = con.sql(queries.oracle_sql()[name])
    got = queries.queries()[name](spark, SF0001)
    assert got.columns == want.columns
    assert rows(got, "*") == sorted(want.fetchall(), key=repr)


# -- similarity join

def shingles(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words[i:i + 4]) for i in range(max(1, len(words) - 3))} if words else set()


def direct_components(texts):
    sets = [shingles(t) for t in texts]
    comp = list(range(len(texts)))

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                u, v = root(i), root(j)
                comp[max(u, v)] = min(u, v)
    return [root(i) for i in range(len(sets))], [len(s) for s in sets]


def near_copies(seed, originals=12, copies=14):
    """Originals with copies that have 0 to 8 % of their words changed, so that many pairs lie around the threshold."""
    rng, texts = random.Random(seed), [None, "", " \n", "one", "One", "two words", "a b c", "a b c", "a  b\tc d", "A b c d"]
    shared = [f"s{i}" for i in range(55)]
    for _ in range(originals):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.choice([5, 7, 8, 20, 60, 150, 400]))]
        if rng.random() < 0.4:
            base += shared
        for _ in range(copies):
            words, rate = list(base), rng.choice([0, 0.01, 0.02, 0.03, 0.05, 0.08])
            for i in range(len(words)):
                if rng.random() < rate:
                    words[i] = f"x{rng.randrange(10_000)}"
            texts.append(" ".join(words).upper() if rng.random() < 0.1 else " ".join(words))
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("seed", [1, 2])
def test_join_equals_all_pairs(spark, seed, monkeypatch):
    monkeypatch.setattr(jaccard_join, "MINOR_BLOCK", 2)             # several blocks in a bucket
    monkeypatch.setattr(jaccard_join, "OTHER_BLOCK", 5)
    texts = near_copies(seed)
    comp, sizes = direct_components(texts)
    df = spark.createDataFrame(list(enumerate(texts)), DOC).repartition(5)
    got = {r.key: (r.n_shingles, r.component_id) for r in jaccard_join.join(df).collect()}
    assert got == {i: (sizes[i], comp[i]) for i in range(len(texts))}
    kept = {r.doc_id for r in jaccard_join.deduplicate(df).collect()}
    assert kept == {i for i in range(len(texts)) if comp[i] == i}


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(4)
    for size in (6, 7, 13, 40, 90, 255, 300, 900, 3000):
        for _ in range(25):
            a = rng.integers(0, 1 << 63, size, dtype=np.uint64)
            union = int(100 * size // 85)
            drop, add = rng.integers(0, max(1, size * 15 // 100) + 1), 0
            b = np.concatenate([a[drop:], rng.integers(0, 1 << 63, int(rng.integers(0, union - size + 1)), dtype=np.uint64)])
            both = size - drop
            if 100 * both < 85 * (size + len(b) - both) or drop == add == 0 and len(b) == size:
                continue
            sets = [np.unique(a), np.unique(b)]
            sig, owner = jaccard_join.signatures(sets)
            assert set(sig[owner == 0]) & set(sig[owner == 1]), (size, drop, len(b))


def test_shingle_sets_sizes_and_sketches():
    texts = near_copies(7)[:80] + ["é  ü\x0bß x\x1cy z a b"]
    sets = list(shingle_sets(pa.array(texts, pa.string())))
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    assert [fingerprint(s) for s in shingle_sets(pa.array(texts, pa.string()).slice(3, 9))] == [fingerprint(s) for s in sets[3:12]]
    for a, b in zip(sets, sets[1:]):
        assert jaccard_join._apart(jaccard_join.sketch(a), jaccard_join.sketch(b)) <= len(np.setxor1d(a, b))


def test_sketches_of_long_sets():
    """Never more apart than the sets differ, at any two lengths, and far apart for unrelated sets."""
    rng = np.random.default_rng(5)
    for size in (900, 1100, 2049, 5000, 40_000):
        a = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        assert jaccard_join._fold(np.frombuffer(jaccard_join.sketch(a), dtype=np.uint64), 16).tobytes() == jaccard_join.sketch(a, 1024)
        for changed in (0, 1, size // 20, size // 3):
            b = np.unique(np.concatenate([a[changed:], rng.integers(0, 1 << 63, changed // 2, dtype=np.uint64)]))
            assert jaccard_join._apart(jaccard_join.sketch(a), jaccard_join.sketch(b)) <= len(np.setxor1d(a, b))
        other = np.unique(rng.integers(0, 1 << 63, size, dtype=np.uint64))
        apart = np.array([jaccard_join._apart(jaccard_join.sketch(a), jaccard_join.sketch(other))])
        n = np.array([size])
        assert not jaccard_join._may_link(apart, n, n, 80)[0]


@pytest.mark.parametrize("threshold, k", [(80, 5), (85, 4)])
def test_few_sets_sign_empty_subsets(threshold, k):
    """An agreement of empty partitions alone must stay rare, or unrelated sets of a band become candidates."""
    con = duckdb.connect()
    texts = con.sql("SELECT text FROM '/root/testdata/sf0.01/documents.parquet'").arrow()
    texts = texts.read_all() if hasattr(texts, "read_all") else texts
    sets = {fingerprint(s): s for s in shingle_sets(texts.column(0).combine_chunks(), k) if len(s) > 20}
    sets = list(sets.values())
    sig, owner = jaccard_join.signatures(sets, threshold)
    order = np.argsort(sig, kind="stable")
    pairs = set()
    for run in np.split(owner[order], np.flatnonzero(np.diff(sig[order])) + 1):
        nodes = sorted(set(run.tolist()))
        pairs |= {(x, y) for i, x in enumerate(nodes) for y in nodes[i + 1:]}
    strangers = sum(not len(np.intersect1d(sets[x], sets[y])) for x, y in pairs)
    assert strangers <= len(sets) * 0.02, (strangers, len(pairs), len(sets))


def test_stranger_in_a_bucket_of_copies_costs_no_pairs_of_copies(spark):
    """Candidates of a bucket with one large component and a stranger: the stranger's own pairs only."""
    nodes = list(range(1, 402))
    buckets = spark.createDataFrame([(9, i, 1) for i in nodes], "sig long, node long, first long")
    comp = spark.createDataFrame([(i, 1) for i in nodes[:-1]] + [(401, 401)], "node long, comp long")
    s = np.arange(500, dtype=np.uint64)
    sets = spark.createDataFrame([(i, 500, jaccard_join.sketch(s, 1024)) for i in nodes], "node long, n long, short binary")
    got = jaccard_join._block_pairs(buckets, sets, comp, 80).collect()
    assert {(r.a, r.b) for r in got} == {(i, 401) for i in range(2, 401)}


def test_join_frames(spark):
    data = [(3, "a b c d e", 1), (3, "a b c d e", 1), (None, "A b c d e", 2), (None, None, 3), (4, "", 4), (2, "long " * 50_000, 5)]
    df = spark.createDataFrame(data, "doc_id long, text string, n int")
    assert rows(jaccard_join.join(df), "key", "n_shingles", "component_id") == sorted(
        [(3, 2, 3), (3, 2, 3), (None, 2, 3), (None, 0, None), (4, 0, 4), (2, 1, 2)], key=repr)
    assert rows(jaccard_join.deduplicate(df), "doc_id", "n") == sorted([(3, 1), (None, 3), (4, 4), (2, 5)], key=repr)
    assert jaccard_join.join(df.limit(0)).count() == jaccard_join.deduplicate(df.limit(0)).count() == 0


def test_components_of_chains_stars_and_noise(spark):
    rng = random.Random(6)
    edges = ([(rng.randrange(300), rng.randrange(300)) for _ in range(160)] + [(i + 1, i) for i in range(1000, 1100)]
             + [(2000, i) for i in range(2001, 2060)])
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    got = {r.node: r.comp for r in jaccard_join.components(spark.createDataFrame(edges, "a long, b long").repartition(7)).collect()}
    assert got == {x: root(x) for a, b in edges if a != b for x in (a, b)}


# -- decontamination

def test_decontamination_cases(spark):
    passage = " ".join(f"q{i}" for i in range(15))
    bench = spark.createDataFrame([(10, passage), (9, "Short  item"), (8, None), (7, "..."), (6, passage), (None, "lone")], "item_id long, text string")
    clean = " ".join(f"z{i}" for i in range(400))
    data = [(1, f"x {passage.upper()}!", 5), (2, clean, 5), (2, clean, 5), (3, f"{clean} {passage}", 5), (4, "a short-item b", 5), (None, None, 5),
            (5, "", 5), (6, f"{passage} {clean} {passage} lone {clean}", 5)]
    docs = spark.createDataFrame(data, "doc_id long, text string, words int")
    got = decontam.contamination(docs, bench).select("key", "n_words", "n_hit", "items", "contaminated")
    assert rows(got, "*") == sorted([
        (1, 16, 15, ["10", "6"], True), (2, 400, 0, [], False), (2, 400, 0, [], False), (3, 415, 15, ["10", "6"], False),
        (4, 4, 2, ["9"], True), (None, 0, 0, [], False), (5, 0, 0, [], False), (6, 831, 31, ["10", "6"], False)], key=repr)
    kept = decontam.decontaminate(docs, bench)
    assert kept.columns == docs.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 2, 2, 3, 5, 6]
    spans = {r.doc_id: r.text for r in decontam.decontaminate(docs, bench, remove="spans").collect()}
    assert spans[1] == "x" and spans[4] == "a b" and spans[3] == f"{clean} {passage}" and spans[2] == clean
    assert decontam.contamination(docs, bench, max_windows=0).count() == 8                  # by a shuffle
    assert rows(decontam.contamination(docs, bench, max_windows=0).select("key", "n_hit"), "*") == rows(got.select("key", "n_hit"), "*")
    assert decontam.contamination(docs, bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontam.contamination(docs.limit(0), bench).count() == 0


# -- WARC

def make_records(n=60):
    rng = random.Random(1)
    inner = b"".join(warc.record(str(i), None, "0" * 64, 3, b"abc", None) for i in range(3))
    out = []
    for i in range(n):
        p = rng.choice([b"", b"x" * 200, rng.randbytes(5000), inner + rng.randbytes(50), inner * 5, b"<html>" * 1000])
        out.append(warc.record(str(i), "http://a/\r\nb", hashlib.sha256(p).hexdigest(), len(p), p, None))
    return out


@pytest.mark.parametrize("split", [7, 100, 1000, 4096, 1 << 20])
def test_every_record_is_owned_by_one_split(split):
    data = b"".join(make_records())
    got = [x for s in range(0, len(data), split) for x in warc.records_of(io.BytesIO(data), len(data), s, s + split)]
    assert [warc.parse(x)["warc-record-id"] for x in got] == [f"<urn:page:{i}>" for i in range(60)]


def test_records_are_plain_gzip_members_and_damage_is_noticed():
    import gzip
    data = b"".join(make_records(5))
    assert gzip.decompress(data).count(b"WARC/1.1\r\n") >= 5
    with pytest.raises(ValueError):
        list(warc.records_of(io.BytesIO(data[:-20]), len(data) - 20, 0, len(data)))


def test_warc_frames(spark):
    big = "<p>é</p>" * 400_000
    data = [(5, "u", "y" * 100, 1), (2, None, "y" * 100, 1), (2, "w", "y" * 100, 1), (9, "u", "y" * 99, 1), (8, "u", "y" * 99, 1), (None, "u", None, 1),
            (None, "u", "y" * 100, 1), (7, "http://x/ü\r\nz", big, 1)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string, payload int")
    got = warc.archive_and_read(pages)
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    want = [(str(p), len((t or "").encode()), sha(t), "revisit" if t == "y" * 100 and p != 2 else "response", "2" if t == "y" * 100 and p != 2 else None)
            for p, _, t, _ in data]
    assert rows(got, "page", "payload_bytes", "payload_digest", "record_type", "refers_to") == sorted(want, key=repr)
    assert got.where("page = '7'").first().payload.decode() == big
    assert warc.archive_and_read(pages.limit(0)).count() == 0


def test_archives_are_read_by_a_task_for_each_range(spark):
    pages = spark.createDataFrame([(i, "u", os.urandom(3000).hex()) for i in range(40)], "page_id long, url string, html string")
    from murmur.session import scratch_path
    manifest = warc.write(pages, f"file://{scratch_path(spark, 'warc-test')}")
    out = warc.read(manifest, split=8192)
    size = manifest.agg(F.sum(F.ceil(F.col("bytes") / 8192))).first()[0]
    assert size > 8 and out.rdd.getNumPartitions() == size
    assert out.select("page").distinct().count() == out.count() == 40


def test_archives_of_other_writers(spark, tmp_path):
    import base64
    import gzip
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\n\r\n"
    page = b"<html>hello</html>" * 10
    sha1 = "sha1:" + base64.b32encode(hashlib.sha1(page).digest()).decode()

    def rec(kind, name, body, *extra):
        head = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:uuid:{name}>", *extra, f"Content-Length: {len(body)}"]
        return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + body + b"\r\n\r\n")

    web = "Content-Type: application/http;msgtype=response"
    parts = [rec("warcinfo", "i", b"software: x\r\n", "Content-Type: application/warc-fields"), rec("request", "q", b"GET / HTTP/1.1\r\n\r\n", web),
             rec("response", "r", http + page, web, f"WARC-Payload-Digest: {sha1}", "WARC-Target-URI: http://a/"),
             rec("revisit", "v", http, web, f"WARC-Payload-Digest: {sha1}", "WARC-Refers-To: <urn:uuid:r>"), rec("conversion", "c", b"hello")]
    (tmp_path / "a.warc.gz").write_bytes(b"".join(parts))
    manifest = spark.createDataFrame([(f"file://{tmp_path}/a.warc.gz", len(b"".join(parts)))], "path string, bytes long")
    got = {r.page: (r.record_type, r.payload_bytes, r.payload_digest, r.refers_to, r.url) for r in warc.read(manifest, split=100).collect()}
    sha = lambda x: hashlib.sha256(x).hexdigest()
    assert got == {"urn:uuid:i": ("warcinfo", 13, sha(b"software: x\r\n"), None, None), "urn:uuid:q": ("request", 0, sha(b""), None, None),
                   "urn:uuid:r": ("response", 180, sha(page), None, "http://a/"), "urn:uuid:v": ("revisit", None, sha1, "urn:uuid:r", None),
                   "urn:uuid:c": ("conversion", 5, sha(b"hello"), None, None)}
    wrong = rec("response", "r", http + page + b"x", web, f"WARC-Payload-Digest: {sha1}")
    assert not warc.agrees(sha1, page + b"x") and warc.agrees(None, page) and wrong


# -- chat

def test_chat_digests_equal_the_conversations(spark):
    said = "</s>[INST] ok [/INST]"
    turns = [tuple(r) for r in spark.read.parquet(f"{SF0001}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    by = defaultdict(list)
    for c, t, r, x in turns + [(-7, 0, "user", said), (-7, 1, "assistant", said)]:
        by[c].append((t, r, x or ""))
    got = {r.conv_id: r for r in queries.op10_chat_format(spark, SF0001).collect()}
    assert got.keys() == by.keys()
    for c, v in by.items():
        v.sort()
        loss = "".join(x for _, r, x in v if r == "assistant")
        assert (got[c].n_turns, got[c].loss_chars) == (len(v), len(loss))
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in v).encode()).hexdigest()
        assert got[c].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()


def test_chat_windows_budget_context_and_loss(spark):
    data = [(1, 0, "system", "be nice")] + [(1, t, "user" if t % 2 else "assistant", f"turn {t} " + "w " * (t % 9)) for t in range(1, 200)]
    out = sorted(chat.windows(spark.createDataFrame(data, "conv_id long, turn long, role string, text string"), budget=120, history=30).collect(),
                 key=lambda r: r.window)
    assert len(out) > 5 and max(r.tokens for r in out) <= 120
    targets, loss = [], []
    for k, r in enumerate(out):
        turns = chat.parse(r.formatted)
        assert turns[0] == ("system", "be nice")
        targets += turns[r.n_repeated:]
        assert r.n_repeated >= (2 if k else 0) and all(turns[i] in targets for i in range(r.n_repeated))
        loss += [chat.unescape(r.formatted[s.start:s.end]) for s in r.loss]
    assert targets == [(r, x) for _, _, r, x in data]
    assert loss == [x for _, _, r, x in data if r == "assistant"]


@given(st.lists(st.sampled_from([*"<>/s[]INST\\.n|turend_", "</s>", "[INST]", "<|turn|>", "<|end|>\n"]), max_size=25).map("".join))
def test_chat_escape_in_python_terms(text):
    control = re.compile(chat._CONTROL)
    escaped = re.sub(rf"(?s)(?={chat._CONTROL})(.)", lambda m: m[1] + "\\.", text.replace("\\", "\\\\"))
    assert not control.search(escaped) and chat.unescape(escaped) == text


def test_chat_frames(spark):
    odd = "a\\.b \\\\ <s></s> <|turn|>x\n<|end|>\n [/INST] <<SYS>>"
    data = [(1, None, None, None, 1), (1, 3, "assistant", odd, 1), (1, 3, "assistant", odd, 1), (None, 1, "us<s>er\nx", odd, 1), (2, 0, "system", "s" * 50_000, 1),
            (2, 1, "assistant", "word " * 20_000, 1)]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, window int")
    got = {r.conv: r for r in chat.digest(chat.windows(df)).collect()}
    want = {1: [("", ""), ("assistant", odd), ("assistant", odd)], None: [("us<s>er\nx", odd)], 2: [("system", "s" * 50_000), ("assistant", "word " * 20_000)]}
    assert got.keys() == want.keys()
    for c, v in want.items():
        assert got[c].n_turns == len(v)
        assert got[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{x}\n" for r, x in v).encode()).hexdigest()
        assert got[c].loss_chars == sum(len(x) for r, x in v if r == "assistant")
    assert not any(c in r.formatted for r in chat.windows(df).collect() for c in chat.CONTROLS)
    assert chat.digest(chat.windows(df.limit(0))).count() == 0


# -- pipeline

def test_pipeline_stages(spark, tmp_path):
    sf = str(tmp_path)
    filler = [" ".join(f"t{i}w{(j * 7) % (30 + i % 13)}x{j}" for j in range(60)) for i in range(60)]
    bench = " ".join(f"b{i}" for i in range(20))
    docs = [(i, t, "en", "s", len(t)) for i, t in enumerate(filler)]
    docs += [(100 + i, f"{t} vermin vermin filth", "en", "s", 0) for i, t in enumerate(filler[:40])]
    docs += [(200, filler[5], "en", "t", 1), (200, filler[5], "en", "t", 1), (201, filler[6] + " more", None, None, None), (202, bench, "en", "s", 2),
             (203, None, None, None, None), (204, "# # # # # # # # # # # # $ $ $", "en", "s", 3), (None, filler[7][::-1], "en", "s", 4)]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(docs, kind).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    labels = [(i, 1, int(i >= 100)) for i in [*range(60), *range(100, 140)]]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    now = spark.read.parquet(f"{sf}/documents.parquet")
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        now = stage(spark, now, sf)
        path = f"{sf}/{len(seen)}"
        now.write.parquet(path)
        now = spark.read.parquet(path)
        seen.append(now)
        if name != "sentencepiece":
            assert now.columns == [c.split()[0] for c in kind.split(", ")]
    ids = [sorted((r.doc_id for r in d.select("doc_id").collect()), key=lambda x: -1 if x is None else x) for d in seen]
    plain = list(range(60))
    assert ids[0] == [None, *plain, 200, 200, 201, 202, 203, 204]
    assert ids[1] == [None, *plain, 200, 200, 201, 202]
    assert ids[2] == [None, *plain, 202]
    assert ids[3] == ids[4] == [None, *plain]
    assert seen[4].where("NOT round_trip").count() == 0
    assert [tuple(r) for r in corpus_pipeline.run(spark, sf).select("doc_id", "n_tokens").orderBy("doc_id").collect()] == [
        tuple(r) for r in seen[4].select("doc_id", "n_tokens").orderBy("doc_id").collect()]
    empty = f"{sf}/empty"
    for t, k in (("documents", kind), ("benchmark", "item_id long, text string"), ("labels", "doc_id long, quality int, toxic int")):
        spark.createDataFrame([], k).write.parquet(f"{empty}/{t}.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_pipeline_drops_near_copies_from_0_80(spark):
    rng, texts = random.Random(9), []
    for _ in range(60):
        base = [f"w{rng.randrange(5000)}" for _ in range(rng.choice([60, 200, 460]))]
        if rng.random() < 0.5:          # words appended, or scattered words changed: similarities from about 0.76 to 0.87
            copy = base + [f"x{rng.randrange(5000)}" for _ in range(round(len(base) * rng.uniform(0.15, 0.31)))]
        else:
            copy = list(base)
            for i in rng.sample(range(len(base)), max(1, round(len(base) * rng.uniform(0.014, 0.028)))):
                copy[i] = f"x{rng.randrange(5000)}"
        texts += [" ".join(base), " ".join(copy)]
    want, between = set(range(len(texts))), 0
    for i in range(0, len(texts), 2):
        a, b = ({tuple(w[j:j + 5]) for j in range(len(w) - 4)} for w in (texts[i].split(), texts[i + 1].split()))
        if 100 * len(a & b) >= 80 * len(a | b):
            want.remove(i + 1)
            between += 100 * len(a & b) < 85 * len(a | b)
    assert between > 10 and len(want) > len(texts) // 2 + 3
    kept = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(list(enumerate(texts)), DOC), "")
    assert {r.doc_id for r in kept.collect()} == want


def test_nothing_else_imports_this_subpackage():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    for folder, _, names in os.walk(os.path.join(root, "murmur")):
        if "llm" not in folder:
            for n in names:
                if n.endswith(".py"):
                    assert "murmur.llm" not in open(os.path.join(folder, n)).read()
