"""Dictionary segmentation against all segmentations, and learning against direct counts."""

import itertools
import math
import random

from murmur.operators import features, segment, spam

from conftest import SF0001

WORDS = [("中国", 40), ("国人", 9), ("中", 30), ("人", 25), ("人民", 30), ("民", 3), ("中国人", 12), ("大会", 20), ("会", 8), ("大", 8)]


def all_segmentations(run, words):
    """The best of all cuts of a short run, by the same probabilities; ties as documented."""
    total = sum(n for _, n in words)
    logp = {w: math.log(n / total) for w, n in words}
    best = None
    for r in range(len(run)):
        for inner in itertools.combinations(range(1, len(run)), r):
            cut = [(a, b) for a, b in zip((0, *inner), (*inner, len(run)))]
            if any(run[a:b] not in logp and b - a > 1 for a, b in cut):
                continue
            p = sum(logp.get(run[a:b], math.log(segment.UNKNOWN / total)) for a, b in cut)
            key = (round(p, 9), [a - b for a, b in cut[::-1]])
            if best is None or key[0] > best[0][0] or key[0] == best[0][0] and key[1] < best[0][1]:
                best = key, [run[a:b] for a, b in cut]
    return best[1] if best else []


def frames(spark, runs):
    words = spark.createDataFrame(WORDS, "word string, n long")
    df = spark.createDataFrame([(i, r) for i, r in enumerate(runs)], "id long, runs array<string>")
    return df, words


def test_segments_equal_all_segmentations_by_trie_and_by_join(spark):
    rng = random.Random(3)
    runs = ["".join(rng.choice("中国人民大会x") for _ in range(rng.randrange(0, 9))) for _ in range(150)]
    df, words = frames(spark, [[r] for r in runs] + [None, [], ["中国人民", "大会"]])
    want = {i: all_segmentations(r, WORDS) for i, r in enumerate(runs)}
    want |= {150: None, 151: [], 152: all_segmentations("中国人民", WORDS) + all_segmentations("大会", WORDS)}
    for max_words in (None, 3):
        got = {r["id"]: r["segments"] for r in segment.segment_runs(df, words, df["runs"], max_words=max_words).collect()}
        assert got == want


def test_learnt_words_by_direct_counts(spark):
    rng = random.Random(4)
    lexicon = ["甲乙", "丙丁戊", "己庚"]
    texts = ["".join(rng.choice(lexicon + list("一二三四五六")) for _ in range(40)) for _ in range(60)] + [None, "", "abc"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = {r["word"]: r for r in segment.learn(df, max_len=3, min_count=5, min_cohesion=1.5, min_entropy=1.0).collect()}
    assert set(lexicon) == set(got)
    joined = [t for t in texts if t and t != "abc"]
    for w, r in got.items():
        assert r["n"] == sum(t[i:].startswith(w) for t in joined for i in range(len(t)))
        n = sum(map(len, joined))
        count = lambda g: sum(t[i:].startswith(g) for t in joined for i in range(len(t)))
        assert r["cohesion"] == round(min(math.log(r["n"] * n / (count(w[:c]) * count(w[c:]))) for c in range(1, len(w))), 6)
        after = [t[i + len(w):i + len(w) + 1] for t in joined for i in range(len(t)) if t[i:].startswith(w)]
        h = -sum(after.count(c) / len(after) * math.log(after.count(c) / len(after)) for c in set(after))
        assert abs(r["right_entropy"] - h) < 2e-6


def test_grams_are_counted_once_from_the_longest_at_each_position(spark, monkeypatch):
    """Letters beyond the basic plane are whole, short ends count, and the texts are read for one table of grams only."""
    seen = []
    kept = segment.stored
    monkeypatch.setattr(segment, "stored", lambda df, name: seen.append((name, kept(df, name))) or seen[-1][1])
    texts = ["\U00020000\U00020001ab", "b\U00020000", "ab"] * 3
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    words = segment.learn(df, run="\\p{L}+", max_len=2, min_count=1, min_cohesion=-99.0, min_entropy=-99.0)
    want = {}
    for t in texts:
        t = segment.START + t + segment.END
        for i in range(len(t)):
            for k in range(1, min(3, len(t) - i) + 1):
                want[t[i:i + k]] = want.get(t[i:i + k], 0) + 1
    assert {r["gram"]: r["n"] for r in seen[0][1].collect()} == want
    assert "regexp_extract_all" not in words._jdf.queryExecution().optimizedPlan().toString()


def test_empty_dictionary_and_texts(spark):
    words = spark.createDataFrame([], "word string, n long")
    df = spark.createDataFrame([(1, "中国 ab x"), (2, None), (3, " ")], "id long, text string")
    got = {r["id"]: r["words"] for r in segment.segmented_tokens(df, words).collect()}
    assert got == {1: ["ab"], 2: [], 3: []}
    assert segment.learn(df.limit(0)).count() == 0


def test_dictionary_feeds_the_spam_features(spark):
    words = spark.createDataFrame(WORDS, "word string, n long")
    df = spark.createDataFrame([(1, "中国人民 hello 大会", 1, 2, 3)], "id long, text string, reposts_count int, comments_count int, attitudes_count int")
    assert features.tokenize(df, dictionary=words).first()["words"] == ["hello", *[w for w in all_segmentations("中国人民", WORDS) if len(w) > 1], "大会"]
    assert spam.spam_features(df, dictionary=words).first()["words"] == features.tokenize(df, dictionary=words).first()["words"]
    plain = features.tokenize(df).first()["words"]
    assert "国人" in plain


def test_query_covers_every_letter(spark):
    from murmur.plans import catalog
    out = catalog.queries()["segment_words"](spark, SF0001).toPandas()
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").toPandas().set_index("doc_id").text
    assert len(out) == len(docs)
    for r in out.itertuples():
        assert r.words.replace(" ", "") == "".join(c for c in docs[r.doc_id] if c.isalpha())
        assert r.n_words == len(r.words.split(" ")) if r.words else r.n_words == 0
