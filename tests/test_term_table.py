"""Term tables against a plain search of every term at every position."""

import random
import re

import pytest
from pyspark.sql import functions as F

from murmur.operators import term_table as TT


def _brute(texts, terms, split):
    want = {}
    for i, text in texts:
        u = split(text or "")
        for t in {t for t in terms if t and split(t)}:
            w = split(t)
            n = sum(u[k:k + len(w)] == w for k in range(len(u) - len(w) + 1))
            if n:
                want[i, t] = want.get((i, t), 0) + n
    return want


def _got(spark, texts, terms, **kw):
    out = TT.term_hits(spark.createDataFrame(texts, "id long, text string"), spark.createDataFrame([(t, 1) for t in terms], "term string, n int"), **kw)
    return {(r["id"], r["term"]): r["n"] for r in out.collect()}


@pytest.mark.parametrize("seed,broadcast", [(1, TT.BROADCAST_BYTES), (2, 0)])
def test_words_in_long_and_short_texts(spark, seed, broadcast):
    rng = random.Random(seed)
    voc = ["a", "b", "Ä", "д1", "long"]
    texts = [(i, " ".join(rng.choice(voc) for _ in range(n))) for i, n in enumerate([0, 1, 2, 7, 40, TT.BLOCK - 1, TT.BLOCK, TT.BLOCK + 1, 3 * TT.BLOCK + 5])]
    texts += [(3, "a, b; a"), (None, "b b b"), (20, None), (21, " .,!")]
    terms = [" ".join(rng.choice(voc) for _ in range(n)) for n in (1, 2, 3, 4, 5, 8, 9, 17) for _ in range(6)]
    terms += [terms[0], None, "", "...", "b b", "absent here"]
    split = lambda x: re.findall(r"[^\W_]+", x)
    assert _got(spark, texts, terms, broadcast_bytes=broadcast) == _brute(texts, terms, split)


@pytest.mark.parametrize("broadcast", [TT.BROADCAST_BYTES, 0])
def test_characters_across_block_ends_and_beyond_the_basic_plane(spark, broadcast):
    rng = random.Random(5)
    texts = [(i, "".join(rng.choice("ab好😀\n") for _ in range(n))) for i, n in enumerate([3, 600, 1500])]
    terms = ["a", "aa", "aba", "好😀", "😀", "\n", "b\na", "abab好"] + [texts[2][1][k:k + 11] for k in (0, 505, 1017, 1489)]
    got = _got(spark, texts, terms, units=TT.characters, broadcast_bytes=broadcast)
    assert got == _brute(texts, terms, list)
    assert all((2, t) in got for t in terms[-4:])


def test_empty_tables_and_other_columns(spark):
    texts = spark.createDataFrame([(1, "a b", "x")], "id long, text string, term string")
    terms = spark.createDataFrame([("a b", 7)], "term string, id int")
    assert [tuple(r) for r in TT.term_hits(texts, terms).collect()] == [(1, "a b", 1)]
    assert TT.term_hits(texts, terms.limit(0)).count() == TT.term_hits(texts.limit(0), terms).count() == 0
    assert [tuple(r) for r in TT.term_totals(TT.term_hits(texts.union(texts), terms)).collect()] == [("a b", 1, 2)]


def test_a_term_table_has_one_group_per_power_of_two(spark):
    terms = spark.createDataFrame([(" ".join("w" * n),) for n in range(1, 32)], "term string")
    t = TT.term_table(terms)
    assert {r["lead"] for r in t.select("lead").distinct().collect()} == {1, 2, 4, 8, 16}
    assert t.where((F.col("lead") > F.col("size")) | (2 * F.col("lead") <= F.col("size"))).count() == 0


def test_a_large_table_is_joined_with_one_row_a_text_and_gram(spark):
    """No n-gram is shuffled more than once a text, and few that are no term are shuffled at all."""
    texts = spark.createDataFrame([(i, f"the x{i} the y the the") for i in range(50)], "id long, text string")
    terms = spark.createDataFrame([(t,) for t in ["the", "the y the", "absent"]], "term string")
    hits = TT.term_hits(texts, terms, broadcast_bytes=0)
    plan = hits._jdf.queryExecution().executedPlan().toString()
    assert "salt" not in plan and "seen" not in plan
    assert plan.count("hashpartitioning(gram") == plan.count("hashpartitioning(") == 1
    totals = {r["term"]: (r["n_texts"], r["n_hits"]) for r in TT.term_totals(hits).collect()}
    assert totals == {"the": (50, 200), "the y the": (50, 50)}


def test_a_full_bitmap_lets_through_and_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(TT, "MOST_BITS", 1 << 16)
    texts = [(1, "a b c d a b"), (2, "c d")]
    terms = [f"w{i}" for i in range(20_000)] + ["a b", "d", "c d a"]
    assert _got(spark, texts, terms, broadcast_bytes=0) == {(1, "a b"): 2, (1, "d"): 1, (1, "c d a"): 1, (2, "d"): 1}


def _random_texts(seed):
    rng = random.Random(seed)
    voc = ["a", "b", "Ä", "д1", "long"]
    texts = [(i, " ".join(rng.choice(voc) for _ in range(n))) for i, n in enumerate([0, 1, 2, 7, 40, TT.BLOCK, TT.BLOCK + 1, 3 * TT.BLOCK + 5, 11, 12])]
    terms = [" ".join(rng.choice(voc) for _ in range(n)) for n in (1, 2, 3, 5, 9) for _ in range(6)]
    return texts, terms + [None, "", "...", "a, b", "a b", "absent here"]


@pytest.mark.parametrize("units, cells, few", [(1 << 18, 1 << 23, 10), (30, 40, 10), (30, 40, 0)])
def test_totals_without_a_row_a_text(spark, monkeypatch, units, cells, few):
    """Runs of few units, few sums at a time; ids that come twice and are null count once."""
    monkeypatch.setattr(TT, "UNITS", units)
    monkeypatch.setattr(TT, "CELLS", cells)
    monkeypatch.setattr(TT, "FEW_IDS", few)
    texts, terms = _random_texts(3)
    texts += [(3, "a, b; a"), (None, "b b b"), (None, "b a"), (20, None), (21, " .,!")]
    df, tt = spark.createDataFrame(texts, "id long, text string").coalesce(2), spark.createDataFrame([(t,) for t in terms], "term string")
    want = {}
    for (_, t), n in _brute(texts, terms, lambda x: re.findall(r"[^\W_]+", x)).items():
        want[t] = (want.get(t, (0, 0))[0] + 1, want.get(t, (0, 0))[1] + n)
    got = {r["term"]: (r["n_texts"], r["n_hits"]) for r in TT.text_totals(df, tt).collect()}
    assert got == want
    assert TT.text_totals(df.limit(0), tt).count() == TT.text_totals(df, tt.limit(0)).count() == 0


@pytest.mark.parametrize("units, cells", [(1 << 18, 1 << 23), (30, 40)])
def test_hits_of_groups(spark, monkeypatch, units, cells):
    monkeypatch.setattr(TT, "UNITS", units)
    monkeypatch.setattr(TT, "CELLS", cells)
    texts, terms = _random_texts(4)
    groups = lambda i: [(200 * k - 100 if k else None, 100 * k + 1) for k in range(i % 4)]
    rows = [(i, text, groups(i)) for i, text in texts] + [(3, "a b a", groups(2)), (None, "b", groups(3)), (8, None, groups(1)), (9, "a b", None)]
    df = spark.createDataFrame(rows, "id long, text string, groups array<struct<group:int,weight:bigint>>").coalesce(2)
    tt = spark.createDataFrame([(t,) for t in terms], "term string")
    want = {}
    for i, (_, text, days) in enumerate(rows):
        for (_, t), n in _brute([(i, text)], terms, lambda x: re.findall(r"[^\W_]+", x)).items():
            for day, weight in days or []:
                want[day, t] = want.get((day, t), 0) + n * weight
    out = TT.group_hits(df, tt)
    assert {(r["group"], r["term"]): r["hits"] for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(id" not in plan and "hashpartitioning(term" not in plan
