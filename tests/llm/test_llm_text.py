"""Operators on single texts: HTML, toxicity, tokens, quality rules, language, LM scores."""

import html
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from murmur.llm import html_text, langid, lm_score, quality, queries, sentencepiece_fst as sp, toxicity

SF0001, SF001 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"
DOC = "doc_id long, text string"


def rows(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=repr)


# -- HTML

def test_html_articles_of_the_pages_table(spark):
    got = {r.page_id: r for r in queries.op1_html_extraction(spark, SF0001).collect()}
    for page in spark.read.parquet(f"{SF0001}/pages.parquet").collect():
        article = re.search(r"<article>(.*?)</article>", page.html, re.S)[1].replace("<br>", " ")
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article))
        assert got[page.page_id].text == "\n".join(b for b in blocks if b)
        assert got[page.page_id].n_chars == len(got[page.page_id].text)


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("<!-- x", ""), ("plain", "plain"),
    ("<article><header><h1>T &amp; t</h1><p>By</p></header><p>a&nbsp;<br> b &lt;i&gt;<div class='notice'>n</div>"
     "<section id=comments><article class=comment>c</article></section></article><footer>f</footer>", "T & t\na b <i>"),
    ("<nav>n</nav><main><p>x<p>y</main><aside>z</aside><form><p>q</form>", "x\ny"),
    ("<main><ul><li>one<li>two</ul><script>if (a<b) '</p>'</script><p hidden>h</p></main>", "one\ntwo"),
    ("<div class=sidebar><p>the of and to a in that is was for</p></div><main>m</main>", "m"),
    ("<article><p>unclosed <b>bold", "unclosed bold"),
])
def test_html_cases(page, text):
    assert html_text.main_text(page) == text


def test_html_short_blocks_follow_their_neighbours():
    long = "the dog and the cat were on the way to the town and they had a good time at the party that was in the town"
    links = "".join(f"<li><a href=x>link {i}</a></li>" for i in range(4))
    page = f"<ul>{links}</ul><div>Home</div><ul>{links}</ul><p>{long}</p><p>Yes.</p><p>{long}</p><ul>{links}</ul>"
    assert html_text.main_text(page) == f"{long}\nYes.\n{long}"


def test_html_densities_decide_on_framed_pages_too():
    long = "the dog and the cat were on the way to the town and they had a good time at the party that was in the town"
    links = "".join(f"<li><a href=x>more stories like this one, number {i}</a></li>" for i in range(4))
    card = "<article class=card><h3><a href=y>Next story</a></h3></article>"
    page = f"<nav><a href=z>n</a></nav><div id=content><h2>Title</h2><p>{long}</p><p>Yes.</p><p>{long}</p></div><ul>{links}</ul>{card}<footer>f</footer>"
    assert html_text.main_text(page) == f"Title\n{long}\nYes.\n{long}"
    page = f"<article><h1><a href=y>Title</a></h1><p>{long}</p><p>Yes.</p><ul>{links}</ul></article><footer>{long}</footer>"
    assert html_text.main_text(page) == f"Title\n{long}\nYes."
    page = f"<main><p>{long}</p></main><div class=advert><p>{long}</p><p>Buy it now.</p></div>"
    assert html_text.main_text(page) == long
    page = f"<div class=has-sidebar><p>{long}</p><p>{long}</p></div>"
    assert html_text.main_text(page) == f"{long}\n{long}"


LONG_EN = "the dog and the cat were on the way to the town and they had a good time at the party that was in the town"


@pytest.mark.parametrize("start, end", [
    ("<body class='single comments-open'>", "</body>"), ("<div class='wrap comments-enabled'>", "</div>"),
    ("<div class='wrap comments-enabled'><article>", "</article></div>"), ("<article class='post responses-open'>", "</article>"),
    ("<div id=discussion-page><h1>T</h1>", "</div>")])
def test_html_names_of_comments_are_no_verdict(start, end):
    got = html_text.main_text(f"{start}<p>{LONG_EN}</p><p>{LONG_EN}</p>{end}")
    assert got.removeprefix("T\n") == f"{LONG_EN}\n{LONG_EN}"
    reader = f"<div class=comments><div class=comment><p>{LONG_EN}</p></div></div>"
    assert html_text.main_text(f"<div><p>{LONG_EN} x</p><p>{LONG_EN}</p></div>{reader}") == f"{LONG_EN} x\n{LONG_EN}"
    assert html_text.main_text(f"<article><p>{LONG_EN} x</p></article><ol class=comment-list><li><article class=comment-body><p>{LONG_EN}</p>"
                               "</article></ol>") == f"{LONG_EN} x"


def test_html_languages_without_stop_words_here():
    ru = "Сегодня утром жители города вышли на площадь, чтобы увидеть открытие нового моста через широкую реку, который строили почти десять лет подряд и никак не могли закончить вовремя."
    zh = "今天早上，市民们来到广场，观看横跨大河的新桥的开通仪式。这座桥建了将近十年，一直没有按时完工，大家都在等待。"
    links = "".join(f"<li><a href=x>{w}</a></li>" for w in ("Новости", "Спорт", "首页", "体育"))
    for text in (ru, zh):
        page = f"<ul>{links}</ul><div><p>{text}</p><p>{text}</p></div><ul>{links}</ul>"
        assert html_text.main_text(page) == f"{text}\n{text}"


@pytest.mark.parametrize("inside, text", [
    ("<script src=x /> var a='JS';</script><p>a</p>", "a"), ("<span style='display:none'>SECRET</span><p>a</p>", "a"),
    ("<p>a <i hidden>b<i>c</i></i>d</p>", "a d"), ("<svg><svg><text>x</text></svg><text>y</text></svg><p>a</p>", "a"),
    ("<svg/><p>a</p>", "a"), ("<p>none <span class=hidden-line>b</span></p>", "none b")])
def test_html_hidden_content(inside, text):
    assert html_text.main_text(f"<article>{inside}</article>") == text


@pytest.mark.parametrize("tag", ["button", "select", "object", "canvas", "noscript"])
def test_html_unclosed_elements_swallow_nothing(tag):
    got = html_text.main_text(f"<div><{tag}>x<p>{LONG_EN}</p><p>{LONG_EN}</p></div>")
    assert got.endswith(f"{LONG_EN}\n{LONG_EN}")
    assert html_text.main_text(f"<div><p>{LONG_EN}</p><{tag}>x<b>y</b></{tag}><p>{LONG_EN}</p></div>") == f"{LONG_EN}\n{LONG_EN}"


def test_html_lists_of_other_pages_are_left_out():
    page = f"<div><h1>T</h1><p>{LONG_EN}</p><h3>You may also like</h3><p>{LONG_EN} teaser</p></div>"
    assert html_text.main_text(page) == f"T\n{LONG_EN}"


def test_html_pages_without_article_elements(spark):
    """The given pages with ``div`` for ``article``: densities and names alone, by blocks."""
    right = found = wanted = 0
    for page in spark.read.parquet(f"{SF001}/pages.parquet").collect():
        want = Counter(html_text.main_text(page.html).split("\n"))
        got = Counter(html_text.main_text(page.html.replace("<article>", "<div>").replace("</article>", "</div>")).split("\n"))
        right += (want & got).total()
        found += got.total()
        wanted += want.total()
    assert right / found > 0.9 and right / wanted > 0.9, (right / found, right / wanted)


def test_html_long_page_and_frame_edges(spark):
    body = "".join(f"<p>w{i} &amp; x</p>" for i in range(20_000))
    assert html_text.main_text(f"<article>{body}</article>").count("\n") == 19_999
    df = spark.createDataFrame([(1, None, None, "a"), (1, None, None, "a"), (None, "u", "<main>x</main>", "b")],
                               "page_id long, url string, html string, text string")
    assert rows(html_text.extract(df), "page_id", "url", "text", "n_chars") == sorted(
        [(1, None, "", 0), (1, None, "", 0), (None, "u", "x", 1)], key=repr)
    assert html_text.extract(df.limit(0)).count() == 0


# -- toxicity

def test_toxicity_held_out_accuracy(spark):
    got = queries.op2_toxicity(spark, SF001).join(spark.read.parquet(f"{SF001}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.toxic for r in got) / len(got) > 0.93
    assert sum(r.predicted for r in got if r.toxic == 0) / sum(r.toxic == 0 for r in got) < 0.03


def test_toxicity_folding_prefixes_and_exceptions():
    assert toxicity.fold("1D10T") == toxicity.fold("idiot") == toxicity.fold("іdіоt") == toxicity.fold("ｉdiot")
    assert toxicity.fold("$cum l0ser!") == toxicity.fold("scum loser") + "!"
    lex = toxicity.Lexicon({"scum": 4.0}, {"idio": 2.0}, frozenset({"pond scum"}), 1.0)
    a = lex.automaton()
    assert toxicity.weight_per_100(lex, a, "scum idiots") == pytest.approx(600 / 22)
    assert toxicity.weight_per_100(lex, a, "Pond\n scum") == 0
    assert toxicity.weight_per_100(lex, a, "scums unscum xidiot") == 0
    assert toxicity.weight_per_100(lex, a, "pond" + " " * 5000 + "scum") == 0
    far = toxicity.Lexicon({"scum": 4.0}, {}, frozenset({"p" * 300 + " scum", "scum " + "q" * 300}), 1.0)
    for text, weight in (("p" * 300 + " scum", 0), ("p" * 299 + " scum", 4), ("scum\n" + "q" * 300, 0), ("scum " + "q" * 301, 4)):
        assert toxicity.weight_per_100(far, a, text) == pytest.approx(100 * weight / 22)
    assert toxicity.weight_per_100(lex, a, None) == toxicity.weight_per_100(lex, a, "") == 0
    assert toxicity.score_of(lex, 0) == 0 and toxicity.score_of(lex, 1.0) == pytest.approx(0.7)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["scum", "scums", "idiots", "pond", "x", "Pond", "\u0455cum", "-", "_", "  ", "\n"]), max_size=12),
       st.sampled_from([" ", "", "."]))
def test_toxicity_hits_equal_a_naive_matcher(parts, gap):
    lex = toxicity.Lexicon({"scum": 4.0, "pond": 1.0}, {"idio": 2.0, "scu": 1.5}, frozenset({"pond scum", "scum x"}), 1.0)
    text = gap.join(parts)
    words = re.findall(r"[^\W_]+", toxicity.fold(text))
    total = 0.0
    for i, w in enumerate(words):
        weight = max([lex.words.get(w, 0.0)] + [v for p, v in lex.prefixes.items() if w.startswith(p)])
        around = {f"{a} {b}" for a, b in zip(words[max(0, i - 1):i + 1], words[max(0, i - 1) + 1:i + 2])}
        total += 0 if around & lex.exceptions else weight
    want = 100 * total / (len(text.split()) + 20)
    assert toxicity.weight_per_100(lex, lex.automaton(), text) == pytest.approx(want)


def test_toxicity_learns_words_beginnings_and_exceptions(spark):
    rng = random.Random(3)
    plain = [f"word{i}" for i in range(200)]
    data = []
    for i in range(400):
        words = rng.choices(plain, k=30)
        toxic = i % 4 == 0
        if toxic:
            words[5:5] = ["vermin", f"blurg{rng.choice('abcdefgh')}{rng.choice('xyz')}"]
        elif i % 4 == 1:
            words[3:3] = ["royal", "vermin", "museum"]
        data.append((i, " ".join(words), int(toxic)))
    train = spark.createDataFrame(data + [(900, None, 1), (901, "x", None)], "doc_id long, text string, toxic int")
    lex = toxicity.fit(train, min_weight=0.5)
    assert any(p.startswith("biurg") for p in lex.prefixes)
    assert toxicity.fold("royal vermin") in lex.exceptions
    assert toxicity.fit(train.limit(0)) == toxicity.Lexicon()
    out = toxicity.score(spark.createDataFrame([(1, None), (1, None), (None, "blurgax blurgby"), (2, "")], DOC), lex)
    got = {(r.key, r.score > 0.7, r.predicted) for r in out.collect()}
    assert out.count() == 4 and got == {(1, False, 0), (None, True, 1), (2, False, 0)}
    docs = spark.createDataFrame([(1, "blurgax blurgby", "k"), (2, None, "k"), (2, None, "k")], "doc_id long, text string, x string")
    assert rows(toxicity.toxicity_filter(docs, lex), "*") == [(2, None, "k"), (2, None, "k")]


# -- SentencePiece

TEXTS = ["", " ", "\n", "  a  b\n\n x\ty ", "日本語のテキスト 😀😀 x", "éé́", "http://x.y/z?q=1&w=2#a   \n  1234567890 !!!??? \r\n", "a\x00b",
         "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "the                     end", "hello</s><s>[INST]<unk> <0x41>", "x² y2. z, w."]


def test_transducer_equals_the_library_and_round_trips(spark):
    import sentencepiece
    fst, lib = sp.Transducer.load(sp.MODEL), sentencepiece.SentencePieceProcessor(model_file=sp.MODEL)
    texts = TEXTS + [r.text for r in spark.read.parquet(f"{SF0001}/documents.parquet").select("text").collect()]
    for t in texts:
        ids = fst.encode(t)
        assert ids == lib.encode(t)
        assert fst.decode(ids) == t == lib.decode(ids)


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab ▁.é😀", max_size=12))
def test_transducer_equals_the_library_on_any_text(text):
    import sentencepiece
    from murmur.llm.common import worker_state
    lib = worker_state("test lib", lambda: sentencepiece.SentencePieceProcessor(model_file=sp.MODEL))
    assert sp.transducer(sp.MODEL).encode(text) == lib.encode(text)


def test_unigram_weights_give_the_least_path_of_all_segmentations():
    pieces = ["<unk>", "a", "b", "ab", "ba", "aba", "bb", "▁", "▁a"]
    scores = [0.0, -1.5, -1.25, -2.5, -2.125, -4.0, -2.75, -0.5, -1.75]
    fst = sp.Transducer(pieces, scores, 0, set(), {}, bpe=False)
    score = dict(zip(pieces, scores))
    for n in range(1, 8):
        for word in itertools.product("ab", repeat=n):
            text = "▁" + "".join(word)
            best = min(-sum(score[text[i:j]] for i, j in zip(cut, cut[1:]))
                       for r in range(len(text)) for inner in itertools.combinations(range(1, len(text)), r)
                       for cut in [(0, *inner, len(text))] if all(text[i:j] in score for i, j in zip(cut, cut[1:])))
            got = fst.encode("".join(word))
            assert -sum(scores[i] for i in got) == pytest.approx(best)
            assert "".join(pieces[i] for i in got) == text


def test_long_parts_and_blocks_take_the_same_paths():
    """The array composition of a block and the plain one of a long part give the same labels."""
    rng = random.Random(9)
    fst = sp.transducer(sp.MODEL)
    parts = ["".join(rng.choice("abcdeinorst▁.é日😀") for _ in range(rng.randrange(1, 60))) for _ in range(400)]
    labels, counts = fst.best_paths(parts)
    assert [x.tolist() for x in np.split(labels, np.cumsum(counts)[:-1])] == [fst.best_path(p) for p in parts]


def test_known_parts_may_be_forgotten_at_any_time(spark, monkeypatch):
    import sentencepiece
    lib = sentencepiece.SentencePieceProcessor(model_file=sp.MODEL)
    monkeypatch.setattr(sp, "KEEP", 300)
    fst = sp.Transducer.load(sp.MODEL)
    texts = [r.text for r in spark.read.parquet(f"{SF0001}/documents.parquet").select("text").limit(40).collect()]
    for a in range(0, 40, 3):
        ids, lengths, same = fst.encode_block(texts[a:a + 3])
        assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] == lib.encode(texts[a:a + 3]) and same.all()


@pytest.mark.parametrize("rule, squeeze", [("nmt_nfkc_cf", True), ("nfkc", False)])
def test_models_with_a_normaliser_equal_the_library(rule, squeeze):
    """The rules of a model's normaliser are compiled too: the given pieces under other normalisers."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as pb
    m = pb.ModelProto()
    with open(sp.MODEL, "rb") as f:
        m.ParseFromString(f.read())
    other = pb.ModelProto()
    other.ParseFromString(sentencepiece.SentencePieceNormalizer(rule_name=rule).serialized_model_proto())
    m.normalizer_spec.CopyFrom(other.normalizer_spec)
    m.normalizer_spec.remove_extra_whitespaces = squeeze
    data = m.SerializeToString()
    fst, lib = sp.Transducer.compile(data), sentencepiece.SentencePieceProcessor(model_proto=data)
    texts = TEXTS + ["ﬁ  Ａ Éé ①② ㍿", " ｶﾞ ½ … ™  ", "\u200bx\u00a0y\u3000z", "é á ẛ̣", "ſ ﬄ ﷺ"]
    for t in texts:
        assert fst.encode(t) == lib.encode(t), t
    assert fst.encode_block(["plain text", "ﬁ"])[2].tolist() == [True, False]


def test_unknown_pieces_of_a_model_without_bytes():
    fst = sp.Transducer(["<unk>", "a", "▁", "▁a"], [0.0, -1.0, -2.0, -1.5], 0, set(), {}, bpe=False)
    assert fst.encode("a xya\n") == [3, 2, 0, 1, 0]


def test_sentencepiece_frames(spark):
    docs = spark.createDataFrame([(1, None, 5), (1, None, 5), (2, "x" * 30_000 + " é", 6), (None, "ab", 7)], "doc_id long, text string, ids int")
    out = sp.encode(docs)
    assert out.where("round_trip").count() == 4 and out.where("n_tokens = 0").count() == 2
    back = {r.key: r.text for r in sp.decode(out).collect()}
    assert back == {1: "", 2: "x" * 30_000 + " é", None: "ab"}
    assert sp.encode(docs.limit(0)).count() == 0


# -- quality rules

def test_quality_statistics_against_brute_force(spark):
    rng = random.Random(5)
    texts = [None, "", "\n \n", "a b c d e", "a b c d e a b c d e", "x\nx\n\nx ", "# $ % A!! BB"]
    texts += ["".join(rng.choice(["a", "b", "cc", "#"]) + rng.choice([" ", "\n", "\t "]) for _ in range(rng.randrange(60))) for _ in range(60)]
    df = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    got = {r.doc_id: r for r in quality.judge(df).select("row.doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                                                         "base_failed", "kept").collect()}
    for i, t in enumerate(texts):
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        lines = [x for x in (t or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        windows = Counter(tuple(words[j:j + 5]) for j in range(len(words) - 4))
        hit = {j + k for j in range(len(words) - 4) if windows[tuple(words[j:j + 5])] > 1 for k in range(5)}
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t or "")), len(lines) - len(set(lines)), len(hit))
        assert tuple(got[i])[1:6] == want
        assert got[i].base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (got[i].kept and got[i].base_failed)


def test_quality_order_never_changes_the_verdict(spark):
    docs = spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text")
    stats, rules = quality.with_stats(docs), quality.default_rules()
    names = list(rules)
    first, last = (stats.where(quality.cascade(rules, o).isNull()).count() for o in (names, names[::-1]))
    assert first == last and sorted(quality.rule_order(docs, rules)) == sorted(names)
    costly = {"never": F.lit(False), "always": F.lit(True)}
    assert quality.rule_order(docs, costly)[0] == "always"


def test_quality_frames(spark):
    text = "this is one fine clean line of text with enough words in it"
    df = spark.createDataFrame([(1, text, "a", 9), (1, text, "a", 9), (None, None, "b", None)], "doc_id long, text string, words string, w int")
    assert rows(quality.quality_filter(df), "*") == [(1, text, "a", 9)] * 2
    assert quality.quality_filter(df.limit(0)).count() == 0
    long = spark.createDataFrame([(1, "abc def\n" * 60_000)], DOC)
    assert quality.judge(long).first().n_repeat_words == 120_000


# -- language

def test_language_held_out_accuracy(spark):
    got = queries.op8_language_id(spark, SF001).join(spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "lang"), "doc_id")
    held = got.where("held_out").collect()
    assert sum(r.lang == r.lang_pred for r in held) / len(held) > 0.97
    assert all(0 <= r.score <= 1 for r in held)


def test_language_against_direct_naive_bayes_and_edges(spark):
    train = [("the cat sat", "en"), ("la casa es", "es"), ("le chat est", "fr"), ("the dog", "en"), (None, "en"), ("x", None)]
    model = langid.fit(spark.createDataFrame(train, "text string, lang string"))
    counts = {lang: np.bincount(langid.gram_buckets([t for t, k in train if k == lang and t])[0], minlength=1 << langid.BITS) + 0.5 for lang in ("en", "es", "fr")}
    prior = {"en": 3 / 7, "es": 2 / 7, "fr": 2 / 7}
    for text in ("the house", "la", "chat le", "z"):
        at, _ = langid.gram_buckets([text])
        want = max(sorted(counts), key=lambda k: math.log(prior[k]) + np.log(counts[k][at] / counts[k].sum()).sum())
        assert langid.predict_texts(model, [text])[0] == [want]
    docs = spark.createDataFrame([(1, None), (1, ""), (2, "12 !"), (None, "the cat"), (3, "casa " * 300_000)], DOC)
    got = {(r.key, r.lang_pred) for r in langid.identify(docs, model).collect()}
    assert got == {(1, "und"), (2, "und"), (None, "en"), (3, "es")}
    assert langid.identify(docs.limit(0), model).count() == 0
    empty = langid.fit(spark.createDataFrame([], "text string, lang string"))
    assert langid.predict_texts(empty, ["abc"])[0] == ["und"]
    with pytest.raises(ValueError):
        langid.fit(spark.createDataFrame(train, "text string, lang string"), max_langs=2)


# -- LM scores

def test_lm_losses_against_dictionaries(spark):
    data = [(1, "abab aba", True), (2, "bbba  bab", False), (3, None, True), (4, "ABBA", False), (5, "", None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, is_target boolean")
    orders = 3
    model = lm_score.fit(docs, bits=16, orders=orders)

    def clean(t):
        return " ".join(t.lower().split())

    counts = [Counter(), Counter()]
    for _, t, target in data:
        s = "\x02" * (orders - 1) + clean(t or "")
        if not clean(t or ""):
            continue
        for end in range(orders - 1, len(s) + 1):
            for n in range(1, orders + 1):
                gram = ("\x02" * orders + s[:end])[-n:]
                counts[1][n, gram] += 1
                counts[0][n, gram] += bool(target)
    totals = [sum(v for (n, _), v in c.items() if n == 1) for c in counts]
    scale = [1.0, totals[0] / totals[1]]
    vocabulary = len({g for (n, g) in counts[1] if n == 1})

    def loss(t, m):
        s, out = "\x02" * (orders - 1) + clean(t), 0.0
        for i in range(orders - 1, len(s)):
            p = 1 / vocabulary
            for n in range(1, orders + 1):
                context = totals[0] if n == 1 else counts[m][n - 1, s[i - n + 1:i]] * scale[m]
                p = (counts[m][n, s[i - n + 1:i + 1]] * scale[m] + lm_score.SMOOTHING * p) / (context + lm_score.SMOOTHING)
            out -= math.log(p)
        return out / len(clean(t))

    for r in lm_score.score(docs, model).collect():
        t = data[r.key - 1][1]
        if not t:
            assert r.n_tokens == 0 and r.score is None
        else:
            assert r.n_tokens == len(clean(t))
            assert r.target_loss == pytest.approx(loss(t, 0), rel=1e-4) and r.score == pytest.approx(loss(t, 0) - loss(t, 1), abs=1e-3)


def test_lm_prefers_the_target_and_handles_empty_tables(spark):
    got = queries.op7_lm_score(spark, SF0001).join(spark.read.parquet(f"{SF0001}/labels.parquet"), "doc_id")
    mean = {r.quality: r.s for r in got.groupBy("quality").agg(F.avg("score").alias("s")).collect()}
    assert mean[1] < mean[0]
    none = spark.createDataFrame([], "doc_id long, text string, is_target boolean")
    assert lm_score.score(none, lm_score.fit(none)).count() == 0


def test_lm_counts_stay_exact_beyond_any_table_size(spark):
    rng = random.Random(11)
    letters = [chr(0x4E00 + i) for i in range(300)]
    data = [(i, "".join(rng.choices(letters, k=4000)), i % 3 == 0) for i in range(100)]
    model = lm_score.fit(spark.createDataFrame(data, "doc_id long, text string, is_target boolean").repartition(3))
    grams, whole = [Counter(), Counter()], [0, 0]
    for _, t, target in data:
        s = "\x02" * 4 + t
        for end in range(4, len(s) + 1):
            whole = [whole[0] + target, whole[1] + 1]
            for n in range(1, 5):
                grams[1][s[end - n:end]] += 1
                grams[0][s[end - n:end]] += target
    assert len(grams[1]) > 300_000
    totals, scale = [whole[0]] * 2, [1, whole[0] / whole[1]]

    def loss(t, m):
        s, out = "\x02" * 4 + t, 0.0
        for end in range(5, len(s) + 1):
            p = 1 / 301
            for n in range(1, 5):
                context = totals[m] if n == 1 else grams[m][s[end - n:end - 1]] * scale[m]
                p = (grams[m][s[end - n:end]] * scale[m] + lm_score.SMOOTHING * p) / (context + lm_score.SMOOTHING)
            out -= math.log(p)
        return out / len(t)

    unseen = [(200, "一丁 not in the corpus"), (201, "x"), (202, " \n"), (202, " \n"), (None, data[5][1])]
    docs = spark.createDataFrame([r[:2] for r in data[:6]] + unseen, DOC)
    texts = dict(data_row[:2] for data_row in data) | dict(unseen)
    got = lm_score.score(docs, model).collect()
    assert len(got) == 11 and sum(r.score is None for r in got) == 2
    for r in got:
        if r.score is not None:
            assert (r.target_loss, r.background_loss) == pytest.approx((loss(texts[r.key], 0), loss(texts[r.key], 1)), rel=1e-9)


def test_lm_grams_of_large_alphabets():
    codes = np.array([[1, 2, 3, 4], [0, 0x10FFFF, 0, 0], [1, 2, 3, 4], [0, 0x10FFFF, 0, 1]], dtype=np.uint32)
    for wide in (np.arange(0x110000), lm_score._alphabet(codes)):
        keys = lm_score._keys(codes, wide)
        assert keys[0] == keys[2] and len(np.unique(keys)) == 3
        assert (np.searchsorted(np.sort(keys), keys) == (np.sort(keys)[None] < keys[:, None]).sum(axis=1)).all()
    big = np.stack([np.arange(60_000, dtype=np.uint32)] * 4, axis=1)
    rows_, n = lm_score._distinct(np.concatenate([big, big[:5]]))
    assert len(rows_) == 60_000 and n.sum() == 60_005 and set(map(tuple, rows_)) == set(map(tuple, big))


def test_worker_state_of_other_operators_is_dropped_in_tasks(spark):
    from murmur.llm.common import only_state_of, worker_state

    def run(rows):
        import sys
        worker_state("one a", lambda: list(range(1000)))
        worker_state("one b", list)
        both = sorted(n for n in sys._murmur_worker_state if n.startswith("one"))
        worker_state("two a", list)
        left = sorted(sys._murmur_worker_state)
        only_state_of("three")
        yield both, left, sorted(sys._murmur_worker_state)

    assert spark.sparkContext.parallelize([1], 1).mapPartitions(run).collect() == [(["one a", "one b"], ["two a"], [])]
