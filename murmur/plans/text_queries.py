"""Registered ingest, text-feature, keyword, forecast, scoring and model queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from murmur.functions.text import MENTION, WORD, escape_term
from murmur.operators import clean as CLN
from murmur.operators import features as FT
from murmur.operators import forecast as FC
from murmur.operators import keywords as KW
from murmur.operators import scoring as SC
from murmur.operators import spam as SP
from murmur.operators import term_table as TT
from murmur.operators.neighbours import stored
from murmur.plans.oracle import SCORED, q, sround, with_posts
from murmur.plans.registry import register
from murmur.sources.posts_view import posts_view, posts_with_text, raw_messages, sentiment_table, with_doc_id, with_text_columns
from murmur.sources.tables import ensure_parallelism, table
from murmur.vocab import FIXTURE as V

AS_OF = "2024-01-31"


def _text(s, d):
    return posts_with_text(s, d, V)


def _raw(s, d):
    return raw_messages(_text(s, d))


# --- ingest chain (SRC2, PRJ1-PRJ10) ------------------------------------------------

PARSED_SQL_COLS = """id, bid, user_id, screen_name, text, 'post/' || bid AS article_url, location,
  CAST(NULL AS VARCHAR) AS at_users, topics, CAST(NULL AS VARCHAR) AS pics, CAST(NULL AS VARCHAR) AS video_url,
  reposts_count, comments_count, attitudes_count, strftime(created_at, '%Y-%m-%d %H:%M') AS created_at,
  'feed' AS source, CAST(NULL AS VARCHAR) AS retweet_id, CAST(NULL AS VARCHAR) AS ip, user_authentication,
  CAST(NULL AS VARCHAR) AS vip_type, CAST(user_id AS INTEGER) % 7 AS vip_level"""

register("parse_posts", with_posts(f"SELECT {PARSED_SQL_COLS} FROM posts", V, with_text=True))(
    lambda s, d: CLN.parse_posts(_raw(s, d)))

register("json_props", "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")(
    lambda s, d: table(s, d, "events").select(
        "event_id", F.get_json_object("props", "$.k").try_cast("int").alias("k")))

_blocked = " AND ".join(f"NOT contains(t, {q(b)})" for b in V.blocklist) or "TRUE"
CLEAN_SQL_BODY = f"""SELECT id, bid, user_id, screen_name, t AS text, location, topics, reposts_count, comments_count,
         attitudes_count, created_at, hour, time_period, dt,
         CASE WHEN user_authentication IS NULL OR user_authentication = '' THEN {q(V.default_auth)}
              ELSE user_authentication END AS user_authentication
  FROM (SELECT *, regexp_replace(text, {q(MENTION)}, '', 'g') AS t FROM posts) x
  WHERE {_blocked} AND t IS NOT NULL AND length(t) > 5"""

register("clean_posts", with_posts(CLEAN_SQL_BODY.replace(
    "attitudes_count, created_at, hour, time_period, dt,",
    "attitudes_count, strftime(created_at, '%Y-%m-%d %H:%M') AS created_at,"),
    V, with_text=True))(
    lambda s, d: CLN.clean_posts(CLN.parse_posts(_raw(s, d)), V))


def _ingest(s, d):
    out = CLN.derive_time(CLN.clean_posts(CLN.parse_posts(_raw(s, d)), V), V)
    return out.withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"))


register("posts_ingest", with_posts(
    f"""SELECT id, bid, user_id, screen_name, text, location, topics, reposts_count, comments_count,
           attitudes_count, strftime(created_at, '%Y-%m-%d %H:%M:%S') AS created_at, user_authentication,
           hour, time_period, dt FROM ({CLEAN_SQL_BODY.replace('created_at,', "date_trunc('minute', created_at) AS created_at,", 1)}) c""",
    V, with_text=True), headline=True)(_ingest)

# --- rule features, tokens (ML0-ML8) ---------------------------------------------------

_spam_alt = "|".join(escape_term(t) for t in V.spam_terms)
_promo_alt = "|".join(escape_term(t) for t in V.promo_terms)


def _rule_features(s, d):
    docs = lambda t: FT.text_features(t, V).select("doc_id", *FT.TEXT_FEATURES)
    posts = posts_view(s, d, vocab=V).select("id", "reposts_count", "comments_count", "attitudes_count")
    return FT.counter_features(with_text_columns(s, d, posts, docs))


register("rule_features", with_posts(
    f"""SELECT id, text_length, spam_keyword_count, engagement, engagement / (text_length + 1) AS engagement_ratio,
           promotion_count, is_viral, engagement AS engagement_score,
           spam_keyword_count / (text_length + 1) AS spam_density,
           promotion_count / (text_length + 1) AS promotion_density
    FROM (SELECT id, CAST(length(text) AS INTEGER) AS text_length,
                 CAST(len(regexp_extract_all(text, {q(_spam_alt)})) + 1 AS INTEGER) AS spam_keyword_count,
                 CAST(reposts_count AS BIGINT) + comments_count + attitudes_count AS engagement,
                 (length(text) - length(regexp_replace(text, {q(_promo_alt)}, '', 'g'))) / {V.promo_divisor} AS promotion_count,
                 CASE WHEN reposts_count > 1000 THEN 1 ELSE 0 END AS is_viral
          FROM posts) f""", V, with_text=True), headline=True)(
    lambda s, d: _rule_features(s, d).select("id", *FT.RULE_FEATURES))



def _tokenize(s, d):
    """Posts without a text have no words, as those of a text without any."""
    docs = lambda t: FT.tokenize(t).select("doc_id", F.array_join("words", " ").alias("words"), F.size("words").cast("bigint").alias("n_words"))
    out = with_text_columns(s, d, posts_view(s, d, vocab=V).select("id"), docs)
    return out.select("id", F.coalesce("words", F.lit("")).alias("words"), F.coalesce("n_words", F.lit(0).cast("long")).alias("n_words"))


register("tokenize", with_posts(
    f"""SELECT id, array_to_string(list_filter(regexp_extract_all(text, {q(WORD)}), lambda w: length(w) >= 2), ' ') AS words,
           len(list_filter(regexp_extract_all(text, {q(WORD)}), lambda w: length(w) >= 2)) AS n_words
    FROM posts""", V, with_text=True))(
    lambda s, d: _tokenize(s, d))

# --- keywords and trends (DOC3, DOC6, DOC8) ----------------------------------------------

_terms_sql = ", ".join(f"({q(t)}, {q(escape_term(t))})" for t in V.sensitive_terms)
TERM_CTE = f"""tt AS (
  SELECT p.dt, t.term, CAST(sum(len(regexp_extract_all(p.text, t.pat))) AS BIGINT) AS hits
  FROM posts p, (VALUES {_terms_sql}) AS t(term, pat) GROUP BY p.dt, t.term)"""

register("term_trend", with_posts("SELECT dt, term, hits FROM tt", V, with_text=True, extra_ctes=TERM_CTE))(
    lambda s, d: KW.term_trend(_text(s, d), V))

register("keyword_trend", with_posts(
    """SELECT dt, term, hits, prev_hits, hits - prev_hits AS change FROM (
         SELECT *, lag(hits) OVER (PARTITION BY term ORDER BY dt) AS prev_hits FROM tt) x""",
    V, with_text=True, extra_ctes=TERM_CTE))(
    lambda s, d: KW.keyword_trend(_text(s, d), V))

register("hot_keywords", with_posts(
    f"""SELECT dt, CAST(rank AS INTEGER) AS rank, term, tf, df, {sround('tfidf', 6)} AS tfidf FROM (
      SELECT *, row_number() OVER (PARTITION BY dt ORDER BY tfidf DESC, term ASC) AS rank FROM (
        SELECT tf.dt, tf.term, tf.tf, dfs.df,
               tf.tf * (ln(CAST((SELECT count(DISTINCT dt) FROM posts) + 1 AS DOUBLE) / (dfs.df + 1)) + 1.0) AS tfidf
        FROM (SELECT dt, term, count(*) AS tf FROM (
                SELECT dt, unnest(list_filter(regexp_extract_all(text, {q(WORD)}), lambda w: length(w) >= 2)) AS term
                FROM posts) u GROUP BY dt, term) tf
        JOIN (SELECT term, count(*) AS df FROM (
                SELECT DISTINCT dt, unnest(list_filter(regexp_extract_all(text, {q(WORD)}), lambda w: length(w) >= 2)) AS term
                FROM posts) v GROUP BY term) dfs ON dfs.term = tf.term) s) r
    WHERE rank <= 10""", V, with_text=True), headline=True)(
    lambda s, d: KW.hot_keywords(with_doc_id(s, d, posts_view(s, d, vocab=V).select("id", "dt")), k=10,
                                 texts=ensure_parallelism(table(s, d, "documents").select("doc_id", "text"))))

register("sentiment_trend", with_posts(
    f"""SELECT dt, avg_score, negative_share,
           {sround('avg_score - lag(avg_score) OVER (ORDER BY dt)', 6)} AS avg_score_change,
           {sround('negative_share - lag(negative_share) OVER (ORDER BY dt)', 6)} AS negative_share_change
    FROM (SELECT dt, {sround('avg(CAST(score AS DECIMAL(38,18)))', 6)} AS avg_score,
                 {sround(f"sum(CASE WHEN label = {q(V.negative)} THEN 1 ELSE 0 END) / count(*)", 6)} AS negative_share
          FROM scored GROUP BY dt) d""", V, extra_ctes=SCORED))(
    lambda s, d: KW.sentiment_trend(sentiment_table(posts_view(s, d, vocab=V)), V))

register("negative_forecast", with_posts(
    f"""SELECT region, n_days, {sround('slope', 6)} AS slope, {sround('intercept', 6)} AS intercept,
           {sround('intercept + slope * 7.0', 6)} AS forecast,
           CASE WHEN {sround('slope', 6)} > 0 THEN 'up' WHEN {sround('slope', 6)} < 0 THEN 'down' ELSE 'flat' END AS direction
    FROM (SELECT region, count(*) AS n_days,
                 CASE WHEN var_pop(x) > 0 THEN regr_slope(share, x) END AS slope,
                 CASE WHEN var_pop(x) > 0 THEN regr_intercept(share, x) END AS intercept
          FROM (SELECT region, dt, CAST(date_diff('day', DATE '2024-01-24', CAST(dt AS DATE)) AS DOUBLE) AS x,
                       sum(CASE WHEN label = {q(V.negative)} THEN 1 ELSE 0 END) / count(*) AS share
                FROM (SELECT p.dt, p.label, rg.region
                      FROM scored p, unnest(string_split(p.location, ' | ')) AS rg(region)
                      WHERE p.dt >= '2024-01-24' AND p.dt < '2024-01-31' AND p.location IS NOT NULL
                        AND p.location <> '' AND rg.region <> '') e
                GROUP BY region, dt) g
          GROUP BY region) f""", V, extra_ctes=SCORED))(
    lambda s, d: FC.negative_forecast(sentiment_table(posts_view(s, d, vocab=V)), AS_OF, 7, V))

# --- scoring (ML15, ML16, JN1, JN12) --------------------------------------------------------


def _hits_sql(terms):
    return "(" + " + ".join(f"len(regexp_extract_all(text, {q(escape_term(t))}))" for t in terms) + ")"


def _scored_texts(s, d, scorer, *outputs):
    """Each text is scored once; posts without a text have no row."""
    docs = lambda t: SC.score_text(t, scorer).select("doc_id", *outputs)
    return with_text_columns(s, d, posts_view(s, d, vocab=V).select("id", "dt"), docs, "inner").select("id", "dt", *outputs)


_pos, _neg = _hits_sql(V.positive_terms), _hits_sql(V.negative_terms)
register("score_sentiment", with_posts(
    f"""SELECT id, dt, label, label_id, score, abs(score * 2 - 1) AS confidence FROM (
      SELECT id, dt, CASE WHEN s > 0.5 THEN {q(V.positive)} WHEN s < 0.5 THEN {q(V.negative)} ELSE {q(V.neutral)} END AS label,
             CASE WHEN s > 0.5 THEN 2 WHEN s < 0.5 THEN 0 ELSE 1 END AS label_id, s AS score
      FROM (SELECT id, dt, CAST({_pos} + 1 AS DOUBLE) / ({_pos} + {_neg} + 2) AS s
            FROM posts WHERE text IS NOT NULL AND text <> '') a) b""", V, with_text=True), headline=True)(
    lambda s, d: _scored_texts(s, d, SC.lexicon_sentiment(V), "label", "label_id", "score", "confidence"))

_topic_hits = [(i, name, _hits_sql(terms)) for i, (name, terms) in enumerate(V.topic_terms)]
_best = "CASE " + " ".join(
    f"WHEN {h} > 0 AND " + " AND ".join(
        [f"{h} {'>=' if j > i else '>'} {h2}" for j, _, h2 in _topic_hits if j != i] or ["TRUE"])
    + f" THEN {i}" for i, _, h in _topic_hits) + " END"
_names = "[" + ", ".join(q(n) for _, n, _ in _topic_hits) + "]"
_hits_list = "[" + ", ".join(h for _, _, h in _topic_hits) + "]"
register("score_topic", with_posts(
    f"""SELECT id, dt, CASE WHEN b IS NOT NULL THEN {_names}[b + 1] END AS topic_label, b AS topic_id,
           CASE WHEN b IS NOT NULL THEN CAST(hs[b + 1] AS DOUBLE) / list_sum(hs) ELSE 0.0 END AS confidence
    FROM (SELECT id, dt, {_best} AS b, {_hits_list} AS hs FROM posts WHERE text IS NOT NULL AND text <> '') t""",
    V, with_text=True))(
    lambda s, d: _scored_texts(s, d, SC.lexicon_topic(V), "topic_label", "topic_id", "confidence"))

register("unscored_rows", with_posts(
    """SELECT dt, count(*) AS "count" FROM posts p
       WHERE NOT EXISTS (SELECT 1 FROM scored s WHERE s.id = p.id) AND p.text IS NOT NULL AND p.text <> ''
       GROUP BY dt""", V, with_text=True, extra_ctes=SCORED))(
    lambda s, d: SC.unscored_rows(_text(s, d), sentiment_table(posts_view(s, d, vocab=V)))
    .groupBy("dt").agg(F.count(F.lit(1)).alias("count")))

# --- spam model (ML9-ML14, AG25) --------------------------------------------------------------


COUNTER_COLS = ("reposts_count", "comments_count", "attitudes_count")


def _labelled(s, d):
    """``(train, test)`` posts with their features: labels, split and hashed words once a document, stored with the counters of
    its posts, so that no pass of a fit joins again."""
    docs = ensure_parallelism(table(s, d, "documents").select("doc_id", "text"))
    lab = table(s, d, "labels").select("doc_id", F.col("quality").alias("label"))
    known = SP.spam_text_features(SP.training_set(lab.join(docs, "doc_id", "left")), V).withColumn("held", SP.held_out())
    known = SP.hash_words(known).drop("text")
    posts = with_doc_id(s, d, posts_view(s, d, vocab=V).select("id", *COUNTER_COLS))
    posts = posts.groupBy("doc_id").agg(F.collect_list(F.struct(*COUNTER_COLS)).alias("posts"))
    known = stored(known.join(posts, "doc_id"), "labelled")
    known = known.select(*[c for c in known.columns if c != "posts"], F.inline("posts"))
    return [FT.counter_features(known.where(side).drop("held")) for side in ("NOT held", "held")]


def _spam_eval(s, d):
    train, test = _labelled(s, d)
    return SP.eval_classifier(SP.judge(test, SP.fit_spam_model(train)))


def _filter_spam(s, d):
    train, _ = _labelled(s, d)
    model = SP.fit_spam_model(train)
    clean = CLN.clean_posts(CLN.parse_posts(_raw(s, d)), V)
    return SP.filter_spam(clean, model, V).select("id", "user_id")


def _misjudged(s, d):
    pred = table(s, d, "documents").select("doc_id", "text").join(table(s, d, "labels"), "doc_id").select(
        F.col("doc_id").cast("string").alias("text"), F.col("quality").cast("double").alias("label"), (F.length("text") > 1000).cast("double").alias("prediction"))
    missed, let_through = SP.misjudged(pred)
    return missed.unionByName(let_through)


# SO5: a rule (more than 1000 characters) as the prediction; the texts shown are the ids
register("misjudged", """SELECT CAST(doc_id AS VARCHAR) AS text, CAST(quality AS DOUBLE) AS label, CAST(length(text) > 1000 AS DOUBLE) AS prediction
FROM documents JOIN labels USING (doc_id) WHERE (quality = 1) <> (length(text) > 1000)""")(_misjudged)
register("spam_model_eval")(_spam_eval)
register("filter_spam")(_filter_spam)

register("eval_classifier", """SELECT label, prediction, n, CAST(sum(n) OVER () AS BIGINT) AS total,
       CAST(sum(CASE WHEN label = prediction THEN n ELSE 0 END) OVER () AS BIGINT) AS correct,
       """ + sround("CAST(sum(CASE WHEN label = prediction THEN n ELSE 0 END) OVER () AS DOUBLE) / sum(n) OVER ()", 6)
         + """ AS accuracy
FROM (SELECT CAST(quality AS DOUBLE) AS label, CAST(1 - toxic AS DOUBLE) AS prediction, count(*) AS n
      FROM labels GROUP BY 1, 2) t""")(
    lambda s, d: SP.eval_classifier(table(s, d, "labels").select(
        F.col("quality").cast("double").alias("label"), (1 - F.col("toxic")).cast("double").alias("prediction"))))

# --- batch accounting (AG24), topic and vector clustering (DOC5) -------------------------------


def _ingest_metrics(s, d):
    from murmur.operators.metrics import ingest_metrics
    parsed = CLN.derive_time(CLN.counters_to_int(CLN.parse_posts(_raw(s, d))), V)
    return ingest_metrics(parsed, V)


_t = f"regexp_replace(text, {q(MENTION)}, '', 'g')"
_nokey = "(id IS NULL OR created_at IS NULL)"
_blk = "coalesce(" + " OR ".join(f"contains({_t}, {q(b)})" for b in V.blocklist) + ", false)"
_short = f"coalesce(length({_t}) <= 5, true)"
register("ingest_metrics", with_posts(
    f"""SELECT count(*) AS messages,
           CAST(sum(CASE WHEN {_nokey} THEN 1 ELSE 0 END) AS BIGINT) AS rejected,
           CAST(sum(CASE WHEN NOT {_nokey} AND {_blk} THEN 1 ELSE 0 END) AS BIGINT) AS blocked,
           CAST(sum(CASE WHEN NOT {_nokey} AND NOT {_blk} AND {_short} THEN 1 ELSE 0 END) AS BIGINT) AS too_short,
           CAST(sum(CASE WHEN NOT {_nokey} AND NOT {_blk} AND NOT {_short} THEN 1 ELSE 0 END) AS BIGINT) AS kept
    FROM posts""", V, with_text=True))(_ingest_metrics)


def _topic_clusters(s, d):
    from murmur.operators.topics import topic_clusters
    docs = table(s, d, "documents").select(F.col("doc_id").alias("id"), "text")
    _, assign = topic_clusters(docs, k=8)
    return assign.groupBy("cluster").agg(F.count(F.lit(1)).alias("documents"))


def _embedding_clusters(s, d):
    from murmur.operators.topics import embedding_clusters
    out = embedding_clusters(table(s, d, "embeddings"), k=4, method="kmeans")
    return out.groupBy("cluster").agg(F.count(F.lit(1)).alias("vectors"))


register("topic_clusters")(_topic_clusters)
register("embedding_clusters")(_embedding_clusters)

# --- a table of terms (DOC3, PRJ3, ML2): ten phrases of one to five words of every document ------------

PHRASES = 10


def _phrases(docs):
    w = docs.select("doc_id", TT.words(F.col("text")).alias("w")).where(F.size("w") > 0)
    cuts = F.transform(F.sequence(F.lit(0), F.lit(PHRASES - 1)), lambda j: F.array_join(F.slice(
        "w", ((F.col("doc_id") * 31 + j * 17) % F.size("w") + 1).cast("int"), (1 + (F.col("doc_id") + j) % 5).cast("int")), " "))
    return w.select(F.explode(cuts).alias("term")).distinct()


def _term_totals(s, d):
    docs = ensure_parallelism(table(s, d, "documents").select("doc_id", "text"))
    return TT.text_totals(docs, _phrases(docs), id_col="doc_id")


def _term_table_trend(s, d):
    """Each document is searched once; a day's hits are those of its documents times their posts.  Days go as numbers."""
    posts = with_doc_id(s, d, posts_view(s, d, vocab=V).select("id", "dt"))
    days = posts.groupBy("doc_id", "dt").agg(F.count(F.lit(1)).alias("posts"))
    days = days.groupBy("doc_id").agg(F.collect_list(F.struct(F.unix_date(F.to_date("dt")).alias("group"), F.col("posts").alias("weight"))).alias("groups"))
    docs = ensure_parallelism(table(s, d, "documents").select("doc_id", "text"))
    hits = TT.group_hits(docs.join(days, "doc_id"), _phrases(docs))
    return hits.select(F.date_format(F.date_from_unix_date("group"), "yyyy-MM-dd").alias("dt"), "term", "hits")


_phrase_ctes = f"""words AS MATERIALIZED (SELECT doc_id, regexp_extract_all(text, {q(WORD)}) AS w FROM documents),
terms AS MATERIALIZED (
  SELECT DISTINCT array_to_string(list_slice(w, p + 1, p + k), ' ') AS term
  FROM (SELECT w, (doc_id * 31 + j * 17) % len(w) AS p, 1 + (doc_id + j) % 5 AS k FROM words, range({PHRASES}) r(j) WHERE len(w) > 0) c),
places AS (SELECT doc_id, unnest(w) AS w, generate_subscripts(w, 1) AS i FROM words),
runs AS (SELECT doc_id, w AS a, lead(w, 1) OVER o AS b, lead(w, 2) OVER o AS c, lead(w, 3) OVER o AS d, lead(w, 4) OVER o AS e
         FROM places WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
grams AS (SELECT doc_id, unnest([a, a || ' ' || b, a || ' ' || b || ' ' || c, a || ' ' || b || ' ' || c || ' ' || d,
                                 a || ' ' || b || ' ' || c || ' ' || d || ' ' || e]) AS term FROM runs),
hits AS MATERIALIZED (SELECT doc_id, term, count(*) AS n FROM grams JOIN terms USING (term) GROUP BY doc_id, term)"""

register("term_hits", f"""WITH {_phrase_ctes}
SELECT term, count(*) AS n_texts, CAST(sum(n) AS BIGINT) AS n_hits FROM hits GROUP BY term""")(
    _term_totals)
register("term_table_trend", with_posts("""SELECT dt, term, CAST(sum(p.posts * h.n) AS BIGINT) AS hits
FROM (SELECT dt, CAST(id AS BIGINT) % (SELECT count(*) FROM documents) AS doc_id, count(*) AS posts FROM posts GROUP BY ALL) p
JOIN hits h USING (doc_id) GROUP BY dt, term""", V, extra_ctes=_phrase_ctes))(_term_table_trend)
