"""Ingest parsing, cleaning and time derivation on hand-made edge rows."""

import json

from pyspark.sql import functions as F

from murmur.operators import clean as C
from murmur.vocab import FIXTURE, REFERENCE


def _raw(spark, msgs):
    return spark.createDataFrame([(m,) for m in msgs], "json_data string")


def test_parse_bad_json_missing_null_and_counters(spark):
    msgs = [
        "{not json",
        json.dumps({"id": "1", "text": "hello"}),
        json.dumps({"id": "2", "text": None, "reposts_count": "7"}),
        json.dumps({"id": "3", "reposts_count": "x7", "comments_count": "12.7", "attitudes_count": 5}),
        json.dumps({"id": "4", "user_id": 42, "vip_level": "3"}),
    ]
    rows = {r.id: r for r in C.parse_posts(_raw(spark, msgs)).collect()}
    assert None in rows and rows[None].text is None          # bad JSON: all NULL
    assert rows["1"].text == "hello" and rows["1"].reposts_count is None
    assert rows["2"].text is None and rows["2"].reposts_count == 7   # quoted counter parses
    assert rows["3"].reposts_count is None and rows["3"].comments_count is None  # never raises
    assert rows["3"].attitudes_count == 5
    assert rows["4"].user_id == "42" and rows["4"].vip_level == 3     # number in a string field


def test_clean_text_rules(spark):
    v = REFERENCE.with_(blocklist=("淘宝", "BLOCK"))
    texts = [None, "", "@abc 1234", "@abc 12345", "@用户你好世界的朋友们", "hi 😀😀😀😀", "buy on 淘宝 now!!",
             "this is BLOCKed text", "plain text ok"]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "id string, text string")
    out = {r.id: r.text for r in C.clean_text(df, v).collect()}
    assert "0" not in out and "1" not in out
    assert "2" not in out                      # " 1234": 5 characters after removal
    assert out["3"] == " 12345"                # 6 characters: kept
    assert "4" not in out                      # \S+ eats the CJK after the mention too
    assert out["5"] == "hi 😀😀😀😀"              # emoji count as one character each
    assert "6" not in out and "7" not in out
    assert out["8"] == "plain text ok"


def test_fill_auth(spark):
    df = spark.createDataFrame([("1", None), ("2", ""), ("3", "X")], "id string, user_authentication string")
    got = {r.id: r.user_authentication for r in C.fill_auth(df, FIXTURE).collect()}
    assert got == {"1": FIXTURE.default_auth, "2": FIXTURE.default_auth, "3": "X"}


def test_derive_time_formats_and_buckets(spark):
    rows = [("a", "2024-01-01 00:00"), ("b", "2024-01-01 05:59"), ("c", "2024-01-01 06:00"),
            ("d", "2024-01-01 09:00"), ("e", "2024-01-01 12:00"), ("f", "2024-01-01 18:00"),
            ("g", "2024-01-01 22:00"), ("h", "2024-01-01 23:59"), ("i", "2024-01-01 03:04:05"),
            ("j", "garbage"), ("k", None)]
    df = spark.createDataFrame(rows, "id string, created_at string")
    got = {r.id: r for r in C.derive_time(df, FIXTURE).collect()}
    p = FIXTURE.periods
    assert [got[k].time_period for k in "abcdefgh"] == [p[0], p[0], p[1], p[2], p[3], p[4], p[5], p[5]]
    assert got["i"].hour == 3 and got["i"].dt == "2024-01-01"          # seconds accepted
    assert got["j"].created_at is None and got["j"].time_period == p[5]  # NULL hour -> last bucket
    assert got["k"].dt is None


def test_explode_region_forms(spark):
    locs = [("1", "A"), ("2", "A | B"), ("3", "A|B"), ("4", "A |  | B"), ("5", ""), ("6", None)]
    df = spark.createDataFrame(locs, "id string, location string")
    got = sorted((r.id, r.region) for r in C.explode_region(df, keep=["id"]).collect())
    assert got == [("1", "A"), ("2", "A"), ("2", "B"), ("3", "A|B"), ("4", "A"), ("4", "B")]


def test_clean_posts_dedup_and_null_id(spark):
    msgs = [json.dumps({"id": "1", "text": "first version here", "created_at": "2024-01-01 10:00"}),
            json.dumps({"id": "1", "text": "second version here", "created_at": "2024-01-01 11:00"}),
            json.dumps({"text": "no id at all here"})]
    out = C.clean_posts(C.parse_posts(_raw(spark, msgs)), FIXTURE).collect()
    assert [(r.id, r.text) for r in out] == [("1", "second version here")]


def test_single_parse_equals_fieldwise_extraction(spark):
    from murmur.functions.json import post_fields, post_fields_fieldwise
    from murmur.sources.posts_view import posts_with_text, raw_messages
    from conftest import SF0001
    edge = ["{not json", "[1, 2]", "null", json.dumps({"id": "1", "reposts_count": "7", "text": None}),
            json.dumps({"id": 2, "text": "a\nb \u00e9", "comments_count": 12.7, "location": ""}),
            json.dumps({"id": "3", "attitudes_count": True, "topics": {"a": 1}})]
    raw = _raw(spark, edge).unionByName(raw_messages(posts_with_text(spark, SF0001, FIXTURE)))
    one = raw.select(*post_fields(F.col("json_data")))
    many = raw.select(*post_fields_fieldwise(F.col("json_data")))
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0


def test_copies_alone_are_shuffled(spark):
    import io
    from contextlib import redirect_stdout
    from murmur.operators import dedup
    from murmur.operators.dedup import latest_of_repeated, latest_per_key
    rows = [(str(i % 900), f"2024-01-01 10:{i % 7:02d}", f"text {i % 450}") for i in range(1000)] + [("7", "2024-01-01 10:06", "text 7")] * 2
    df = spark.createDataFrame(rows, "id string, created_at string, text string")
    want = latest_per_key(df, ["id"], "created_at").collect()
    for most in (10, dedup.BROADCAST_KEYS):
        before, dedup.BROADCAST_KEYS = dedup.BROADCAST_KEYS, most
        try:
            got = latest_of_repeated(df, ["id"], "created_at").collect()
        finally:
            dedup.BROADCAST_KEYS = before
        assert sorted(got) == sorted(want)
    alone = df.dropDuplicates(["id"]).localCheckpoint()
    msgs = [json.dumps({"id": r.id, "created_at": r.created_at, "text": r.text}) for r in alone.collect()]
    shown = io.StringIO()
    with redirect_stdout(shown):
        C.clean_posts(C.parse_posts(_raw(spark, msgs)), FIXTURE).explain()
    assert "Exchange" not in shown.getvalue()               # no text moves if no id has a copy


def test_messages_and_texts_are_worked_on_once(spark):
    msgs = [json.dumps({"id": "1", "text": "a text that stays @you"}), "{not json", json.dumps({"id": "2", "text": "short"})]
    out = C.clean_text(C.parse_posts(_raw(spark, msgs)).where("id IS NOT NULL"), REFERENCE.with_(blocklist=("qq", "zz")))
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1 and plan.count("regexp_replace") == 1
    assert [(r.id, r.text) for r in out.collect()] == [("1", "a text that stays ")]
    assert C.parse_posts(_raw(spark, [*msgs, None])).where("id IS NULL AND vip_level IS NULL").count() == 2
