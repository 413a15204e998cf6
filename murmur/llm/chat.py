"""Chat formatting in budgeted, turn-aligned windows.

A conversation is its rows by (turn, role, text).  Prefix sums of turn tokens
choose the windows: a turn belongs to the window in whose token range it ends.
Each window repeats the leading system turn and, up to ``history`` tokens, the
last turns of the window before it; repeated turns are context, never targets.
The prefix sums have two levels (within blocks of turns, then over blocks), so
one long conversation is spread over many tasks.

Template: ``<|turn|>role\\ntext<|end|>\\n``.  In texts and roles a backslash is
doubled and every control string gets ``\\.`` after its first character, so none is
left; ``unescape`` undoes both.

``loss`` holds the spans (code points of ``formatted``) of the assistant texts
that are targets.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

TURN, END = "<|turn|>", "<|end|>"
# Control strings of common chat templates; names in bars are taken by rule.
CONTROLS = ("<s>", "</s>", "<unk>", "<pad>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_CONTROL = r"<\|[A-Za-z0-9_]+\|>|" + "|".join(re.escape(c).replace("/", "\\/") for c in CONTROLS)
BLOCK = 64                      # turns that are summed together first
TOKEN = r"\w+|[^\w\s]"
TURN_TOKENS = 4                 # of the template, for each turn


def escape(text: Column) -> Column:
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, rf"(?s)(?={_CONTROL})(.)", r"$1\\.")


def unescape(text: str) -> str:
    return re.sub(r"\\(.)", lambda m: {".": "", "n": "\n"}.get(m[1], m[1]), text, flags=re.S) if "\\" in text else text


def windows(turns: DataFrame, budget: int = 2048, history: int = 256, key: str = "conv_id") -> DataFrame:
    """``conv``, ``window`` (from 1), ``formatted``, ``loss``, ``n_repeated`` (context
    turns, which come first) and ``tokens``.

    A window of turns of at most half the free budget each never exceeds the
    budget (free: what the system turn and the history leave); a longer turn
    gets the room it needs, as nothing is cut.  Null roles and texts are
    empty, null turns come first, rows with a null key form a conversation of
    their own, equal rows are separate turns; no rows give no windows.
    """
    t = turns.select(F.col(key).alias("conv"), F.col("turn"), F.coalesce("role", F.lit("")).alias("role"),
                     F.coalesce("text", F.lit("")).alias("text"))
    t = (t.withColumn("tokens", F.regexp_count("text", F.lit(TOKEN)).cast("long") + TURN_TOKENS)
         .withColumn("block", F.coalesce(F.floor(F.col("turn") / BLOCK), F.lit(-(1 << 62)))))
    inside = Window.partitionBy("conv", "block").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    t = (t.withColumn("nth", F.row_number().over(inside).cast("long"))
         .withColumn("upto", F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, 0))))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = (t.groupBy("conv", "block").agg(F.count("*").alias("n"), F.sum("tokens").alias("s"))
              .select(F.col("conv").alias("b_conv"), F.col("block").alias("b_block"),
                      F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
                      F.coalesce(F.sum("s").over(before), F.lit(0)).alias("s_before")))
    t = (t.join(blocks, t.conv.eqNullSafe(blocks.b_conv) & (t.block == blocks.b_block))
         .select("conv", "role", "text", "tokens", (F.col("nth") + F.col("n_before")).alias("pos"),
                 (F.col("upto") + F.col("s_before")).alias("end")))

    system = t.where("pos = 1 AND role = 'system'").select(
        F.col("conv").alias("s_conv"), F.col("text").alias("s_text"), F.col("tokens").alias("s_tokens"))
    rest = (t.join(system.select("s_conv", "s_tokens"), F.col("conv").eqNullSafe(F.col("s_conv")), "left")
            .where("NOT (pos = 1 AND role = 'system')")
            .withColumn("lead", F.coalesce("s_tokens", F.lit(0)))
            .withColumn("width", F.greatest(F.floor((F.lit(budget - history) - F.col("lead")) / 2), F.lit(max(1, budget // 8))))
            .withColumn("end", F.col("end") - F.col("lead"))
            .withColumn("bin", F.floor((F.col("end") - 1) / F.col("width")))
            .drop("s_conv", "s_tokens", "width", "lead"))
    order = Window.partitionBy("w_conv").orderBy("w_bin")
    spans = (rest.groupBy(F.col("conv").alias("w_conv"), F.col("bin").alias("w_bin")).agg(F.max("end").alias("w_end"))
             .withColumn("window", F.row_number().over(order))
             .withColumn("more", F.lead("w_bin").over(order).isNotNull()))
    placed = rest.join(spans, F.col("conv").eqNullSafe(F.col("w_conv")) & (F.col("bin") == F.col("w_bin")))
    repeat = F.col("more") & (F.col("end") - F.col("tokens") >= F.col("w_end") - history)
    uses = F.when(repeat, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    rows = (placed.select("conv", "window", "pos", "role", "text", "tokens", F.explode(uses).alias("use"))
            .select("conv", (F.col("window") + F.col("use")).alias("window"), "pos", "role", "text", "tokens",
                    (F.col("use") == 0).alias("target")))
    lead = (system.select(F.col("s_conv").alias("conv"), F.lit(1).alias("window"), F.lit(1).cast("long").alias("pos"),
                          F.lit("system").alias("role"), F.col("s_text").alias("text"), F.col("s_tokens").alias("tokens"),
                          F.lit(True).alias("target")))
    again = (spans.where("window > 1").join(system, F.col("w_conv").eqNullSafe(F.col("s_conv")))
             .select(F.col("s_conv").alias("conv"), "window", F.lit(1).cast("long").alias("pos"), F.lit("system").alias("role"),
                     F.col("s_text").alias("text"), F.col("s_tokens").alias("tokens"), F.lit(False).alias("target")))
    return _format(rows.unionByName(lead).unionByName(again))


def _format(rows: DataFrame) -> DataFrame:
    """Windows from their turns; a group is one window, so it is bounded by the budget or one turn."""
    head = F.concat(F.lit(TURN), F.regexp_replace(escape(F.col("role")), "\n", r"\\n"), F.lit("\n"))
    rows = rows.select("conv", "window", F.struct(
        "pos", "target", "tokens", head.alias("head"), escape(F.col("text")).alias("body"),
        (F.col("target") & (F.col("role") == "assistant")).alias("loss")).alias("turn"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        body = acc["at"] + F.length(x["head"])
        end = body + F.length(x["body"])
        span = F.struct(body.alias("start"), end.alias("end"))
        return F.struct((end + len(END) + 1).alias("at"),
                        F.when(x["loss"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    return (rows.groupBy("conv", "window").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
            .select("conv", "window",
                    F.array_join(F.transform("turns", lambda x: F.concat(x["head"], x["body"], F.lit(END + "\n"))), "").alias("formatted"),
                    F.aggregate("turns", start, step)["spans"].alias("loss"),
                    F.size(F.filter("turns", lambda x: ~x["target"])).alias("n_repeated"),
                    F.aggregate("turns", F.lit(0).cast("long"), lambda a, x: a + x["tokens"]).alias("tokens")))


_PARSE = re.compile(re.escape(TURN) + r"(.*?)\n(.*?)" + re.escape(END) + r"\n", re.S)


def parse(formatted: str) -> list[tuple[str, str]]:
    """(role, text) of each turn of a formatted window."""
    return [(unescape(m[1]), unescape(m[2])) for m in _PARSE.finditer(formatted)]


def digest(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from the windows: n_turns, turns_sha256 (role,
    line feed, text, line feed of each target turn), loss_chars, loss_sha256
    (the unescaped text under the loss spans) and formatted_chars.

    A digest runs over a whole conversation in order; each task streams its
    conversations window by window and holds one window.
    """
    kind = formatted.schema["conv"].dataType.simpleString()
    schema = f"conv {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    out = pa.schema([("conv", pa.int64() if kind == "bigint" else pa.string()), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
                     ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, None

        def close(conv, s):
            return {"conv": conv, "n_turns": s[0], "turns_sha256": s[1].hexdigest(), "loss_chars": s[2],
                    "loss_sha256": s[3].hexdigest(), "formatted_chars": s[4]}

        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if state is None or row["conv"] != current:
                    if state is not None:
                        done.append(close(current, state))
                    current, state = row["conv"], [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                text = row["formatted"]
                for role, body in parse(text)[row["n_repeated"]:]:
                    state[0] += 1
                    state[1].update(f"{role}\n{body}\n".encode("utf-8"))
                for span in row["loss"]:
                    under = unescape(text[span["start"]:span["end"]])
                    state[2] += len(under)
                    state[3].update(under.encode("utf-8"))
                state[4] += len(text)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema=out)
        if state is not None:
            yield pa.RecordBatch.from_pylist([close(current, state)], schema=out)

    return (formatted.select("conv", "window", "formatted", "loss", "n_repeated")
            .repartition("conv").sortWithinPartitions("conv", "window").mapInArrow(run, schema))
