"""Cross-entropy difference of documents under a target and a background model.

Both are character n-gram models over one vocabulary (the lower-cased code points of
all documents), with the same orders and smoothing.  Counts are exact and cover every
document: each task pre-sums its n-grams, Spark adds them up into a table with one row
per distinct n-gram.  The background's counts are scaled to the target's total, so
smoothing weighs alike in both.

``p_n(c | h) = (count(h c) + a * p_{n-1}(c | h')) / (count(h) + a)``, from the uniform
distribution over the vocabulary up; the score of a document is the mean of
its per-token loss differences, target less background: the lower, the more like
the target.  The model stays a Spark table and grows with the corpus.  Documents are
stored in blocks of bounded size; the distinct n-grams of a block are joined to the
table by a shuffle, and what is found goes back to the block's documents.  A frequent
n-gram has one row per block there, not one per document or place.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from murmur.llm.common import slices, stored

BITS = 20
ORDERS = 4
SMOOTHING = 4.0
RUN_CHARS = 500_000
BLOCK_CHARS = 2_000_000
MARK = "\x02"


def _clean(text: str) -> str:
    return " ".join(text.lower().split())


def _grams(texts: list[str], orders: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of ``orders`` code points that end at each place of the texts and at the start
    mark before each, as rows, and the text each belongs to (-1 at marks)."""
    clean = [_clean(t) for t in texts]
    codes = np.frombuffer("".join(MARK * orders + t for t in clean).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.array([len(t) for t in clean])
    owner = np.repeat(np.arange(len(clean)), lengths + 1)
    starts = np.cumsum(lengths + 1) - lengths - 1
    owner[starts] = -1
    ends = np.arange(len(owner)) + np.repeat(np.arange(1, len(clean) + 1), lengths + 1) * (orders - 1)
    return np.lib.stride_tricks.sliding_window_view(codes, orders)[ends - (orders - 1)], owner


def _alphabet(grams: np.ndarray) -> np.ndarray:
    seen = np.zeros(0x110000, dtype=bool)
    seen[grams] = True
    return np.flatnonzero(seen)


def _keys(grams: np.ndarray, alphabet: np.ndarray) -> np.ndarray:
    """One sortable value per row, equal only for equal rows: a number while all rows over the
    alphabet have room in 63 bits, else the bytes of the row."""
    orders = grams.shape[1]
    if len(alphabet) ** orders >= 1 << 63:
        return np.ascontiguousarray(grams).view(f"S{4 * orders}").ravel()
    rank = np.zeros(0x110000, dtype=np.int64)
    rank[alphabet] = np.arange(len(alphabet))
    keys = np.zeros(len(grams), dtype=np.int64)
    for j in range(orders):
        keys = keys * len(alphabet) + rank[grams[:, j]]
    return keys


def _distinct(grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct rows and how often each occurs."""
    orders, alphabet = grams.shape[1], _alphabet(grams)
    keys, n = np.unique(_keys(grams, alphabet), return_counts=True)
    if keys.dtype.kind == "S":
        return keys.view(np.uint32).reshape(-1, orders), n
    rows = np.empty((len(keys), orders), dtype=np.uint32)
    for j in range(orders - 1, -1, -1):
        keys, at = np.divmod(keys, len(alphabet))
        rows[:, j] = alphabet[at]
    return rows, n


def _binary(grams: np.ndarray) -> pa.Array:
    """Rows as binary values of four bytes a code point."""
    width = 4 * grams.shape[1]
    offsets = pa.py_buffer(np.arange(0, width * (len(grams) + 1), width, dtype=np.int32))
    return pa.Array.from_buffers(pa.binary(), len(grams), [None, offsets, pa.py_buffer(np.ascontiguousarray(grams))])


def _rows(column: pa.ChunkedArray, orders: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint32).reshape(-1, orders)


def counts(docs: DataFrame, bits: int = BITS, orders: int = ORDERS) -> DataFrame:
    """``gram`` (binary, four bytes a code point), ``target``, ``background`` over ``docs(text, is_target)``:
    a target row counts for the target, every row for the background.  Tasks pre-sum runs of
    ``2**bits`` characters, which bounds their memory and has no part in the result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bool, tuple[list[str], int]] = {True: ([], 0), False: ([], 0)}

        def sums(target: bool) -> pa.RecordBatch:
            grams, n = _distinct(_grams(held[target][0], orders)[0])
            held[target] = [], 0
            return pa.RecordBatch.from_arrays([_binary(grams), pa.array(n * target), pa.array(n)],
                                              names=["gram", "target", "background"])

        for batch in batches:
            for text, target in zip(batch.column("text").to_pylist(), batch.column("is_target").to_pylist()):
                if held[target][0] and held[target][1] + len(text) > 1 << bits:
                    yield sums(target)
                held[target][0].append(text)
                held[target] = held[target][0], held[target][1] + len(text) + orders
        for target in held:
            if held[target][0]:
                yield sums(target)

    return (docs.select("text", "is_target").mapInArrow(run, "gram binary, target long, background long")
            .groupBy("gram").agg(F.sum("target").alias("target"), F.sum("background").alias("background")))


def _tail(gram: Column, n: int) -> Column:
    """The last ``n`` code points."""
    return F.substring(gram, F.length(gram) - (4 * n - 1), F.lit(4 * n))


def _head(gram: Column, n: int) -> Column:
    return F.substring(gram, 1, 4 * n)


def fit(docs: DataFrame, bits: int = BITS, orders: int = ORDERS) -> dict:
    """The stored count table of each order over ``docs(text, is_target)``; null texts and flags count as empty and false."""
    docs = docs.select("text", F.coalesce("is_target", F.lit(False)).alias("is_target")).where("text IS NOT NULL AND text <> ''")
    tables = {orders: stored(counts(docs, bits, orders), f"grams-{orders}")}
    for n in range(orders - 1, 0, -1):          # every place has one n-gram of each order, so shorter ones are sums of longer
        shorter = (tables[n + 1].groupBy(_tail(F.col("gram"), n).alias("gram"))
                   .agg(F.sum("target").alias("target"), F.sum("background").alias("background")))
        tables[n] = stored(shorter, f"grams-{n}")
    got = tables[1].agg(F.sum("target"), F.sum("background"), F.count("*")).first()
    target, background = got[0] or 0, got[1] or 0
    scale = target / background if target and background else 1.0
    return {"tables": tables, "orders": orders, "vocabulary": max(1, got[2]), "scale": scale,
            "totals": (float(target), background * scale)}


def gram_losses(model: dict, grams: DataFrame) -> DataFrame:
    """``gram`` and its (target, background) losses ``t`` and ``b`` in nats, for distinct ``grams(gram)`` of the model's highest order."""
    sides = (("t", "target", 1.0), ("b", "background", model["scale"]))

    def found(n: int, name: str) -> DataFrame:
        return model["tables"][n].select(F.col("gram").alias(name), *[(F.col(c) * s).alias(f"{name}_{x}") for x, c, s in sides])

    def smoothed(x: str, shorter: Column, context: Column) -> Column:
        return (F.coalesce(f"at_{x}", F.lit(0.0)) + SMOOTHING * shorter) / (F.coalesce(context, F.lit(0.0)) + SMOOTHING)

    wanted = {model["orders"]: grams}
    for n in range(model["orders"] - 1, 0, -1):
        wanted[n] = wanted[n + 1].select(_tail(F.col("gram"), n).alias("gram")).distinct()
    known = None
    for n in range(1, model["orders"] + 1):
        df = wanted[n].join(found(n, "at"), F.col("gram") == F.col("at"), "left")
        if n == 1:
            df = df.select("gram", *[smoothed(x, F.lit(1 / model["vocabulary"]), F.lit(total)).alias(x)
                                     for (x, *_), total in zip(sides, model["totals"])])
        else:
            df = (df.withColumns({"tail": _tail(F.col("gram"), n - 1), "head": _head(F.col("gram"), n - 1)})
                  .join(known.select(F.col("gram").alias("tail"), F.col("t").alias("short_t"), F.col("b").alias("short_b")), "tail")
                  .join(found(n - 1, "in"), F.col("head") == F.col("in"), "left")
                  .select("gram", *[smoothed(x, F.col(f"short_{x}"), F.col(f"in_{x}")).alias(x) for x, *_ in sides]))
        known = df
    return known.select("gram", *[(-F.log(x)).alias(x) for x, *_ in sides])


def _blocks(docs: DataFrame, kind: str) -> DataFrame:
    """``docs(key, text)`` with the ``block`` of each row: a task's next rows of up to ``BLOCK_CHARS`` characters together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        block, size = TaskContext.get().partitionId() << 32, 0
        for batch in batches:
            at = []
            for text in batch.column("text").to_pylist():
                n = len(text or "") + 16
                if size and size + n > BLOCK_CHARS:
                    block, size = block + 1, 0
                size += n
                at.append(block)
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), batch.column("key"), batch.column("text")],
                                             names=["block", "key", "text"])

    return docs.mapInArrow(run, f"block long, key {kind}, text string")


def losses(texts: list[str | None], grams: np.ndarray, loss: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and summed (target, background) losses of each text; ``grams`` holds all their n-grams, ``loss`` two rows beside them."""
    orders = grams.shape[1]
    n, sums = np.zeros(len(texts), dtype=np.int64), np.zeros((len(texts), 2))
    live = [i for i, t in enumerate(texts) if t and not t.isspace()]
    alphabet = _alphabet(grams)
    keys = _keys(grams, alphabet)
    order = np.argsort(keys)
    keys, loss = keys[order], loss[:, order]
    for a, b in slices([texts[i] for i in live], RUN_CHARS):
        found, owner = _grams([texts[i] for i in live[a:b]], orders)
        here = owner >= 0
        rows, at = owner[here], np.searchsorted(keys, _keys(found[here], alphabet))
        n[live[a:b]] = np.bincount(rows, minlength=b - a)
        for m in range(2):
            sums[live[a:b], m] = np.bincount(rows, weights=loss[m][at], minlength=b - a)
    return n, sums


def score(docs: DataFrame, model: dict, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_tokens``, ``target_loss``, ``background_loss`` (nats a token) and ``score`` of every row.

    Null, empty and blank texts have no tokens, and nulls for the rest.  Equal rows score alike; null keys are returned;
    an empty table gives no rows; other columns are ignored, whatever their names.
    """
    orders, kind = model["orders"], docs.schema[key].dataType.simpleString()
    blocks = stored(_blocks(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), kind), "lm-blocks")

    def wanted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, held = None, []

        def grams() -> pa.RecordBatch:
            found, owner = _grams(held, orders)
            found = _distinct(found[owner >= 0])[0]
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(found), block)), _binary(found)], names=["block", "gram"])

        for batch in batches:
            for at, t in zip(batch.column("block").to_pylist(), batch.column("text").to_pylist()):
                if at != block and held:
                    yield grams()
                    held = []
                block = at
                if t and not t.isspace():
                    held.append(t)
        if held:
            yield grams()

    # A block that two tasks read is asked for twice: its reader takes equal rows as one.
    asked = stored(blocks.select("block", "text").mapInArrow(wanted, "block long, gram binary"), "lm-grams")
    answers = asked.join(gram_losses(model, asked.select("gram").distinct()), "gram")

    def scored(left: pa.Table, right: pa.Table) -> pa.Table:
        loss = np.array([right.column("t").to_numpy(), right.column("b").to_numpy()])
        n, sums = losses(left.column("text").to_pylist(), _rows(right.column("gram"), orders), loss)
        mean = sums / np.maximum(n, 1)[:, None]
        none = n == 0
        return pa.Table.from_arrays(
            [left.column("key"), pa.array(n)] + [pa.array(x, pa.float64(), mask=none) for x in (mean[:, 0], mean[:, 1], mean[:, 0] - mean[:, 1])],
            names=["key", "n_tokens", "target_loss", "background_loss", "score"])

    return (blocks.groupBy("block").cogroup(answers.groupBy("block"))
            .applyInArrow(scored, f"key {kind}, n_tokens long, target_loss double, background_loss double, score double"))
