"""Occurrences of a whole table of terms in texts, at a cost that does not grow with the number of terms.

Texts and terms are sequences of units (words, or characters for scripts without spaces).  Terms are grouped by the
largest power of two that is no more than their length; the hash of that many leading units is a term's key.  At each
position of a text one n-gram is hashed for each *group* in use (a term table of lengths 1 to 31 has five), looked up, and
the units that follow are compared with the whole term, so equal hashes of different n-grams do no harm.

Long texts are dealt as blocks of units that overlap by the longest term, so that no row carries more than a block.  A table
of at most ``broadcast_bytes`` is broadcast.  A larger one is joined by a shuffle of n-grams, one row for each text and
n-gram (and a batch of rows): a bitmap of hashes (``BITS_A_TERM`` bits a term, ``MOST_BITS`` at most) first leaves out
nearly all n-grams that are no term; what it lets through by chance meets no term in the join.  There an n-gram is hashed
for each *length* in use.  Both ways give the same rows.

Null and empty texts and terms have no units and no hits; equal terms count once; rows with equal ids add up; null ids
form one group; other columns are ignored; empty tables give no rows.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from murmur.functions.text import WORD
from murmur.operators.neighbours import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])         # executors need no copy of this package

BLOCK = 512
BROADCAST_BYTES = 32 << 20
BITS_A_TERM = 16
MOST_BITS = 1 << 28
PLACES = 4
#: Repeated ids of texts that are broadcast.
FEW_IDS = 500_000
#: In place of a null group, after all others.
NO_GROUP = 1 << 40
#: Units looked at, and sums held by a worker, at a time.
UNITS = 1 << 17
CELLS = 1 << 22


def words(c: Column) -> Column:
    """Letter and digit runs."""
    return F.regexp_extract_all(c, F.lit(WORD), 0)


def characters(c: Column) -> Column:
    """Single code points, for terms that are looked for anywhere in a text."""
    return F.regexp_extract_all(c, F.lit("(?s)."), 0)


def term_table(terms: DataFrame, units: Callable[[Column], Column] = words, term: str = "term") -> DataFrame:
    """``term, wanted, size, lead, key``: each distinct term with its units, their number, its group and its hash."""
    size = F.size("wanted")
    lead = F.expr("shiftleft(1, length(bin(size(wanted))) - 1)")
    return (terms.select(F.col(term).alias("term")).where(F.col("term").isNotNull()).distinct()
            .withColumn("wanted", units(F.col("term"))).where(size > 0)
            .select("term", "wanted", size.alias("size"), lead.alias("lead"))
            .withColumn("key", F.xxhash64("lead", F.slice("wanted", 1, F.col("lead")))))


def _blocks(texts: DataFrame, id_col: str, text_col: str, units, longest: int) -> DataFrame:
    """``id, block, part, own``: blocks of units with those a term that starts inside may need; ``own`` positions start inside."""
    u = texts.select(F.col(id_col).alias("id"), units(F.col(text_col)).alias("u")).where(F.size("u") > 0)
    starts = F.sequence(F.lit(0), F.floor((F.size("u") - 1) / BLOCK).cast("int"))
    part = F.transform(starts, lambda b: F.struct(
        F.slice("u", b * BLOCK + 1, F.lit(BLOCK + longest - 1)).alias("part"),
        F.least(F.lit(BLOCK), F.size("u") - b * BLOCK).alias("own")))
    return u.select("id", F.posexplode(part).alias("block", "b")).select("id", "block", "b.part", "b.own")


def _grams(blocks: DataFrame, leads: list[int]) -> DataFrame:
    """``id, block, key, seen``: at each position and for each group the hash of the leading units and all that a term of
    the group may need."""
    def at(lead: int) -> Column:
        ends = F.least(F.col("own"), F.size("part") - lead + 1)
        here = F.when(ends >= 1, F.sequence(F.lit(1), ends)).otherwise(F.array().cast("array<int>"))
        return F.transform(here, lambda i: F.struct(
            F.xxhash64(F.lit(lead), F.slice("part", i, F.lit(lead))).alias("key"),
            F.slice("part", i, F.lit(2 * lead - 1)).alias("seen")))
    return blocks.select("id", "block", F.inline(F.concat(*[at(k) for k in leads])))


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well spread 64-bit hashes of 64-bit values."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def _rolled(units: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` units that start at each position, from hashes of the units."""
    n = max(len(units) - size + 1, 0)
    h = np.full(n, size, np.uint64)
    for k in range(size):
        h = h * np.uint64(0x9E3779B97F4A7C15) + units[k:][:n]
    return _mixed(h)


def _place(h: np.ndarray, i: int, bits: int) -> np.ndarray:
    """The ``i``-th of the ``PLACES`` places of a hash in a bitmap of ``bits`` (a power of two, 2**32 at most)."""
    return (h + np.uint64(i) * (h >> np.uint64(32) | np.uint64(1))) & np.uint64(bits - 1)


def _bitmap(known: DataFrame, terms: int) -> np.ndarray:
    """Bytes of a bitmap in which the places of every term are set; each task fills one of its own, at most
    ``MOST_BITS`` bits, sent as pieces that are not empty and merged by place."""
    bits = 1 << max(16, min(MOST_BITS.bit_length() - 1, (BITS_A_TERM * terms - 1).bit_length()))
    piece = 1 << 13                                         # bytes

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = np.zeros(bits // 8, np.uint8)
        for b in batches:
            units, starts, _ = _flat(b.column(0))
            sizes = np.diff(np.append(starts, len(units)))
            for size in np.unique(sizes):
                at = starts[sizes == size]
                rows = units[at[:, None] + np.arange(size)]
                h = np.full(len(at), size, np.uint64)
                for k in range(size):
                    h = h * np.uint64(0x9E3779B97F4A7C15) + rows[:, k]
                h = _mixed(h)
                for i in range(PLACES):
                    place = _place(h, i, bits)
                    np.bitwise_or.at(own, (place >> np.uint64(3)).astype(np.int64), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))
        pieces = own.reshape(-1, min(piece, len(own)))
        for i in np.flatnonzero(pieces.any(axis=1)):
            yield pa.RecordBatch.from_arrays([pa.array([int(i)], pa.int32()), pa.array([pieces[i].tobytes()], pa.binary())], ["piece", "bits"])

    def merge(piece: pa.Table) -> pa.Table:
        whole = np.bitwise_or.reduce([np.frombuffer(x.as_py(), np.uint8) for x in piece.column("bits")])
        return pa.table({"piece": piece.column("piece")[:1], "bits": pa.array([whole.tobytes()], pa.binary())})

    parts = known.select(_hashes(F.col("wanted"))).mapInArrow(fill, "piece int, bits binary")
    out = np.zeros((max(1, bits // 8 // piece), min(piece, bits // 8)), np.uint8)
    for r in parts.groupBy("piece").applyInArrow(merge, "piece int, bits binary").toLocalIterator():
        out[r["piece"]] = np.frombuffer(r["bits"], np.uint8)
    return out.reshape(-1)


def _hashes(units: Column) -> Column:
    return F.transform(units, lambda u: F.xxhash64(u))


def _flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of all lists, and where each list starts and ends."""
    offsets = lists.offsets.to_numpy().astype(np.int64)
    values = lists.values.to_numpy(zero_copy_only=False).view(np.uint64)[offsets[0]:offsets[-1]]
    return values, offsets[:-1] - offsets[0], offsets[1:] - offsets[0]


def _likely(hashes: pa.Array, own: pa.Array, sizes: list[int], known: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Row and place in it of each unit, and for each size the units at which an n-gram begins that the bitmap does not rule out."""
    units, starts, ends = _flat(hashes)
    row = np.repeat(np.arange(len(starts)), ends - starts)
    at = np.arange(len(units)) - starts[row]
    left = ends[row] - starts[row] - at
    inside = at < own.to_numpy(zero_copy_only=False)[row]
    found = []
    for size in sizes:
        here = np.flatnonzero((inside & (left >= size))[:max(len(units) - size + 1, 0)])
        h = _rolled(units, size)[here]
        for i in range(PLACES):
            place = _place(h, i, bits)
            hit = (known[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8) & np.uint8(1)) == 1
            here, h = here[hit], h[hit]
        found.append(here)
    return row, at, found


def _candidates(blocks: DataFrame, sizes: list[int], bitmap: np.ndarray) -> DataFrame:
    """``id, gram, n``: the n-grams of the ``sizes`` that the bitmap does not rule out, counted in batches of positions."""
    held = blocks.sparkSession.sparkContext.broadcast(bitmap)
    bits = 8 * len(bitmap)

    @F.arrow_udf("array<struct<at:int,size:int>>")
    def likely(hashes: pa.Array, own: pa.Array) -> pa.Array:
        row, at, found = _likely(hashes, own, sizes, held.value, bits)
        here = np.concatenate([np.zeros(0, np.int64), *found])
        size = np.repeat(np.array(sizes, np.int32), [len(x) for x in found])
        order = np.argsort(here, kind="stable")
        here, size = here[order], size[order]
        offsets = np.searchsorted(row[here], np.arange(len(hashes) + 1))
        values = pa.StructArray.from_arrays([pa.array(at[here] + 1, pa.int32()), pa.array(size, pa.int32())], ["at", "size"])
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)

    met = blocks.select("id", "part", F.explode(likely(_hashes(F.col("part")), F.col("own"))).alias("m"))
    met = met.select("id", _spelt(F.slice("part", F.col("m.at"), F.col("m.size"))).alias("gram"), F.lit(1).cast("long").alias("n"))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            t = pa.Table.from_batches([b]).group_by(["id", "gram"]).aggregate([("n", "sum")])
            yield from t.select(["id", "gram", "n_sum"]).rename_columns(["id", "gram", "n"]).to_batches()

    return met.mapInArrow(counted, met.schema)


def _spelt(units: Column) -> Column:
    """Units as one string, different for different units."""
    return F.array_join(F.transform(units, lambda u: F.concat(F.length(u), F.lit(":"), u)), "")


def term_hits(texts: DataFrame, terms: DataFrame, id_col: str = "id", text_col: str = "text", term: str = "term",
              units: Callable[[Column], Column] = words, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``id, term, n``: the positions at which each term occurs in each text (occurrences may overlap).

    The number, the groups, the lengths and the size of the terms are one aggregate of the term table; that and the bitmap
    of a large one, nothing else, reach the driver.
    """
    known = term_table(terms, units, term)
    facts = known.agg(F.collect_set("lead").alias("leads"), F.collect_set("size").alias("sizes"), F.count(F.lit(1)).alias("terms"),
                      F.max("size").alias("longest"), F.sum(F.octet_length("term") + F.lit(64) + 16 * F.col("size")).alias("bytes")).first()
    longest = facts["longest"] or 1
    if (facts["bytes"] or 0) <= broadcast_bytes:
        grams = _grams(_blocks(texts, id_col, text_col, units, longest), sorted(facts["leads"]) or [1])
        met = grams.join(F.broadcast(known.drop("lead")), "key")
        return (met.where(F.slice("seen", 1, F.col("size")) == F.col("wanted"))
                .groupBy("id", "term").agg(F.count(F.lit(1)).alias("n")))
    known = stored(known.select("term", "wanted"), "terms")
    grams = _candidates(_blocks(texts, id_col, text_col, units, longest), sorted(facts["sizes"]), _bitmap(known, facts["terms"]))
    counted = grams.repartition(F.col("gram")).groupBy("id", "gram").agg(F.sum("n").alias("n"))     # one shuffle for count and join
    return counted.join(known.select("term", _spelt(F.col("wanted")).alias("gram")), "gram").select("id", "term", "n")


def _pairs(t: pa.Table, sizes: list[int], known: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """``(grams, gram, text, n)``: how often each likely n-gram occurs in each text of whole texts; by gram and text."""
    column = lambda name: t.column(name).combine_chunks()
    _, _, found = _likely(column("hashes"), column("own"), sizes, known, 8 * len(known))
    part = column("part")
    row = np.repeat(np.arange(len(part)), np.diff(part.offsets.to_numpy()))
    text = (np.cumsum(column("block").to_numpy(zero_copy_only=False) == 0) - 1)[row]
    coded = part.flatten().dictionary_encode()
    code, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    grams: list[str] = []
    which = []
    for size, here in zip(sizes, found, strict=True):
        g = code[here]
        for k in range(1, size):
            g = np.unique(g, return_inverse=True)[1] * len(words) + code[here + k]
        _, first, number = np.unique(g, return_index=True, return_inverse=True)
        spelt = [""] * len(first)
        for k in range(size):
            spelt = [f"{x}{len(w)}:{w}" for x, w in zip(spelt, words.take(pa.array(code[here[first] + k])).to_pylist(), strict=True)]
        which.append(number + len(grams))
        grams += spelt
    texts = int(text[-1]) + 1 if len(text) else 1
    key, n = np.unique(np.concatenate([np.zeros(0, np.int64), *which]) * texts + text[np.concatenate([np.zeros(0, np.int64), *found])], return_counts=True)
    return grams, key // texts, key % texts, n


def _whole_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Runs of whole texts (a text's blocks follow each other) of some ``UNITS`` units."""
    held = None
    for b in batches:
        t = pa.Table.from_batches([b])
        t = t if held is None else pa.concat_tables([held, t])
        starts = np.flatnonzero(t.column("block").to_numpy() == 0)
        units = np.cumsum(np.concatenate([[0], t.column("own").to_numpy()]))
        a = 0
        while a < starts[-1]:
            to = starts[(starts > a) & (units[starts] - units[a] <= UNITS)]
            to = int(to[-1]) if len(to) else int(starts[starts > a][0])
            yield t.slice(a, to - a)
            a = to
        held = t.slice(a)
    if held is not None and len(held):
        yield held


class _Sums:
    """Sums by gram and column (a group, say), at most ``CELLS`` and one run of texts."""

    def __init__(self) -> None:
        self.row: dict[str, int] = {}
        self.sums = np.zeros((0, 0), np.int64)

    def add(self, grams: list[str], sums: np.ndarray) -> None:
        at = np.array([self.row.setdefault(g, len(self.row)) for g in grams], np.int64)
        rows, columns = max(len(self.row), 1), max(sums.shape[1], self.sums.shape[1])
        if rows > self.sums.shape[0] or columns > self.sums.shape[1]:
            more = np.zeros((max(rows, self.sums.shape[0], min(2 * self.sums.shape[0], CELLS // columns)), columns), np.int64)
            more[:self.sums.shape[0], :self.sums.shape[1]] = self.sums
            self.sums = more
        self.sums[at, :sums.shape[1]] += sums

    def full(self) -> bool:
        return len(self.row) * max(self.sums.shape[1], 1) > CELLS

    def taken(self, step: int = 1 << 16) -> Iterator[tuple[pa.Array, np.ndarray]]:
        grams, sums = list(self.row), self.sums
        self.row, self.sums = {}, np.zeros((0, 0), np.int64)
        for a in range(0, len(grams), step):
            yield pa.array(grams[a:a + step], pa.string()), sums[a:min(a + step, len(grams))]


def _packed(grams: pa.Array, groups: np.ndarray, sums: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The sums that are not 0: a byte each for the group (its distance to the first) and the sum where that holds all of
    a gram's; the other lists are empty."""
    order = np.argsort(groups, kind="stable")
    groups, sums = groups[order], sums[:, order]
    some = sums != 0
    first = groups[some.argmax(axis=1)]
    last = groups[len(groups) - 1 - some[:, ::-1].argmax(axis=1)]
    small = (last != NO_GROUP) & (last - first <= 127) & (sums.max(axis=1) <= 127) & (sums.min(axis=1) >= 0)
    for narrow in (True, False):
        mine = np.flatnonzero(small == narrow)
        if not len(mine):
            continue
        none = lambda kind: pa.ListArray.from_arrays(pa.array(np.zeros(len(mine) + 1), pa.int32()), pa.array([], kind))  # noqa: B023, E731
        row, col = np.nonzero(some[mine])
        ends = pa.array(np.searchsorted(row, np.arange(len(mine) + 1)), pa.int32())
        group, n = groups[col], sums[mine][row, col]
        if narrow:
            each = [(group - first[mine][row]).astype(np.int8), n.astype(np.int8)]
            lists = [pa.ListArray.from_arrays(ends, pa.array(x)) for x in each]
            lists = [pa.array(first[mine], pa.int32()), *lists, none(pa.int32()), none(pa.int64())]
        else:
            each = [pa.array(np.where(group == NO_GROUP, 0, group), pa.int32(), mask=group == NO_GROUP), pa.array(n)]
            lists = [pa.ListArray.from_arrays(ends, x) for x in each]
            lists = [pa.nulls(len(mine), pa.int32()), none(pa.int8()), none(pa.int8()), *lists]
        yield pa.RecordBatch.from_arrays([grams.take(pa.array(mine)), *lists], ["gram", "first", "gap", "few", "group", "n"])


def _facts(known: DataFrame) -> tuple[list[int], int, int]:
    """Sizes in use, the longest and the number of the terms."""
    f = known.agg(F.collect_set("size").alias("sizes"), F.count(F.lit(1)).alias("terms")).first()
    return sorted(f["sizes"]), max(f["sizes"], default=1), f["terms"]


def group_hits(texts: DataFrame, terms: DataFrame, groups: str = "groups", text_col: str = "text", term: str = "term",
               units: Callable[[Column], Column] = words) -> DataFrame:
    """``group, term, hits``: the occurrences of each term in the texts of each group.  ``groups`` of a text is an array of
    ``(group int, weight long)``: its groups and how often it counts there (above 0).

    A task sums over all its texts, so that a row is shuffled for each gram of a task, not for each of a text.
    """
    known = stored(term_table(terms, units, term).select("term", "wanted", "size"), "terms")
    sizes, longest, count = _facts(known)
    schema = "gram string, first int, gap array<tinyint>, few array<tinyint>, group array<int>, n array<bigint>"
    blocks = _blocks(texts.where(F.size(groups) > 0), groups, text_col, units, longest)
    held = texts.sparkSession.sparkContext.broadcast(_bitmap(known, count))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc, days = _Sums(), {}

        def out() -> Iterator[pa.RecordBatch]:
            number = np.array([NO_GROUP if d is None else d for d in days], np.int64)
            for grams, sums in acc.taken():
                yield from _packed(grams, number[:sums.shape[1]], sums)

        for t in _whole_texts(batches):
            grams, gram, text, n = _pairs(t, sizes, held.value)
            mine = t.filter(pc.equal(t.column("block"), 0)).column("id").combine_chunks()
            start, each = mine.offsets.to_numpy().astype(np.int64), mine.flatten()
            start = start - start[0]
            coded = each.field(0).dictionary_encode(null_encoding="encode")
            number = np.array([days.setdefault(d, len(days)) for d in coded.dictionary.to_pylist()], np.int64)
            day, weight = number[coded.indices.to_numpy()], each.field(1).to_numpy()
            many = np.diff(start)[text]
            width = max(len(days), 1)
            step = max(1, CELLS // 2 // width)
            for low in range(0, len(grams), step):                      # a bounded number of sums at a time
                a, b = np.searchsorted(gram, [low, low + step])
                wide = min(step, len(grams) - low)
                part = np.zeros(wide * width, np.int64)
                ends = np.cumsum(many[a:b])
                while a < b:                                            # and of pairs with their groups
                    c = a + max(1, int(np.searchsorted(ends, (ends[a - b] - many[a]) + CELLS // 8, side="right")) - (len(ends) - (b - a)))
                    c = min(c, b)
                    rep = many[a:c]
                    at = np.repeat(start[text[a:c]] - (np.cumsum(rep) - rep), rep) + np.arange(rep.sum())
                    key = np.repeat(gram[a:c] - low, rep) * width + day[at]
                    part += np.bincount(key, np.repeat(n[a:c], rep) * weight[at], wide * width).astype(np.int64)
                    a = c
                acc.add(grams[low:low + wide], part.reshape(wide, width))
                if acc.full():
                    yield from out()
        yield from out()

    rows = blocks.select("id", "block", "own", "part", _hashes(F.col("part")).alias("hashes")).mapInArrow(summed, schema)
    spelt = known.select("term", _spelt(F.col("wanted")).alias("gram"))
    met = rows.join(spelt, "gram").select("gram", "term", "first", F.inline(F.arrays_zip("gap", "few", "group", "n")))
    met = met.select("gram", "term", F.when(F.col("first").isNull(), F.col("group")).otherwise(F.col("first") + F.col("gap")).alias("group"),
                     F.coalesce("n", "few").alias("n"))
    return met.groupBy("gram", "term", "group").agg(F.sum("n").alias("hits")).select("group", "term", "hits")


def text_totals(texts: DataFrame, terms: DataFrame, id_col: str = "id", text_col: str = "text", term: str = "term",
                units: Callable[[Column], Column] = words) -> DataFrame:
    """``term, n_texts, n_hits``, as ``term_totals(term_hits(...))``, without a row for each text and term.

    A task sums over all its texts.  Texts whose id repeats (a null id too) are one text and take the way over their ids.
    """
    repeated = stored(texts.groupBy(F.col(id_col).alias("id")).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id"), "repeated")
    again = repeated.count()
    if again > FEW_IDS:
        return term_totals(term_hits(texts, terms, id_col, text_col, term, units))
    more = None
    if again:
        marked = texts.join(F.broadcast(repeated.select(F.col("id").alias("_again"), F.lit(True).alias("_more"))), F.col(id_col).eqNullSafe(F.col("_again")), "left")
        more = marked.where("_more").select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        texts = marked.where("_more IS NULL").select(F.col(id_col), F.col(text_col))
    known = stored(term_table(terms, units, term).select("term", "wanted", "size"), "terms")
    sizes, longest, count = _facts(known)
    held = texts.sparkSession.sparkContext.broadcast(_bitmap(known, count))

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        acc = _Sums()

        def out() -> Iterator[pa.RecordBatch]:
            for grams, sums in acc.taken():
                yield pa.RecordBatch.from_arrays([grams, pa.array(sums[:, 0]), pa.array(sums[:, 1])], ["gram", "n_texts", "n_hits"])

        for t in _whole_texts(batches):
            grams, gram, _, n = _pairs(t, sizes, held.value)
            acc.add(grams, np.stack([np.bincount(gram, minlength=len(grams)), np.bincount(gram, n, len(grams)).astype(np.int64)], axis=1))
            if acc.full():
                yield from out()
        yield from out()

    blocks = _blocks(texts, id_col, text_col, units, longest)
    rows = blocks.select("block", "own", "part", _hashes(F.col("part")).alias("hashes")).mapInArrow(summed, "gram string, n_texts bigint, n_hits bigint")
    add = [F.sum(c).alias(c) for c in ("n_texts", "n_hits")]
    spelt = known.select("term", _spelt(F.col("wanted")).alias("gram"))
    once = rows.groupBy("gram").agg(*add).join(spelt, "gram").select("term", "n_texts", "n_hits")
    if more is None:
        return once
    return once.unionByName(term_totals(term_hits(more, terms, "id", "text", term, units))).groupBy("term").agg(*add)


def term_totals(hits: DataFrame) -> DataFrame:
    """``term, n_texts, n_hits`` of the terms that occur."""
    return hits.groupBy("term").agg(F.count(F.lit(1)).alias("n_texts"), F.sum("n").alias("n_hits"))
