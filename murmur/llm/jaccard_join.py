"""Jaccard similarity join of word shingle sets by PartEnum signatures.

Two sets are linked when ``100 * |A & B| >= threshold * |A | B|``.  Sizes are cut
into bands; linked sets share a band (a set also takes part in the higher bands
that a linked larger set may be in), and within a band they differ in at most
``k`` members.  The domain is hashed into first-level partitions, each into ``n2``
second-level ones; at most ``k2`` differences are left in some partition, so one
of the subsets of ``n2 - k2`` second-level partitions agrees in full: its hash is
a shared signature.  An empty agreement says nothing, so there are ``spare`` more
partitions than differences can spoil: as many as the smallest set of the band hardly
ever leaves empty.  Only sets that have more empty ones than that sign those too.

Equal sets are one node.  Nodes of a signature bucket become candidates in two
steps, so that no bucket is expanded into all its pairs: every node against the
bucket's first one (which links nearly all near copies), and then, in buckets that
still hold several components, nodes outside the largest one against the others, block by
block in numpy, where a short parity sketch rules out most.  Candidates of both steps
are compared by sketches as long as the sets have members, and verified on the sets themselves.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from murmur.llm.common import sized_join, stored
from murmur.llm.shingles import fingerprint, mix, shingle_sets

THRESHOLD = 85
SHINGLE = 4
GROWTH = 1.384                  # upper over lower size of a band
SUBSETS_UP_TO = 256             # bands of sets up to this size enumerate subsets (more signatures, fewer candidates)
SKETCH_BITS = 1024              # of the short sketch; that of a set has at least one for each member
MINOR_BLOCK, OTHER_BLOCK = 4096, 4096
SPARE_DEVIATIONS = 4            # empty partitions are allowed for up to their mean and so many standard deviations


def bands(threshold: int, up_to: int) -> list[tuple[int, int, int, int, int, int]]:
    """(low, high, k, n1, n2, spare) of each band until ``up_to``; ``k`` is the greatest
    difference of two linked sets of at most ``high`` members."""
    out, low = [], 1
    while low <= up_to:
        high = max(low, math.floor(low * GROWTH))
        k = (100 - threshold) * 2 * high // (100 + threshold)
        k2, n2 = (1, 3) if high <= SUBSETS_UP_TO else (0, 1)
        n1 = k // (k2 + 1) + 1
        spare = _spare(n1, n2, k2, max(1, -(-threshold * low // 100)))
        out.append((low, high, k, n1 + spare, n2, spare))
        low = high + 1
    return out


def _spare(n1: int, n2: int, k2: int, members: int) -> int:
    """Partitions beyond ``n1`` that make up for those a set of ``members`` leaves empty (in some subset to be signed)."""
    spare = 2
    while True:
        cells = n1 + spare
        empty = min(1.0, math.comb(n2, k2) * (1 - (n2 - k2) / (n2 * cells)) ** members)
        want = 1 + math.ceil(cells * empty + SPARE_DEVIATIONS * math.sqrt(cells * empty * (1 - empty)))
        if want <= spare or empty > 0.5:            # tiny sets can't fill partitions
            return spare
        spare = want


def signatures(sets: list[np.ndarray], threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Signatures of all ``sets`` and the index of the set each belongs to.

    Sets that can only be linked with equal ones have none.
    """
    plan = bands(threshold, 2 * max((len(s) for s in sets), default=1))
    jobs = [(i, b) for i, s in enumerate(sets) if len(s) for b, (low, high, k, *_) in enumerate(plan)
            if k and len(s) <= high and 100 * len(s) >= threshold * low]
    if not jobs:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    owner = np.array([i for i, _ in jobs])
    band = np.array([b for _, b in jobs], dtype=np.uint64)
    n1, n2, spare = (np.array([plan[b][c] for _, b in jobs], dtype=np.int64) for c in (3, 4, 5))
    members = np.concatenate([sets[i] for i in owner])
    job = np.repeat(np.arange(len(jobs)), [len(sets[i]) for i in owner])
    x = mix(members + (band[job] + np.uint64(1)) * np.uint64(0xA0761D6478BD642F))
    low32 = np.uint64(32)
    part = ((x >> low32) * n1[job].astype(np.uint64)) >> low32
    sub = ((x & np.uint64(0xFFFFFFFF)) * n2[job].astype(np.uint64)) >> low32
    cells = np.concatenate([[0], np.cumsum(n1 * n2)])
    cell = cells[job] + part.astype(np.int64) * n2[job] + sub.astype(np.int64)
    sums = np.zeros(cells[-1], dtype=np.uint64)
    np.add.at(sums, cell, mix(members ^ np.uint64(0xE7037ED1A0B428DB)))
    counts = np.bincount(cell, minlength=cells[-1])
    out_sig, out_job = [], []
    for width in (1, 3):
        mine = np.flatnonzero(n2 == width)
        if not len(mine):
            continue
        at = np.concatenate([np.arange(cells[j], cells[j + 1]) for j in mine]).reshape(-1, width)
        j = np.repeat(mine, n1[mine])
        first = np.concatenate([np.arange(n) for n in n1[mine]]).astype(np.uint64)
        choices = [(0,)] if width == 1 else [(0, 1), (0, 2), (1, 2)]
        empty = np.zeros(len(at), dtype=bool)
        for c in choices:
            empty |= counts[at[:, c]].sum(axis=1) == 0
        many = np.bincount(j[empty], minlength=len(jobs)) > spare       # these sign their empty subsets too
        for n, c in enumerate(choices):
            total = sums[at[:, c]].sum(axis=1, dtype=np.uint64)
            keep = (counts[at[:, c]].sum(axis=1) > 0) | many[j]
            tag = (band[j] * np.uint64(1 << 40) + first * np.uint64(4) + np.uint64(n)) * np.uint64(0x589965CC75374CC3)
            out_sig.append(mix(total + mix(tag))[keep])
            out_job.append(j[keep])
    return np.concatenate(out_sig), owner[np.concatenate(out_job)]


def sketch(s: np.ndarray, bits: int | None = None) -> bytes:
    """Parity of the members in each of ``bits`` cells (a power of two; by default at least one a member, and
    ``SKETCH_BITS``): two sketches of one length differ in no more cells than the sets differ in members."""
    bits = bits or max(SKETCH_BITS, 1 << (len(s) - 1).bit_length())
    cell = (mix(s ^ np.uint64(0x8EBC6AF09C88C6E3)) & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(cell, minlength=bits) & 1).astype(np.uint8)).tobytes()


def _fold(words: np.ndarray, size: int) -> np.ndarray:
    """A sketch shortened to ``size`` words: cells that agree modulo the shorter length are one."""
    while len(words) > size:
        words = words[:len(words) // 2] ^ words[len(words) // 2:]
    return words


def _apart(a: bytes, b: bytes) -> int:
    """Cells in which two sketches differ, at the length of the shorter one."""
    u, v = np.frombuffer(a, dtype=np.uint64), np.frombuffer(b, dtype=np.uint64)
    size = min(len(u), len(v))
    return int(np.bitwise_count(_fold(u, size) ^ _fold(v, size)).sum(dtype=np.int64))


def _may_link(apart: np.ndarray, na: np.ndarray, nb: np.ndarray, threshold: int) -> np.ndarray:
    """Pairs that their sketches and sizes do not rule out as linked."""
    apart = np.maximum(apart, np.abs(na - nb))
    return (100 + threshold) * apart <= (100 - threshold) * (na + nb)


def _words(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint64).reshape(len(column), -1)


def _ints(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _summaries(docs: DataFrame, k: int) -> DataFrame:
    """id, text_hash, fp, n of every row (fp: fingerprint of the set of n shingles)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(fingerprint(s), len(s)) for s in shingle_sets(batch.column("text"), k)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("text_hash"), pa.array([g[0] for g in got], pa.int64()), pa.array([g[1] for g in got], pa.int64())],
                names=["id", "text_hash", "fp", "n"])

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(run, f"id {kind}, text_hash long, fp long, n long")


def _signed(docs: DataFrame, k: int, threshold: int) -> DataFrame:
    """sig, node of every distinct set (a task signs equal sets once)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            held, nodes, size = [], [], 0

            def flush():
                sig, owner = signatures(held, threshold)
                node = np.array(nodes, dtype=np.int64)[owner]
                return pa.RecordBatch.from_arrays([pa.array(sig.view(np.int64)), pa.array(node)], names=["sig", "node"])

            for s in shingle_sets(batch.column("text"), k):
                fp = fingerprint(s)
                if fp in seen or not len(s):
                    continue
                seen.add(fp)
                held.append(s)
                nodes.append(fp)
                size += len(s)
                if size > 200_000:
                    yield flush()
                    held, nodes, size = [], [], 0
            if held:
                yield flush()

    return docs.select("text").mapInArrow(run, "sig long, node long")


def _buckets(signed: DataFrame) -> DataFrame:
    """sig, node, first of the signatures that several nodes share.

    ``first`` is the bucket's most popular node: the one whose buckets hold the most nodes
    in all, as an original does whose copies are each changed at other places.
    """
    w = Window.partitionBy("sig")
    shared = stored(signed.withColumn("low", F.min("node").over(w)).withColumn("high", F.max("node").over(w)).withColumn("size", F.count("*").over(w))
                    .where("low <> high").select("sig", "node", "size"), "shared-signatures")
    popular = shared.groupBy("node").agg(F.sum("size").alias("weight"))
    first = F.max(F.struct("weight", "node")).over(w)
    return stored(shared.select("sig", "node").distinct().join(popular, "node").withColumn("first", first)
                  .select("sig", "node", F.col("first.node").alias("first")), "buckets")


def _sets(docs: DataFrame, k: int) -> DataFrame:
    """node, n, short and sketch, members (bytes) of every row of ``docs``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                got = list(shingle_sets(batch.slice(at, 200).column("text"), k))
                yield pa.RecordBatch.from_pydict({
                    "node": pa.array([fingerprint(s) for s in got], pa.int64()), "n": pa.array([len(s) for s in got], pa.int64()),
                    "short": pa.array([sketch(s, SKETCH_BITS) for s in got], pa.binary()), "sketch": pa.array([sketch(s) for s in got], pa.binary()),
                    "members": pa.array([s.tobytes() for s in got], pa.binary())})

    return docs.select("text").mapInArrow(run, "node long, n long, short binary, sketch binary, members binary").dropDuplicates(["node"])


def _verified(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """Pairs (a, b) that are linked, from distinct candidates (a, b)."""
    def side(name: str, *columns: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), *[F.col(c).alias(f"{c}_{name}") for c in columns])

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            if x.num_rows:
                apart = np.array([_apart(a.as_py(), b.as_py()) for a, b in zip(x.column("sketch_a"), x.column("sketch_b"))])
                ok = _may_link(apart, _ints(x, "n_a"), _ints(x, "n_b"), threshold)
                yield x.select(["a", "b"]).filter(pa.array(ok))

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x in batches:
            ok = []
            for u, v in zip(x.column("members_a"), x.column("members_b")):
                u, v = (np.frombuffer(y.as_py(), dtype=np.uint64) for y in (u, v))
                both = len(np.intersect1d(u, v, assume_unique=True))
                ok.append(100 * both >= threshold * (len(u) + len(v) - both))
            yield x.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    few = (pairs.join(side("a", "n", "sketch"), "a").join(side("b", "n", "sketch"), "b")
           .mapInArrow(near, "a long, b long"))
    return (few.join(side("a", "members"), "a").join(side("b", "members"), "b")
            .select("a", "b", "members_a", "members_b").mapInArrow(exact, "a long, b long"))


def _forest(edges: DataFrame) -> DataFrame:
    """Edges (u, v), u > v, with the same components and at most one per node and task:
    each task links the nodes of its edges to the least one it can reach."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[up]
            return x

        for batch in batches:
            for a, b in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
                a, b = root(a), root(b)
                parent[max(a, b)] = min(a, b)
        ends = [(x, root(x)) for x in list(parent)]
        ends = [(x, r) for x, r in ends if x != r]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in ends], pa.int64()), pa.array([r for _, r in ends], pa.int64())], names=["u", "v"])

    return edges.select("u", "v").mapInArrow(run, "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """``node``, ``comp`` (least node reachable) of every node of ``edges(a, b)``.

    Tasks first shrink their edges to forests; then large-star and small-star steps
    alternate until only stars are left.  Those take minima by key and join
    them back, so no task holds a component.
    """
    e = stored(_forest(stored(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "edges")).distinct(), "forest")
    while True:
        ends = (e.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("top"))
                .unionByName(e.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("top")))
                .groupBy("x").agg(F.sum("up").alias("ups"), F.max("top").alias("top")))
        if not ends.where("ups > 1 OR (ups = 1 AND top = 1)").limit(1).count():         # stars only
            return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
                e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (both.join(least, "u").where("v > u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
                 .where("u <> v").distinct())
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v"))
        e = stored(_forest(stored(small, "stars")).distinct(), "forest")


def _block_pairs(buckets: DataFrame, sets: DataFrame, comp: DataFrame, threshold: int) -> DataFrame:
    """Candidates (a, b) of different components that share a bucket and that the short sketches do not rule out.

    Every such pair has a node outside the bucket's largest component.  Those minor nodes, in blocks, meet all nodes, in
    blocks: a stranger in a bucket of near copies costs one comparison with each of them, not all their pairs.
    """
    # Pairs with the first node are verified, so it is left out, and with it every bucket of two.
    rows = (buckets.where("node <> first").join(comp, "node", "left")
            .select("sig", "node", F.coalesce("comp", "node").alias("comp")))
    largest = (rows.groupBy("sig", "comp").agg(F.count("*").alias("size")).groupBy("sig")
               .agg(F.max(F.struct("size", "comp")).alias("top"), F.sum("size").alias("all"))
               .where(F.col("all") > F.col("top.size"))
               .select("sig", F.col("top.comp").alias("main"),
                       F.ceil((F.col("all") - F.col("top.size")) / MINOR_BLOCK).alias("minors"),
                       F.ceil(F.col("all") / OTHER_BLOCK).alias("others")))
    rows = stored(rows.join(largest, "sig"), "open-buckets")
    block = lambda n: F.pmod(F.xxhash64("node"), F.col(n))
    each = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    rows = (rows.where("comp <> main").select("sig", block("minors").alias("x"), each("others").alias("y"), F.lit(True).alias("minor"), "node", "comp")
            .unionByName(rows.select("sig", each("minors").alias("x"), block("others").alias("y"), F.lit(False).alias("minor"), "node", "comp"))
            .join(sets.select("node", "n", "short"), "node"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            rest = table if rest is None else pa.concat_tables([rest, table])
            key = np.stack([rest.column(c).to_numpy() for c in ("sig", "x", "y")], axis=1)
            last = len(key) - 1
            while last > 0 and (key[last - 1] == key[-1]).all():
                last -= 1
            yield from groups(rest.slice(0, last), key[:last])
            rest = rest.slice(last).combine_chunks()
        if rest is not None and rest.num_rows:
            yield from groups(rest, np.stack([rest.column(c).to_numpy() for c in ("sig", "x", "y")], axis=1))

    def groups(rows: pa.Table, key: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Near pairs within runs of equal keys (a run has one block of minor nodes and one of others)."""
        if len(key) < 2:
            return
        cuts = np.concatenate([[0], np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1, [len(key)]])
        node, comp, n, minor = (rows.column(c).to_numpy() for c in ("node", "comp", "n", "minor"))
        words = _words(rows.column("short").combine_chunks())
        left, right, held = [], [], 0

        def near():
            i, j = np.concatenate(left), np.concatenate(right)
            ok = comp[i] != comp[j]
            i, j = i[ok], j[ok]
            ok = _may_link(np.bitwise_count(words[i] ^ words[j]).sum(axis=1, dtype=np.int64), n[i], n[j], threshold)
            a, b = np.minimum(node[i[ok]], node[j[ok]]), np.maximum(node[i[ok]], node[j[ok]])
            pairs = np.unique(np.stack([a, b], axis=1), axis=0) if len(a) else np.zeros((0, 2), np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for a, b in zip(cuts[:-1], cuts[1:]):
            few, all_ = np.flatnonzero(minor[a:b]) + a, np.flatnonzero(~minor[a:b]) + a
            for at in range(0, len(few), 16):
                i = few[at:at + 16]
                left.append(np.repeat(i, len(all_)))
                right.append(np.tile(all_, len(i)))
                held += len(i) * len(all_)
                if held > 100_000:
                    yield near()
                    left, right, held = [], [], 0
        if held:
            yield near()

    return (rows.repartition("sig", "x", "y").sortWithinPartitions("sig", "x", "y")
            .mapInArrow(run, "a long, b long").distinct())


def linked_rows(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, k: int = SHINGLE) -> DataFrame:
    """id, text_hash, n and ``comp`` of every row of ``docs``: rows of equal ``comp`` are
    linked, directly or through others.  Rows without words have n = 0 and are linked with nothing."""
    d = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    rows = stored(_summaries(d, k), "shingle-rows")
    buckets = _buckets(_signed(d, k, threshold))
    wanted = (rows.groupBy("fp").agg(F.min("text_hash").alias("text_hash"))
              .join(buckets.select(F.col("node").alias("fp")).distinct(), "fp", "left_semi").select("text_hash"))
    sets = stored(_sets(sized_join(d, stored(wanted, "wanted"), "text_hash", "left_semi"), k), "shingle-sets")
    stars = buckets.where("node <> first").select(F.least("node", "first").alias("a"), F.greatest("node", "first").alias("b")).distinct()
    edges = stored(_verified(stars, sets, threshold), "star-links")
    found = components(edges)
    more = stored(_verified(_block_pairs(buckets, sets, found, threshold), sets, threshold), "block-links")
    found = components(found.select(F.col("node").alias("a"), F.col("comp").alias("b")).unionByName(more))
    return (rows.join(found.select(F.col("node").alias("fp"), "comp"), "fp", "left")
            .select("id", "text_hash", "n", F.coalesce("comp", "fp").alias("comp")))


def join(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, k: int = SHINGLE) -> DataFrame:
    """Per row of ``docs``: ``key``, ``n_shingles`` and ``component_id`` (least key reachable by links).

    Empty and null texts are linked with nothing (their component is their own
    key).  Equal rows share a component.  A null key takes part in links but is
    never the least; a component of null keys only has a null id.  An empty table
    gives no rows; other columns are ignored, whatever their names.
    """
    rows = linked_rows(docs, key, text, threshold, k)
    least = (rows.where("n > 0").groupBy("comp").agg(F.min("id").alias("least"), F.count("*").alias("members"))
             .where("members > 1").select("comp", "least"))
    return (rows.join(least, "comp", "left")
            .select(F.col("id").alias("key"), F.col("n").alias("n_shingles"),
                    F.when(F.col("n") == 0, F.col("id")).otherwise(F.coalesce("least", "id")).alias("component_id")))


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", threshold: int = THRESHOLD, k: int = SHINGLE) -> DataFrame:
    """Rows of ``docs``, with their own columns: one of each component stays, that of
    the least non-null key (then text hash); of rows equal in both, any one.  Rows without words all stay.
    """
    rows = linked_rows(docs, key, text, threshold, k)
    each = rows.groupBy("comp", "n", "id", "text_hash").agg(F.count("*").alias("copies"))
    best = F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "text_hash", "copies"))
    kept = (each.where("n > 0").groupBy("comp").agg(best.alias("best")).select("best.id", "best.text_hash", "best.copies")
            .unionByName(each.where("n = 0").select("id", "text_hash", F.lit(1).cast("long").alias("copies")).distinct()))
    kept = stored(kept.select(F.col("id").alias("_id"), F.col("text_hash").alias("_hash"), "copies"), "kept-rows")
    packed = docs.select(F.struct("*").alias("row"), F.col(key).alias("id"), F.xxhash64(text).alias("hash"))
    found = sized_join(packed, kept, F.col("id").eqNullSafe(F.col("_id")) & (F.col("hash") == F.col("_hash")), "inner")
    once = found.where("copies = 1").select("row.*")
    return once.unionByName(found.where("copies > 1").dropDuplicates(["id", "hash"]).select("row.*"))
