"""SentencePiece encoding as a shortest path in a weighted transducer.

For a model the transducer is compiled once per worker process:

* the *normaliser* rewrites the longest matching rule of the model at each place and copies other characters; a space
  becomes U+2581, a dummy one is put in front, and extra ones are dropped if the model says so;
* the *lexicon* has one path per piece, spelt in characters; its arcs are kept in a hash table, so that a block of
  texts is composed with it in a few array steps;
* *byte fallback* is the start state's rest arc: it reads a character that is no piece and writes its UTF-8 byte
  pieces (the unknown piece, if the model has no byte pieces).

A text is composed with it position by position: an arc ``i -> j`` carries the piece that spells characters ``i..j``.
The weights are those of the tropical semiring (minimum of sums):

* ``unigram`` models weigh a piece by its negated score;
* ``bpe`` models weigh a pair of adjacent pieces by 0 if merging their characters by rank gives just this pair, and by
  infinity if not.  A text has exactly one path of finite weight, which is the one that merging gives.

Pieces hold no space after another character and no line feed, so the parts of a text between such places are composed
on their own.  The distinct parts of a block of texts are composed together; the paths of recent parts are kept.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from murmur.llm.common import slices, worker_state

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SPACE = "▁"
INFINITY = float("inf")
#: Parts whose paths a worker keeps (some 200 bytes each) before it starts anew.
KEEP = 250_000
#: Characters of texts that are encoded at once.
BLOCK_CHARS = 400_000
#: Characters of new parts that are composed at once (some 300 bytes each for a moment).
COMPOSE_CHARS = 100_000
#: Longer parts are composed one by one: a step over the block would serve few parts.
LONG = 200
CHAR_BITS = 21                  # code points
_ODD = np.uint64(0x9E3779B97F4A7C15)


class Normaliser:
    """Deterministic transducer from texts to piece symbols."""

    def __init__(self, rules: dict[str, str] | None = None, dummy_prefix: bool = True, squeeze: bool = False):
        self.rules, self.dummy_prefix, self.squeeze = rules or {}, dummy_prefix, squeeze
        self.longest: dict[str, int] = {}
        for source in self.rules:
            self.longest[source[0]] = max(self.longest.get(source[0], 0), len(source))
        self.first = re.compile("[" + re.escape("".join(self.longest)) + "]") if self.longest else None
        self.identity = not (self.rules or squeeze)

    def __call__(self, text: str) -> str:
        if self.first:
            text = self._rewrite(text)
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        return (SPACE if self.dummy_prefix else "") + text.replace(" ", SPACE)

    def _rewrite(self, text: str) -> str:
        out, at = [], 0
        while hit := self.first.search(text, at):
            start = hit.start()
            out.append(text[at:start])
            for size in range(self.longest[text[start]], 0, -1):
                target = self.rules.get(text[start:start + size])
                if target is not None:
                    out.append(target)
                    at = min(start + size, len(text))
                    break
            else:
                out.append(text[start])
                at = start + 1
        return "".join(out) + text[at:]


class HashTable:
    """int64 keys to int32 values in arrays; ``get`` looks up many keys at once (-1: absent)."""

    def __init__(self, items: dict[int, int]):
        bits = max(4, (4 * len(items)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys, self.values = np.full(1 << bits, -1, dtype=np.int64), np.zeros(1 << bits, dtype=np.int32)
        for key, slot in zip(items, self._slots(np.fromiter(items, dtype=np.int64, count=len(items))).tolist()):
            while self.keys[slot] >= 0:
                slot = slot + 1 & self.mask
            self.keys[slot], self.values[slot] = key, items[key]

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys.view(np.uint64) * _ODD >> self.shift).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        slots = self._slots(keys)
        held = self.keys[slots]
        out = np.where(held == keys, self.values[slots], -1)
        open_ = np.flatnonzero((held != keys) & (held >= 0))
        while len(open_):
            slots[open_] = slots[open_] + 1 & self.mask
            held = self.keys[slots[open_]]
            hit = held == keys[open_]
            out[open_[hit]] = self.values[slots[open_[hit]]]
            open_ = open_[~hit & (held >= 0)]
        return out


class Transducer:
    """A compiled model: ``encode`` and ``decode``."""

    def __init__(self, pieces: list[str], scores: list[float], unknown: int, control: set[int],
                 byte_ids: dict[int, int], bpe: bool, normalise: Normaliser | None = None):
        self.scores, self.bpe, self.unknown, self.control = scores, bpe, unknown, control
        self.pieces, self.size = pieces, len(pieces)
        self.byte_ids = byte_ids
        self.normalise = normalise or Normaliser()
        self.foreign = 10.0 - min(scores)
        skip = control | set(byte_ids.values()) | {unknown}
        self.ids = {p: i for i, p in enumerate(pieces) if i not in skip}
        #: The lexicon as a deterministic acceptor: character -> next state; "" -> the piece that ends here.
        self.start: dict = {}
        self.whole: set[str] = set()
        for piece, i in self.ids.items():
            if bpe and self.merge(piece) != [piece]:
                continue                                    # no text is ever merged to it
            self.whole.add(piece)
            state = self.start
            for c in piece:
                state = state.setdefault(c, {})
            state[""] = i
        self._compile()
        #: Whether two adjacent pieces may stand together: the last result for each slot.
        self.pair_keys, self.pair_fits = np.full(1 << 20, -1, dtype=np.int64), np.zeros(1 << 20, dtype=bool)
        self._forget()
        # Where no piece can cross: before a space after something else, and around a line feed.  Without byte pieces,
        # unknown characters in a row are one piece, so texts are composed whole.
        crossing = any(SPACE in p.lstrip(SPACE) or "\n" in p for p in self.ids) or not byte_ids
        self.part = re.compile(f"{SPACE}*[^{SPACE}\\n]+|{SPACE}+|\\n" if not crossing else r"(?s).+")
        # Decoding: the text of each id; bytes from 0x80 on only have one together.
        self.high = {i: b for b, i in byte_ids.items() if b >= 0x80}
        self.text = ["" if i in control else p.replace(SPACE, " ") for i, p in enumerate(pieces)]
        self.text[unknown] = " \u2047 "
        for b, i in byte_ids.items():
            self.text[i] = chr(b) if b < 0x80 else ""
        self.width = np.array([len(t) for t in self.text], dtype=np.int64)

    @classmethod
    def load(cls, path: str) -> "Transducer":
        with open(path, "rb") as f:
            return cls.compile(f.read())

    @classmethod
    def compile(cls, model: bytes) -> "Transducer":
        """From the bytes of a model file."""
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        m = pb.ModelProto()
        m.ParseFromString(model)
        kind, norm = m.trainer_spec.model_type, m.normalizer_spec
        if kind not in (pb.TrainerSpec.UNIGRAM, pb.TrainerSpec.BPE) or not norm.escape_whitespaces:
            raise ValueError("only unigram and BPE models with escaped spaces are supported")
        types = [p.type for p in m.pieces]
        at = lambda *kinds: [i for i, t in enumerate(types) if t in kinds]
        P = pb.ModelProto.SentencePiece
        if at(P.USER_DEFINED):
            raise ValueError("models with user-defined pieces are not supported")
        rules = {}
        if norm.precompiled_charsmap:
            rules = dict(sentencepiece.SentencePieceNormalizer(model_proto=model).decompile())
        return cls([p.piece for p in m.pieces], [p.score for p in m.pieces], at(P.UNKNOWN)[0],
                   set(at(P.CONTROL, P.UNUSED)), {int(m.pieces[i].piece[3:5], 16): i for i in at(P.BYTE)},
                   kind == pb.TrainerSpec.BPE,
                   Normaliser(rules, norm.add_dummy_prefix, norm.remove_extra_whitespaces))

    def _compile(self) -> None:
        """Number the states and put all arcs into a hash table: (state, character) -> state."""
        arcs: dict[int, int] = {}
        final, queue = [-1], [(0, self.start)]
        for number, state in queue:
            for c, target in state.items():
                if c == "":
                    final[number] = target
                else:
                    arcs[number << CHAR_BITS | ord(c)] = len(final)
                    queue.append((len(final), target))
                    final.append(-1)
        self.arcs, self.final = HashTable(arcs), np.array(final, dtype=np.int64)

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.paths = np.zeros(0, dtype=np.int32)            # ids of known parts, one after another
        self.first, self.count = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.good = np.zeros(0, dtype=bool)                 # whether a part decodes to itself

    # -- merging by rank, which defines the weight of a pair

    def merge(self, chars: str) -> list[str]:
        """Merge the adjacent pair of the best score, leftmost first, until none is a piece."""
        parts = list(chars)
        ids, scores = self.ids, self.scores

        def rank(pair: str) -> float:
            i = ids.get(pair)
            return -INFINITY if i is None else scores[i]

        ranks = [rank(a + b) for a, b in zip(parts, parts[1:])]
        while ranks:
            best = max(ranks)
            if best == -INFINITY:
                break
            at = ranks.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at:
                ranks[at - 1] = rank(parts[at - 1] + parts[at])
            if at < len(ranks):
                ranks[at] = rank(parts[at] + parts[at + 1])
        return parts

    def _fits(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging leaves the pairs of pieces as they are."""
        keys = left << CHAR_BITS | right
        slots = (keys.view(np.uint64) * _ODD >> np.uint64(44)).astype(np.int64)
        fits = self.pair_fits[slots]
        new = np.flatnonzero(self.pair_keys[slots] != keys)
        if len(new):
            uniq, at = np.unique(keys[new], return_inverse=True)
            pieces, got = self.pieces, []
            for key in uniq.tolist():
                a, b = pieces[key >> CHAR_BITS], pieces[key & (1 << CHAR_BITS) - 1]
                got.append(a + b not in self.whole and self.merge(a + b) == [a, b])
            fits[new] = np.array(got)[at]
            self.pair_keys[slots[new]], self.pair_fits[slots[new]] = keys[new], fits[new]
        return fits

    # -- composition and shortest paths

    def best_paths(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Labels of the paths of least weight over ``parts``, one path after another, and their lengths.

        A label from ``size`` on is a rest arc over the character ``label - size``.  With merge weights a position is
        reached at weight 0 by one path only, the one that merging gives for the text up to there, so each position
        keeps one state.
        """
        chars = np.frombuffer("".join(parts).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        sizes = np.array([len(p) for p in parts], dtype=np.int64)
        ends = np.cumsum(sizes)
        begin, end = np.repeat(ends - sizes, sizes), np.repeat(ends, sizes)
        part = np.repeat(np.arange(len(parts)), sizes)
        # Composition: all positions at once, one character deeper at each step.
        at, state, found, depth = np.arange(len(chars)), np.zeros(len(chars), dtype=np.int64), [], 0
        alone = np.ones(len(chars), dtype=bool)
        while len(at):
            state = self.arcs.get(state << CHAR_BITS | chars[at + depth]).astype(np.int64)
            at, state = at[state >= 0], state[state >= 0]
            piece = self.final[state]
            spelt = piece >= 0
            found.append((at[spelt], np.full(spelt.sum(), depth + 1), piece[spelt]))
            if not depth:
                alone[at[spelt]] = False
            depth += 1
            inside = at + depth < end[at]
            at, state = at[inside], state[inside]
        rest = np.flatnonzero(alone)
        found.append((rest, np.ones(len(rest), dtype=np.int64), self.size + chars[rest]))
        start, span, label = (np.concatenate(x) for x in zip(*found))
        if self.bpe:
            weight = np.zeros(len(label))
        else:
            weight = np.where(label < self.size, -np.array(self.scores)[np.minimum(label, self.size - 1)], self.foreign)
        # Shortest paths: arcs by the place in their part where they end.
        place = start - begin[start] + span
        source = start + part[start]                        # a part has a node more than characters
        nodes = len(chars) + len(parts)
        longest = int(span.max()) + 1 if len(span) else 1
        order = np.argsort((place * nodes + source + span) * longest - span, kind="stable")     # place, end, start
        source, span, label, weight, place = (x[order] for x in (source, span, label, weight, place))
        first = source == (begin + part)[start[order]]
        least, via, back = np.full(nodes, INFINITY), np.full(nodes, -1, dtype=np.int64), np.zeros(nodes, dtype=np.int64)
        least[ends - sizes + np.arange(len(parts))] = 0.0
        cuts = np.flatnonzero(np.diff(place, prepend=0, append=-1))
        for a, b in zip(cuts[:-1], cuts[1:]):
            go = a + np.flatnonzero(least[source[a:b]] < INFINITY)
            if self.bpe:
                last, new = via[source[go]], label[go]
                fits = first[go] | (last >= self.size) | (new >= self.size)
                ask = np.flatnonzero(~fits)
                fits[ask] = self._fits(last[ask], new[ask])
                go = go[fits]
            if not len(go):
                continue
            target, total = source[go] + span[go], least[source[go]] + weight[go]
            runs = np.flatnonzero(np.diff(target, prepend=-1))
            best = np.minimum.reduceat(total, runs)
            hit = np.flatnonzero(total == np.repeat(best, np.diff(runs, append=len(go))))
            hit = hit[np.unique(target[hit], return_index=True)[1]]
            least[target[hit]], via[target[hit]], back[target[hit]] = total[hit], label[go[hit]], source[go[hit]]
        node, owner = ends + np.arange(len(parts)), np.arange(len(parts))
        stop, steps = node - sizes, []
        while len(node):
            steps.append((owner, via[node]))
            node = back[node]
            more = node > stop[owner]
            node, owner = node[more], owner[more]
        owner, labels = (np.concatenate(x[::-1]) for x in zip(*steps)) if steps else (np.zeros(0, np.int64),) * 2
        order = np.argsort(owner, kind="stable")
        return labels[order], np.bincount(owner, minlength=len(parts))

    def best_path(self, text: str) -> list[int]:
        """The same for one long part, without arrays."""
        n = len(text)
        label, origin, weight = [-1] * (n + 1), [0] * (n + 1), [INFINITY] * (n + 1)
        weight[0] = 0.0
        fits: dict[tuple[int, int], bool] = {}
        for i in range(n):
            state, w, last = self.start, weight[i], label[i]
            if w == INFINITY:
                continue
            for j in range(i, n):
                state = state.get(text[j])
                if state is None:
                    break
                piece = state.get("")
                if piece is None or weight[j + 1] <= (cost := w if self.bpe else w - self.scores[piece]):
                    continue
                if self.bpe and i and last < self.size:
                    ok = fits.get((last, piece))
                    if ok is None:
                        a, b = self.pieces[last], self.pieces[piece]
                        ok = fits[last, piece] = self.merge(a + b) == [a, b]
                    if not ok:
                        continue
                weight[j + 1], label[j + 1], origin[j + 1] = cost, piece, i
            if "" not in self.start.get(text[i], ()) and (cost := w if self.bpe else w + self.foreign) < weight[i + 1]:
                weight[i + 1], label[i + 1], origin[i + 1] = cost, self.size + ord(text[i]), i
        out, at = [], n
        while at:
            out.append(label[at])
            at = origin[at]
        return out[::-1]

    def spell(self, labels: list[int]) -> list[int]:
        """Output of a path: piece ids, and byte pieces or the unknown piece (once a run) for rest arcs."""
        if not labels or max(labels) < self.size:
            return labels
        out: list[int] = []
        for label in labels:
            if label < self.size:
                out.append(label)
            elif self.byte_ids:
                out += [self.byte_ids[b] for b in chr(label - self.size).encode("utf-8", "surrogatepass")]
            elif not out or out[-1] != self.unknown:
                out.append(self.unknown)
        return out

    def _learn(self, parts: list[str]) -> None:
        """Add parts with their paths to the known ones."""
        short = [p for p in parts if len(p) <= LONG]
        paths, sizes = [], []
        for a, b in slices(short, COMPOSE_CHARS):
            labels, counts = self.best_paths(short[a:b])
            if len(labels) and labels.max() >= self.size:
                spelt = [self.spell(x.tolist()) for x in np.split(labels, np.cumsum(counts)[:-1])]
                labels, counts = list(chain.from_iterable(spelt)), np.array([len(x) for x in spelt])
            paths.append(np.asarray(labels, dtype=np.int32))
            sizes.append(counts)
        for p in parts:
            if len(p) > LONG:
                short.append(p)
                paths.append(self.spell(self.best_path(p)))
                sizes.append(np.array([len(paths[-1])]))
        counts = np.concatenate(sizes)
        flat = np.concatenate([np.asarray(x, dtype=np.int32) for x in paths])
        ends = np.cumsum(counts)
        good = self._decode_alike(short, flat, counts)
        base = len(self.known)
        self.known.update(zip(short, range(base, base + len(short))))
        self.first = np.concatenate([self.first, ends - counts + len(self.paths)])
        self.count, self.good = np.concatenate([self.count, counts]), np.concatenate([self.good, good])
        self.paths = np.concatenate([self.paths, flat])

    def _decode_alike(self, parts: list[str], ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Whether each part is what its ids decode to."""
        spelt = np.add.reduceat(np.append(self.width[ids], 0), np.cumsum(counts) - counts)
        good = spelt == np.array([len(p) for p in parts])
        check = np.flatnonzero(~good)                       # bytes from 0x80 on, or a real difference
        if "".join(map(self.text.__getitem__, ids[np.repeat(good, counts)].tolist())) != \
                "".join(p for p, ok in zip(parts, good.tolist()) if ok).replace(SPACE, " "):
            check = np.arange(len(parts))
        ends = np.cumsum(counts)
        for i in check.tolist():
            good[i] = self._join(ids[ends[i] - counts[i]:ends[i]].tolist()) == parts[i].replace(SPACE, " ")
        return good

    def encode_block(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all ``texts``, one text after another, their lengths, and whether a text is decoded to itself."""
        plain = [self.normalise(t) for t in texts]
        parts = [self.part.findall(t) for t in plain]
        distinct = set(chain.from_iterable(parts))
        new = distinct.difference(self.known)
        if len(self.known) + len(new) > KEEP:
            self._forget()
            new = distinct
        if new:
            self._learn(list(new))
        n_parts = np.array([len(p) for p in parts], dtype=np.int64)
        codes = np.fromiter(map(self.known.__getitem__, chain.from_iterable(parts)), dtype=np.int64, count=n_parts.sum())
        count = self.count[codes]
        at = np.cumsum(count)
        ids = self.paths[np.repeat(self.first[codes] - (at - count), count) + np.arange(at[-1] if len(at) else 0)]
        upto = np.concatenate([[0], at])[np.concatenate([[0], np.cumsum(n_parts)])]
        bad = np.concatenate([[0], np.cumsum(~self.good[codes])])[np.concatenate([[0], np.cumsum(n_parts)])]
        lengths = np.diff(upto)
        if self.normalise.identity and self.normalise.dummy_prefix:
            same = np.diff(bad) == 0
        else:
            same = np.array([self.decode(ids[a:b].tolist()) == t for t, a, b in zip(texts, upto[:-1], upto[1:])], dtype=bool)
        return ids, lengths, same

    def encode(self, text: str) -> list[int]:
        return self.encode_block([text])[0].tolist()

    def decode(self, ids: list[int]) -> str:
        """Text of ``ids``; invalid byte runs become U+FFFD, control pieces vanish."""
        text = self._join(ids)
        return text[1:] if self.normalise.dummy_prefix and text.startswith(" ") else text

    def _join(self, ids: list[int]) -> str:
        if self.high.keys().isdisjoint(ids):
            return "".join(map(self.text.__getitem__, ids))
        out, pending = [], bytearray()
        for i in ids:
            b = self.high.get(i)
            if b is not None:
                pending.append(b)
                continue
            if pending:
                out.append(pending.decode("utf-8", "replace"))
                pending.clear()
            out.append(self.text[i])
        out.append(pending.decode("utf-8", "replace"))
        return "".join(out)


def transducer(path: str) -> Transducer:
    return worker_state(f"transducer {path}", lambda: Transducer.load(path))


def _shipped(docs: DataFrame, path: str):
    """A function that gives the workers their transducer; the model's bytes are read here and broadcast (a model is a
    few MB)."""
    with open(path, "rb") as f:
        data = f.read()
    held, name = docs.sparkSession.sparkContext.broadcast(data), hashlib.sha256(data).hexdigest()
    return lambda: worker_state(f"transducer {name}", lambda: Transducer.compile(held.value))


def encode(docs: DataFrame, model: str = MODEL, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key``, ``n_tokens``, ``ids`` and ``round_trip`` for every row of ``docs``.

    ``round_trip``: decoding gives the text back (U+2581 in a text reads as a space, as in the model's own decoder).
    A null or empty text has no ids; equal rows are encoded alike, keys may be null or repeat; an empty table gives no
    rows.  Other columns are ignored, whatever their names.  ``model`` is a path that the driver can read.
    """
    fst_of = _shipped(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = fst_of()
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, b in slices(texts, BLOCK_CHARS):
                flat, lengths, same = fst.encode_block(texts[a:b])
                ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key").slice(a, b - a), pa.array(lengths, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32())), pa.array(same, pa.bool_())],
                    names=["key", "n_tokens", "ids", "round_trip"])

    kind = docs.schema[key].dataType.simpleString()
    return (docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
            .mapInArrow(run, f"key {kind}, n_tokens long, ids array<int>, round_trip boolean"))


def decode(tokens: DataFrame, model: str = MODEL, key: str = "key", ids: str = "ids") -> DataFrame:
    """``key`` and the decoded ``text`` of every row; null ids decode to the empty text."""
    fst_of = _shipped(tokens, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fst = fst_of()
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array([fst.decode(x.as_py() or []) for x in batch.column("ids")], pa.string())],
                names=["key", "text"])

    kind = tokens.schema[key].dataType.simpleString()
    return (tokens.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
            .mapInArrow(run, f"key {kind}, text string"))
