"""Katz backoff language model: Good-Turing discounted n-grams, three words by default, with exactly normalised weights.

P(w | u v) = d(c(u,v,w)) c(u,v,w) / c(u,v) where the trigram was seen in training, else alpha(u,v) P(w | v). P(w | v) backs
off to P(w) in the same way, and P(w) = d(c(w)) c(w) / N; what the discounts leave there is the probability of the unknown
word. alpha of a context spreads what the discounts of its followers leave over all words that never followed it, in
proportion to the next shorter order, so that every context sums to one over the vocabulary, the end of a text and the
unknown word. A context of which nothing is left (all followers frequent) counts one more event. A context never seen has
weight one. A text starts after one start mark, which is no token: its first token has only that as context.

The counts are corpus-wide and grow with it; they stay in tables. Each scan partition is read in blocks that number
their words and list their distinct words, with training counts, in slices by hash; the numbered texts lie in buckets by
block. From them each block lists its distinct n-grams of every order (64-bit keys, sorted, with training counts) in
slices by ranges of keys. The slices are shuffled, so that all counts of a word or n-gram meet in one task, however
frequent it is: it has one entry per block. The totals go back to the blocks that asked. One of the blocks owns each
n-gram and adds it to the sums of its context; sums of contexts that occur in one block only need no exchange, others
meet once more by slice. There a context is named by its place among the slice's contexts that several blocks have, which
came with its count, so keys are sent once; a block sends sums of contexts of which it owns followers only, and gets the
weights it needs, those of contexts before an unseen word, only. The sums of an order need the weights of the order
below, so orders are settled from short to long. Then every token is evaluated recursively from its longest n-gram to its backoff. The number of slices grows with
the bytes of the texts, so a slice stays as small whatever the size of the corpus.

N-grams of one order are told apart by 64 bits of hash: among n distinct ones about n * n / 2^65 pairs are taken for one
(three in 10^10), which would add their counts up.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from gleaner.llm.common import Work
from gleaner.llm.packed import (
    pack, pack_rising, pack_words, unpack, unpack_rising, unpack_words)

ORDER = 3
BLOCK_BYTES = 10 << 20
# Text for which a slice holds the counts; a task takes slices one after the other.
SLICE_BYTES = 32 << 20
# Spark's default limit for the buckets of a table.
MOST_BUCKETS = 100_000
# Counts above this are not discounted.
TRUSTED = 5
START, END, FIRST = 0, 1, 2
# The start mark is in no slice of words; as a context it has one of its own.
NO_SLICE = -1
# Kinds of rows; n-grams have their order n from 2 on as kind, and the sums of their contexts -n.
TEXT, WORDS = 0, 1
_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9))
_MARKS = (0x243F6A8885A308D3, 0x13198A2E03707344)


def discounts(of: list[int]) -> np.ndarray:
    """d(r) for r up to TRUSTED from the numbers of types seen once, twice, ... TRUSTED + 1 times.

    Where Good-Turing gives nothing between 0 and 1 (too few types), half an event is taken off.
    """
    out = np.ones(TRUSTED + 2)
    out[0] = 0
    tail = (TRUSTED + 1) * of[TRUSTED] / of[0] if of[0] else 1.0
    for r in range(1, TRUSTED + 1):
        d = ((r + 1) * of[r] / (r * of[r - 1]) - tail) / (1 - tail) if of[r - 1] and tail != 1 else 0.0
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


class Model:
    """The totals that every task needs: a dozen numbers. ``grams_of`` has those of n-grams from two words on."""

    def __init__(self, tokens: int, types: int, texts: int, words_of: list[int], grams_of: list[list[int]]):
        self.tokens, self.types, self.texts, self.order = tokens, types, texts, 1 + len(grams_of)
        self.rates = [None, *map(discounts, [words_of, *grams_of])]
        left = sum((1 - self.rates[1][r]) * r * words_of[r - 1] for r in range(1, TRUSTED + 1))
        self.unknown = left / tokens if tokens else 1.0

    def mass(self, n: int, count: np.ndarray) -> np.ndarray:
        return self.rates[n][np.minimum(count, TRUSTED + 1)] * count

    def unigram(self, count: np.ndarray) -> np.ndarray:
        return np.where(count > 0, self.mass(1, count) / max(self.tokens, 1), self.unknown)

    def weights(self, count: np.ndarray, seen: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Denominator and backoff weight of contexts by count, discounted mass and shorter-order mass of their followers."""
        total = count.astype(np.float64)
        left = total - seen
        more = left < 1e-9
        total, left = np.where(more, total + 1, total), np.where(more, 1.0, left)
        known = count > 0
        safe = np.where(known, total, 1.0)
        return safe, np.where(known, left / safe / np.maximum(1 - lower, 1e-300), 1.0)


class _Level(NamedTuple):
    """The distinct n-grams of a block: keys (sorted from two words on), the n-gram of every token (-1 at the beginning of
    a text), and the numbers of the n-gram without its last and without its first word among those of the level below."""

    keys: np.ndarray
    place: np.ndarray
    context: np.ndarray | None
    shorter: np.ndarray | None


def _levels(texts: list[np.ndarray], hashes: np.ndarray, order: int) -> tuple[list[_Level | None], np.ndarray]:
    """Levels 1 to ``order`` of the tokens of all texts (index 0 is unused), and where the texts end."""
    word = np.concatenate([*texts, np.zeros(0, np.uint32)]).astype(np.int64)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    at = np.arange(len(word)) - np.repeat(ends - sizes, sizes)
    levels: list[_Level | None] = [None, _Level(hashes, word, None, None)]
    for n in range(2, order + 1):
        below = levels[-1]
        use = np.flatnonzero(at >= n - 2)
        context = below.place[use - 1]
        if n == 2:
            context[at == 0] = START
        keys, first, place = _distinct(_mix(below.keys[context], hashes[word[use]]))
        whole = np.full(len(word), -1)
        whole[use] = place
        levels.append(_Level(keys, whole, context[first], below.place[use[first]]))
    return levels, ends


def _distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys in order, where each comes first, and the number of each key among them.

    Sorts the upper bits together with the place, in one plain sort; keys that differ below are put right after it.
    """
    low = np.uint64((1 << len(keys).bit_length()) - 1)
    order = (np.sort((keys & ~low) | np.arange(len(keys), dtype=np.uint64)) & low).astype(np.int64)
    ranked = keys[order]
    if (ranked[1:] < ranked[:-1]).any():
        again = np.argsort(ranked, kind="stable")
        order, ranked = order[again], ranked[again]
    new = np.ones(len(keys), bool)
    new[1:] = ranked[1:] != ranked[:-1]
    place = np.empty(len(keys), np.int64)
    place[order] = np.cumsum(new) - 1
    return ranked[new], order[new], place


def _mix(context: np.ndarray, word: np.ndarray) -> np.ndarray:
    key = (context * _MIX[0]) ^ (word >> np.uint64(31)) ^ (word * _MIX[1])
    key ^= key >> np.uint64(29)
    key *= _MIX[1]
    key ^= key >> np.uint64(32)
    return key


def _ranges(keys: np.ndarray, slices: int) -> list[tuple[int, int, int]]:
    """(slice, from, to) of sorted keys; slices are ranges, so a block's answers in slice order are in key order."""
    return _runs((keys >> np.uint64(32)) * np.uint64(slices) >> np.uint64(32))


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.array([*_MARKS, *map(xxhash.xxh64_intdigest, words)], np.uint64)


def _runs(numbers: np.ndarray) -> list[tuple[int, int, int]]:
    """(number, from, to) of the runs in a sorted array."""
    cuts = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1).tolist(), len(numbers)]
    return [(int(numbers[a]), a, b) for a, b in zip(cuts, cuts[1:]) if a < b]


NUMBERED = ["block", "kind", "slice", "doc_id", "held_out", "n", "a", "b", "c"]


def _number_pass(slices: int):
    def close(block: int, kind, words: dict, rows: list) -> Iterator[pa.RecordBatch]:
        listed = list(words)
        texts = [codes for _, _, codes in rows]
        held = np.array([h for _, h, _ in rows], bool)
        hashes = _hashes(listed)
        learnt = [t for t, out in zip(texts, held) if not out]
        count = np.bincount(np.concatenate([*learnt, np.zeros(0, np.uint32)]), minlength=len(hashes))

        def batch(n, what, part, docs, out, sizes, a, b, c):
            return pa.RecordBatch.from_arrays(
                [pa.array([block] * n, pa.int64()), pa.array([what] * n, pa.int32()), pa.array(part, pa.int32()),
                 pa.array(docs, kind), pa.array(out, pa.bool_()), pa.array(sizes, pa.int64()),
                 *[pa.array(x, pa.binary()) for x in (a, b, c)]], names=NUMBERED)

        none = [None] * len(rows)
        yield batch(len(rows), TEXT, none, [d for d, _, _ in rows], held, none, [pack(t) for t in texts], none, none)
        dealt = hashes[FIRST:] % np.uint64(slices)
        order = np.argsort(dealt, kind="stable")
        for s, a, b in _runs(dealt[order]):
            own = order[a:b]
            yield batch(1, WORDS, [s], [None], [None], [len(own)], [pack_words([listed[i] for i in own])],
                        [pack_rising((own + FIRST).astype(np.uint32))], [pack(count[own + FIRST].astype(np.uint32))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, words, rows, size, kind = TaskContext.get().partitionId() << 24, {}, [], 0, None
        for batch in batches:
            kind = batch.schema.field("doc_id").type
            docs, held = batch.column("doc_id").to_pylist(), batch.column("held_out").to_pylist()
            for doc, out, text in zip(docs, held, batch.column("text").cast(pa.binary()).to_pylist()):
                if rows and size + len(text) > BLOCK_BYTES:
                    yield from close(block, kind, words, rows)
                    block, words, rows, size = block + 1, {}, [], 0
                size += len(text)
                found = text.lower().split()  # bytes: ASCII letters and ASCII white space only
                for w in set(found):
                    if w not in words:
                        words[w] = len(words) + FIRST
                codes = np.empty(len(found) + 1, np.uint32)
                codes[:-1] = np.fromiter(map(words.__getitem__, found), np.uint32, len(found))
                codes[-1] = END
                rows.append((doc, out, codes))
        if rows:
            yield from close(block, kind, words, rows)

    return run


REPLY = "block long, kind int, slice int, a binary, b binary, c binary, stats array<long>"


def _reply(rows: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) or [[]] * 7
    kinds = [pa.int64(), pa.int32(), pa.int32(), *[pa.binary()] * 3, pa.list_(pa.int64())]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                names=["block", "kind", "slice", "a", "b", "c", "stats"])


def _of(counts: np.ndarray) -> list[int]:
    return [int((counts == r).sum()) for r in range(1, TRUSTED + 2)]


def _add_words(key: tuple, rows: pa.Table) -> pa.Table:
    """Training counts of a slice's words, whether other blocks list them, and the places of those that training has among
    them, back to each block; the slice's totals."""
    total: dict[bytes, int] = {}
    blocks: dict[bytes, int] = {}
    lists = []
    for block, packed, counts in zip(*(rows.column(n).to_pylist() for n in ("block", "a", "c"))):
        words = unpack_words(packed)
        for w, n in zip(words, unpack(counts, np.uint32).tolist()):
            total[w] = total.get(w, 0) + n
            blocks[w] = blocks.get(w, 0) + 1
        lists.append((block, words))
    s = key[0].as_py()
    counts = np.array(list(total.values()), np.int64)
    rank = {w: i for i, w in enumerate(w for w, n in blocks.items() if n > 1 and total[w])}
    out = [(block, WORDS, s, pack(np.array([total[w] for w in words], np.uint64)),
            pack(np.array([blocks[w] > 1 for w in words])),
            pack_rising(np.array([rank[w] for w in words if w in rank], np.uint32)), None) for block, words in lists]
    out.append((None, WORDS, s, None, None, None, [int(counts.sum()), int((counts > 0).sum()), *_of(counts)]))
    return _reply(out)


def _words(numbered: list[dict]) -> tuple[list[dict], np.ndarray]:
    """The word lists of a block by slice, and the hashes of all its words by code."""
    lists = sorted((r for r in numbered if r["kind"] == WORDS), key=lambda r: r["slice"])
    words: list[bytes] = [b""] * sum(r["n"] for r in lists)
    for r in lists:
        r["codes"] = unpack_rising(r["b"], np.uint32).astype(np.int64)
        for c, w in zip(r["codes"].tolist(), unpack_words(r["a"])):
            words[c - FIRST] = w
    return lists, _hashes(words)


def _list_grams(slices: int, n: int):
    def run(key: tuple, numbered: pa.Table) -> pa.Table:
        rows = numbered.to_pylist()
        texts = [r for r in rows if r["kind"] == TEXT]
        levels, ends = _levels([unpack(r["a"], np.uint32) for r in texts], _words(rows)[1], n)
        learnt = np.repeat(np.array([not r["held_out"] for r in texts], bool), np.diff(ends, prepend=0))
        keys, place = levels[n].keys, levels[n].place
        times = np.bincount(place[learnt & (place >= 0)], minlength=len(keys)).astype(np.uint32)
        return _reply([(key[0].as_py(), n, s, pack_rising(keys[a:b], 1), pack(times[a:b]), None, None)
                       for s, a, b in _ranges(keys, slices)])

    return run


def _add_grams(order: int):
    """Training counts of a slice's n-grams, back to each block, and which of them a block owns or shares with others.

    Below the longest n-grams, those that training and several blocks have go with their places among them.
    """
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        blocks = rows.column("block").to_pylist()
        by_block = np.argsort(blocks, kind="stable")
        packed, counted = rows.column("a").to_pylist(), rows.column("b").to_pylist()
        keys = [unpack_rising(packed[i], np.uint64) for i in by_block]
        times = np.concatenate([unpack(counted[i], np.uint32) for i in by_block]).astype(np.int64)
        distinct, _, place = _distinct(np.concatenate(keys))
        total = np.bincount(place, times, len(distinct)).astype(np.int64)
        several = np.bincount(place) > 1
        shared, common = several[place], several & (total > 0)
        rank = np.cumsum(common, dtype=np.uint32) - np.uint32(1)
        learnt = np.flatnonzero(times)[::-1]
        first = np.full(len(distinct), -1)
        first[place[learnt]] = learnt  # the last written, the first in order, stays
        owner = np.zeros(len(place), bool)
        owner[first[first >= 0]] = True
        (n, s), at, out = (k.as_py() for k in key), 0, []
        for i, own in zip(by_block, keys):
            here = slice(at, at + len(own))
            at += len(own)
            own = place[here]
            out.append((blocks[i], n, s, pack(total[own].astype(np.uint64)),
                        pack(np.packbits([owner[here], shared[here]], axis=1)),
                        pack_rising(rank[own[common[own]]]) if n < order else None, None))
        out.append((None, n, s, None, None, None, _of(total)))
        return _reply(out)

    return run


class _Block:
    """A block with the totals of its words and n-grams up to ``order``; ``settle`` makes one order after the other usable."""

    def __init__(self, numbered: pa.Table, replies: pa.Table, model: Model, order: int):
        rows = numbered.to_pylist()
        self.model, self.texts = model, [r for r in rows if r["kind"] == TEXT]
        lists, hashes = _words(rows)
        self.levels, self.ends = _levels([unpack(r["a"], np.uint32) for r in self.texts], hashes, order)
        self.answers: dict[int, list[dict]] = {}
        for r in replies.to_pylist():
            self.answers.setdefault(r["kind"], []).append(r)
        for own in self.answers.values():
            own.sort(key=lambda r: r["slice"])
        totals = {r["slice"]: r for r in self.answers.get(WORDS, [])}
        count, shared = np.zeros(len(hashes), np.int64), np.zeros(len(hashes), bool)
        for r in lists:
            count[r["codes"]] = unpack(totals[r["slice"]]["a"], np.uint64)
            shared[r["codes"]] = unpack(totals[r["slice"]]["b"], bool)
        # Words and n-grams that training and other blocks have: (slice, numbers, places among those of the slice).
        self.common = [None, [(r["slice"], r["codes"][shared[r["codes"]] & (count[r["codes"]] > 0)],
                               unpack_rising(totals[r["slice"]]["c"], np.uint32)) for r in lists]]
        # As a context the start mark occurs once per text; as a word the end does.
        count[START] = count[END] = model.texts
        if model.texts:
            self.common[1].append((NO_SLICE, np.array([START]), np.zeros(1, np.uint32)))
        self.count, self.owner = [None, count], [None, None]
        for n in range(2, order + 1):
            own = self.answers.get(n, [])
            found = [(unpack(r["a"], np.uint64), unpack(r["b"], np.uint8).reshape(2, -1)) for r in own]
            self.count.append(np.concatenate([*[c for c, _ in found], np.zeros(0, np.uint64)]).astype(np.int64))
            self.owner.append(np.concatenate([*[np.unpackbits(b[0], count=len(c)) for c, b in found],
                                              np.zeros(0, np.uint8)]).astype(bool))
            if n < order:
                at = np.cumsum([0, *[len(c) for c, _ in found]])
                self.common.append([
                    (r["slice"], a + np.flatnonzero(np.unpackbits(b[1], count=len(c)).astype(bool) & (c > 0)),
                     unpack_rising(r["c"], np.uint32)) for r, a, (c, b) in zip(own, at, found)])
        # Probability of each n-gram's last word after the others, per order.
        self.chance = [None, model.unigram(count)]

    def sums(self, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """By context of order ``n``: whether this block owns followers, their discounted and their shorter-order mass."""
        level, size = self.levels[n], len(self.levels[n - 1].keys)
        mine = np.flatnonzero(self.owner[n])
        owns = np.zeros(size, bool)
        owns[level.context[mine]] = True
        return (owns, np.bincount(level.context[mine], self.model.mass(n, self.count[n][mine]), size),
                np.bincount(level.context[mine], self.chance[n - 1][level.shorter[mine]], size))

    def open(self, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """The contexts of order ``n`` that training has and other blocks have too: slice, numbers, places in the slice, and
        whether their weight is needed here, for a follower that training does not have."""
        size, context = len(self.levels[n - 1].keys), self.levels[n].context
        follows, asks = np.zeros(size, bool), np.zeros(size, bool)
        follows[context] = True
        asks[context[self.count[n] == 0]] = True
        for s, numbers, ranks in self.common[n - 1]:
            use = follows[numbers]
            if use.any():
                yield s, numbers[use], ranks[use], asks[numbers[use]]

    def settle(self, n: int) -> None:
        total, weight = self.model.weights(self.count[n - 1], *self.sums(n)[1:])
        replies = {r["slice"]: r for r in self.answers.get(-n, [])}
        for s, found, _, asks in self.open(n):
            total[found] = self.count[n - 1][found] + np.unpackbits(unpack(replies[s]["a"], np.uint8), count=len(found))
            weight[found[asks]] = unpack(replies[s]["b"], np.float64)
        level, count = self.levels[n], self.count[n]
        self.chance.append(np.where(count > 0, self.model.mass(n, count) / total[level.context],
                                    weight[level.context] * self.chance[n - 1][level.shorter]))


SUMS = "block long, slice int, ranks binary, flags binary, seen binary, below binary, counts binary"


def _context_sums(model: Model, n: int):
    def run(key: tuple, numbered: pa.Table, replies: pa.Table) -> pa.Table:
        rows = []
        if numbered.num_rows:
            block = _Block(numbered, replies, model, n)
            for below in range(2, n):
                block.settle(below)
            owns, seen, lower = block.sums(n)
            for s, found, ranks, asks in block.open(n):
                own = found[owns[found]]
                rows.append((key[0].as_py(), s, pack_rising(ranks), pack(np.packbits([owns[found], asks], axis=1)),
                             pack(seen[own]), pack(lower[own], 1), pack(block.count[n - 1][own])))
        cols = list(zip(*rows)) or [[]] * 7
        kinds = [pa.int64(), pa.int32(), *[pa.binary()] * 5]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                    names=["block", "slice", "ranks", "flags", "seen", "below", "counts"])

    return run


def _add_contexts(model: Model, n: int):
    """Whether each context that a block names counts one more event, and the weights that it asks for."""
    def run(key: tuple, rows: pa.Table) -> pa.Table:
        found = sorted(rows.to_pylist(), key=lambda r: r["block"])
        ranks = [unpack_rising(r["ranks"], np.uint32) for r in found]
        flags = [np.unpackbits(unpack(r["flags"], np.uint8).reshape(2, -1), axis=1, count=len(k)).astype(bool)
                 for r, k in zip(found, ranks)]
        place = np.concatenate([k[owns] for k, (owns, _) in zip(ranks, flags)]).astype(np.int64)
        seen, below, counts = (np.concatenate([unpack(r[c], t) for r in found]) for c, t in (
            ("seen", np.float64), ("below", np.float64), ("counts", np.int64)))
        # A context that training has has a follower that one of these blocks owns, so every count is here.
        size = 1 + max(int(k.max()) for k in ranks)
        count = np.zeros(size, np.int64)
        count[place] = counts
        total, weight = model.weights(count, np.bincount(place, seen, size), np.bincount(place, below, size))
        more = total > count
        return _reply([(r["block"], -n, key[0].as_py(), pack(np.packbits(more[k])), pack(weight[k[asks]], 1), None, None)
                       for r, k, (_, asks) in zip(found, ranks, flags)])

    return run


def _evaluate(model: Model, id_type):
    def run(numbered: pa.Table, replies: pa.Table) -> pa.Table:
        block = _Block(numbered, replies, model, model.order)
        word = block.levels[1].place
        p = block.chance[1][word]
        for n in range(2, model.order + 1):
            block.settle(n)
            place = block.levels[n].place
            p = np.where(place >= 0, np.append(block.chance[n], 0.0)[place], p)
        count = block.count[1][word]
        base = np.log10((count + 1) / (model.tokens + model.types + 1))
        starts = block.ends - np.diff(block.ends, prepend=0)
        sums = [np.add.reduceat(x, starts) if len(starts) else np.zeros(0) for x in (count > 0, base, np.log10(p))]
        return pa.Table.from_arrays(
            [pa.array([r["doc_id"] for r in block.texts], id_type), pa.array([r["held_out"] for r in block.texts], pa.bool_()),
             pa.array(np.diff(block.ends, prepend=0), pa.int64()), pa.array(sums[0], pa.int64()), pa.array(sums[1]),
             pa.array(sums[2])], names=["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])

    return run


def _to_blocks(replies: DataFrame) -> DataFrame:
    return replies.where("block IS NOT NULL").select("block", "kind", "slice", "a", "b", "c")


def score(docs: DataFrame, work: Work, held_out, id_col: str = "doc_id", text_col: str = "text",
          order: int = ORDER) -> DataFrame:
    """One row per document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score (log10).

    Learns from the rows for which the column ``held_out`` is not true. Words are runs without ASCII white space, ASCII
    letters lower-cased; each text has one end token. A null text counts as empty: it is its end. Repeated rows count
    each. With no training text every token is unknown, with probability one. An empty table gives no rows. ``order`` is
    the number of words in the longest n-gram, two or more.
    """
    if order < 2:
        raise ValueError("backoff needs an order of two or more")
    size = docs.agg(F.sum(F.octet_length(F.col(text_col)))).first()[0] or 0
    slices = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // SLICE_BYTES))
    id_field = T.StructField("doc_id", docs.schema[id_col].dataType)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
                       F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    schema = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("kind", T.IntegerType()),
        T.StructField("slice", T.IntegerType()), id_field, T.StructField("held_out", T.BooleanType()),
        T.StructField("n", T.LongType()), *[T.StructField(c, T.BinaryType()) for c in "abc"]])
    buckets = min(slices, MOST_BUCKETS)
    numbered = work.save_buckets(rows.mapInArrow(_number_pass(slices), schema), "block", buckets, "numbered")
    full = numbered.select("block", "kind", "slice", "doc_id", "held_out", "n", "a", "b")
    slim = full.withColumn("doc_id", F.lit(None).cast("string"))
    answers = work.table_name("answers")

    def answer(rows: DataFrame) -> DataFrame:
        """Add rows to the table of answers, in the buckets of their blocks: shuffled once however often they are read."""
        return work.save_buckets(rows.repartition(buckets, "block"), "block", buckets, "answers", answers, lean=True)

    answer(numbered.where(F.col("kind") == WORDS).select("block", "slice", "a", "c")
           .groupBy("slice").applyInArrow(_add_words, REPLY))
    # One order after the other: the shuffled keys of one are gone when the next are listed.
    for n in range(2, order + 1):
        replies = answer(slim.groupBy("block").applyInArrow(_list_grams(slices, n), REPLY).drop("stats")
                         .groupBy("kind", "slice").applyInArrow(_add_grams(order), REPLY))

    def stats(kind: int, size: int) -> list[int]:
        found = replies.where("stats IS NOT NULL").where(F.col("kind") == kind).agg(
            *[F.sum(F.col("stats")[i]) for i in range(size)]).first()
        return [x or 0 for x in found]

    texts = numbered.where((F.col("kind") == TEXT) & ~F.col("held_out")).count()
    tokens, types, *words_of = stats(WORDS, TRUSTED + 3)
    if 0 < texts <= TRUSTED + 1:
        words_of[texts - 1] += 1  # the end of a text is a type like any other
    model = Model(tokens + texts, types + (texts > 0), texts, words_of,
                  [stats(n, TRUSTED + 1) for n in range(2, order + 1)])

    for n in range(2, order + 1):
        sums = slim.groupBy("block").cogroup(_to_blocks(replies).where(F.col("kind") <= n).groupBy("block")).applyInArrow(
            _context_sums(model, n), SUMS)
        replies = answer(sums.groupBy("slice").applyInArrow(_add_contexts(model, n), REPLY))
    out = full.groupBy("block").cogroup(_to_blocks(replies).groupBy("block")).applyInArrow(
        _evaluate(model, to_arrow_type(id_field.dataType)), T.StructType([
            id_field, T.StructField("held_out", T.BooleanType()), T.StructField("n_tokens", T.LongType()),
            T.StructField("n_known", T.LongType()), T.StructField("base_score", T.DoubleType()),
            T.StructField("score", T.DoubleType())]))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"),
                      "base_score", "score")
