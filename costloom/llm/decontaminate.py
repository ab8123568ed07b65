"""Benchmark decontamination: CGK walks over item-sized windows, repeated bit sampling, exact edit distance.

The words of a text are its alphabet. A CGK walk reads a window of n words in 3 n random steps: at step j it emits the symbol
under its pointer (a blank behind the window) and moves on if a random bit of (j, symbol) says so. Two strings that are a few
edits apart fall into step again soon after each edit, so their walks differ at few steps: edit distance has become Hamming
distance. Bit sampling hashes a walk by the symbols at a few of its steps, and is repeated with other bits, other steps and other
anchors until windows that hold an item collide with it often enough.

* Items are grouped by length, so that a group's window has at least 1 / ``SPREAD`` of its longest item's words, less the anchor's
  offset. A repetition's window starts at one of the item's first e + ``ANCHORS`` words (its anchor; e edits leave some of them
  whole), and the first step is always sampled: only places where some anchor stands are walked at all.
* The samples are three for up to ``BUCKET_ITEMS`` items of a group, and one more for each factor of that many.
* The repetitions are found by trial for each group: made-up items of its shortest and longest length get all the edits that they
  may have, at random, and repetitions are added until ``TARGET_RECALL`` of the trials, and each ``AT_LEAST`` times on average, are met.

An item of n words may have int(``max_edits`` * n) edits, and fewer than its words. Candidates are counted first (every word of the item that
is not edited is a word of the stretch) and then verified exactly: an item is found where a stretch of the document is within that
edit distance (words are runs of letters, digits and underscores, in lower case; in scripts that
are written without spaces every letter, digit or vowel sign is a word). Items that may have no edits are found wherever their words stand
in this order, one after another.

The items are read in blocks of bounded size, one pass over the documents each; documents are never joined or shuffled.

Null texts match nothing, nor do items without a word. Very long texts are walked in pieces that
overlap by more than an item and its slack. Repeated items count once, repeated documents give repeated results, ties in distance go to the first place.
An empty benchmark keeps every document. Other columns of the documents are carried along whatever their names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from itertools import chain, repeat

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from .common import fresh, map_texts

MAX_EDITS = 0.2
SPREAD = 1.15
BUCKET_ITEMS = 1000
EARLY = 3
ANCHORS = 3
TARGET_RECALL = 0.9995
AT_LEAST = 5
TRIALS = 2000
MAX_REPETITIONS = 64
BLOCK_BYTES = 4 << 20
BATCH_WORDS = 800_000
#: Han, kana, bopomofo, Yi, Thai, Lao, Myanmar, Khmer, Tai, Balinese, Javanese: letters, digits and their signs, without punctuation.
UNSPACED = (
    "\u3005-\u3007\u3021-\u3029\u303b\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003fffd"
    "\u3041-\u3096\u3099\u309a\u309d-\u309f\u30a1-\u30fa\u30fc-\u30ff\u31f0-\u31ff\uff66-\uff9f\U0001aff0-\U0001b16f"
    "\u3105-\u312f\u31a0-\u31bf\ua000-\ua48c\u0e01-\u0e3a\u0e40-\u0e4e\u0e50-\u0e59\u0e81-\u0ece\u0ed0-\u0ed9\u0edc-\u0edf"
    "\u1000-\u1049\u1050-\u109d\ua9e0-\ua9fe\uaa60-\uaa76\uaa7a-\uaa7f\u1780-\u17d3\u17d7\u17dc\u17dd\u17e0-\u17e9"
    "\u1950-\u1974\u1980-\u19da\u1a20-\u1a7c\u1a80-\u1a99\uaa80-\uaac2\uaadb-\uaadd\u1b00-\u1b4c\u1b50-\u1b59\ua980-\ua9c0\ua9d0-\ua9d9"
)
WORDS = re.compile(rf"[{UNSPACED}]|[^\W{UNSPACED}]+")
_SPACED = re.compile(r"\w+")
_ANY_UNSPACED = re.compile(f"[{UNSPACED}]")
HIT = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("edits", T.IntegerType()),
                                T.StructField("first_word", T.LongType()), T.StructField("item_words", T.IntegerType())]))


def split_words(text: str | None) -> list[str]:
    """The words of a text, which are those of ``WORDS``."""
    low = (text or "").lower()
    return (_SPACED if low.isascii() or not _ANY_UNSPACED.search(low) else WORDS).findall(low)


def infix_distance(pattern: Sequence, text: Sequence, most: int) -> tuple[int, int] | None:
    """Least edit distance of ``pattern`` to any stretch of ``text``, and that stretch's end; None above ``most``.

    Bit-parallel dynamic programming with one bit for each symbol of the pattern.
    """
    m = len(pattern)
    peq: dict = {}
    for i, c in enumerate(pattern):
        peq[c] = peq.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best, end = full, 0, m, m, 0
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | down
        xh = (((eq & up) + up) ^ up) | eq
        plus, minus = (down | ~(xh | up)) & full, up & xh
        score += bool(plus & top) - bool(minus & top)
        plus, minus = plus << 1 & full, minus << 1 & full
        up, down = (minus | ~(xv | plus)) & full, plus & xv
        if score < best:
            best, end = score, j + 1
    return (best, end) if best <= most else None


@dataclass
class Walk:
    """One repetition for the items of a group: walks of windows of ``size`` words from an anchor, sampled at ``steps``.

    ``rows`` are the rows of random bits that the steps use, the first of ``steps`` is 0."""

    offset: int
    size: int
    rows: np.ndarray
    steps: list[int]
    allowed: list[np.ndarray] = field(default_factory=list)
    prefixes: list[np.ndarray] = field(default_factory=list)
    items: list[list[int]] = field(default_factory=list)

    @classmethod
    def draw(cls, offset: int, length: int, samples: int, bits: np.ndarray, rng: np.random.Generator) -> Walk:
        """The first sample is the anchor, the second one of the next ``EARLY`` steps, so that few walks go on; the others are
        anywhere up to twice the window, behind which nearly all walks have left it and emit blanks."""
        size = length - offset
        steps = {0}
        if size > 1:
            steps.add(min(int(rng.integers(1, EARLY + 1)), size - 1))
            steps |= set((1 + rng.permutation(2 * size - 1)[:samples - 2]).tolist())
        return cls(offset, size, rng.integers(0, len(bits), 3 * size), sorted(steps))

    def keys(self, code: np.ndarray, start: np.ndarray, bits: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Hashes of the walks from ``start`` after each sampled step, of which the last ones are the buckets, and the symbols there."""
        at, key, out, seen = start, np.uint64(0), [], []
        for j in range(self.steps[-1] + 1):
            symbol = self._symbol(code, start, at, j, bits)
            if j in self.steps:
                key = _mixed(symbol, key)
                out.append(key)
                seen.append(symbol)
            at = at + (bits[self.rows[j]].take(symbol) if j else 1)  # an anchor is left at once: to stay there tells nothing new
        return out, seen

    def _symbol(self, code: np.ndarray, start: np.ndarray, at: np.ndarray, j: int, bits: np.ndarray) -> np.ndarray:
        symbol = code.take(at, mode="clip")
        if j >= self.size:  # until then no pointer has left the window
            symbol[at >= start + self.size] = bits.shape[1] - 1
        return symbol

    def meet(self, code: np.ndarray, start: np.ndarray, bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and buckets of the walks from ``start``, places of anchors, that end in a bucket. A walk ends at the first sampled
        step at which no item's walk has its hash."""
        at, symbol, key, found = start, code.take(start, mode="clip"), None, np.zeros(len(start), np.int64)
        for j in range(1, self.steps[-1] + 1):
            at = at + (bits[self.rows[j - 1]].take(symbol, mode="clip") if j > 1 else 1)
            symbol = self._symbol(code, start, at, j, bits)
            if j in self.steps:
                k = self.steps.index(j)
                fits = np.flatnonzero(self.allowed[k].take(symbol))  # cheaper than the hash, and most walks end here
                start, at, symbol = start.take(fits), at.take(fits), symbol.take(fits)
                key = _mixed(code.take(start, mode="clip"), np.uint64(0)) if key is None else key.take(fits)
                key = _mixed(symbol, key)
                found = np.minimum(self.prefixes[k].searchsorted(key), len(self.prefixes[k]) - 1)
                clear = np.flatnonzero(self.prefixes[k].take(found) == key)
                if not len(clear):
                    return clear, clear
                start, at, key, symbol, found = (x.take(clear) for x in (start, at, key, symbol, found))
        if key is None:  # windows of one word
            found = self.prefixes[0].searchsorted(_mixed(symbol, np.uint64(0)))
        return start, found

    def hold(self, code: np.ndarray, starts: np.ndarray, numbers: list[int], bits: np.ndarray) -> None:
        """Put items, with the positions of their first words in ``code``, into the buckets of their walks."""
        keys, seen = self.keys(code, starts + self.offset, bits)
        self.allowed = [np.isin(np.arange(bits.shape[1]), symbols) for symbols in seen]
        self.prefixes = [np.unique(k) for k in keys]
        bucket = self.prefixes[-1].searchsorted(keys[-1])
        self.items = [[] for _ in self.prefixes[-1]]
        for number, b in zip(numbers, bucket.tolist()):
            self.items[b].append(number)


def _mixed(symbol: np.ndarray, key: np.ndarray | np.uint64) -> np.ndarray:
    return (key + symbol.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)


def edits_of(n: int, max_edits: float) -> int:
    """How many edits an item of ``n`` words may have: fewer than its words, so that something of it is left."""
    return min(int(max_edits * n), n - 1)


def _trials(n: int, most: int, count: int, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Code of made-up items, code of texts that hold them with ``most`` edits each, where these texts begin, and the largest symbol."""
    symbols = 4 * n + 2 * most + 64
    items = rng.integers(0, symbols, (count, n))
    width = 2 * n + 2 * most + 24
    texts = rng.integers(0, symbols, (count, width))
    for item, text in zip(items, texts):
        words = [[w] for w in item.tolist()]
        for k in rng.permutation(n)[:most].tolist():
            kind, other = rng.integers(0, 4), int(rng.integers(0, symbols))
            words[k] = [[], [other], [*words[k], other], [other, *words[k]]][kind]
        flat = [w for part in words for w in part]
        text[12:12 + len(flat)] = flat
    return items.reshape(-1), texts.reshape(-1), np.arange(count) * width, symbols - 1


def repetitions(sizes: tuple[int, int], max_edits: float, samples: int, seed: int, target: float = TARGET_RECALL) -> list[Walk]:
    """The walks of a group of items of ``sizes`` (shortest, longest), as many as the trials ask for."""
    rng = np.random.default_rng([seed, *sizes, samples])
    most = edits_of(sizes[0], max_edits)
    if not most and sizes[0] == sizes[1]:  # what may have no edits is always met
        return [Walk.draw(0, sizes[0], samples, np.zeros((64, 1)), rng)]
    sets = [(n, *_trials(n, edits_of(n, max_edits), TRIALS // 2, rng)) for n in sorted(set(sizes))]
    bits = rng.integers(0, 2, (64, max(x[-1] for x in sets) + 2), dtype=np.int32)
    bits[:, -1] = 0
    anchors = min(most + ANCHORS, sizes[0] - 1) or 1
    met, walks = [np.zeros(TRIALS // 2, int) for _ in sets], []
    while len(walks) < MAX_REPETITIONS:
        walk = Walk.draw(len(walks) % anchors, sizes[0], samples, bits, rng)
        walks.append(walk)
        for count, (n, items, texts, begins, _) in zip(met, sets):
            padded = np.append(items, np.zeros(walk.size, items.dtype))
            mine = walk.keys(padded, np.arange(len(begins)) * n + walk.offset, bits)[0][-1]
            around = (begins[:, None] + 12 + walk.offset + np.arange(-min(most, 11), most + 1)).reshape(-1)
            theirs = walk.keys(np.append(texts, np.zeros(walk.size, texts.dtype)), around, bits)[0][-1]
            count += (theirs.reshape(len(begins), -1) == mine[:, None]).any(axis=1)
        if all((c > 0).mean() >= target and c.mean() >= AT_LEAST for c in met):
            break
    return walks


@dataclass
class Index:
    """The items of one block with their groups' walks."""

    items: list[tuple[int, list[str]]]
    max_edits: float
    vocabulary: dict[str, int] = field(default_factory=dict)
    walks: list[Walk] = field(default_factory=list)
    bits: np.ndarray | None = None

    @classmethod
    def build(cls, rows: list[tuple[int, str]], max_edits: float = MAX_EDITS, seed: int = 11) -> Index:
        split = [(i, split_words(t)) for i, t in rows]
        index = cls([x for x in split if x[1]], max_edits)
        groups: list[list[tuple[int, int]]] = []
        begins = np.cumsum([0, *(len(w) for _, w in index.items)])
        for number in sorted(range(len(index.items)), key=lambda k: len(index.items[k][1])):
            words = index.items[number][1]
            for w in words:
                index.vocabulary.setdefault(w, len(index.vocabulary) + 1)
            shortest = len(index.items[groups[-1][0][0]][1]) if groups else 0
            if not shortest or len(words) > SPREAD * shortest or index.most(words) and not edits_of(shortest, max_edits):
                groups.append([])
            groups[-1].append((number, int(begins[number])))
        code = np.array([*(index.vocabulary[w] for _, words in index.items for w in words), 0], np.int32)
        rng = np.random.default_rng(seed)
        index.bits = rng.integers(0, 2, (64, len(index.vocabulary) + 2), dtype=np.int32)
        index.bits[:, -1] = 0
        for held in groups:
            numbers, starts = [n for n, _ in held], np.array([b for _, b in held])
            sizes = (len(index.items[numbers[0]][1]), len(index.items[numbers[-1]][1]))
            samples = 3
            while BUCKET_ITEMS ** (samples - 2) < len(held):
                samples += 1
            padded = np.append(code, np.zeros(3 * sizes[1], code.dtype))
            for walk in repetitions(sizes, max_edits, samples, seed):
                walk.hold(padded, starts, numbers, index.bits)
                index.walks.append(walk)
        return index

    def most(self, words: list[str]) -> int:
        return edits_of(len(words), self.max_edits)

    def _candidates(self, code: np.ndarray) -> list[tuple[int, int]]:
        """(item number, first word) of every window whose walk falls into the bucket of an item's walk."""
        padded = np.append(code, np.zeros(max((w.size for w in self.walks), default=0), code.dtype))
        starts: dict[int, list[np.ndarray]] = {}
        anchors: dict[tuple[int, int], np.ndarray] = {}  # of a group's items at one offset, the same for all its walks
        for w in self.walks:
            place = (w.size + w.offset, w.offset)
            if place not in anchors:
                anchors[place] = np.flatnonzero(w.allowed[0].take(code)).astype(np.int32)
            start, bucket = w.meet(padded, anchors[place], self.bits)
            if not len(start):
                continue
            order = np.argsort(bucket, kind="stable")
            kinds, at = np.unique(bucket[order], return_index=True)
            for b, part in zip(kinds.tolist(), np.split(start[order], at[1:])):
                for number in w.items[b]:
                    starts.setdefault(number, []).append(part - w.offset)
        return [(number, first) for number, parts in starts.items() for first in self._plausible(code, number, np.unique(np.concatenate(parts)))]

    def _plausible(self, code: np.ndarray, number: int, firsts: np.ndarray) -> list[int]:
        """The windows that hold as many of the item's words as edits leave of it."""
        words = self.items[number][1]
        most = self.most(words)
        held = np.zeros(self.bits.shape[1], bool)
        held[[self.vocabulary[w] for w in words]] = True
        slack, out = 2 + most, []
        for at in range(0, len(firsts), 1 << 12):
            some = firsts[at:at + (1 << 12)]
            place = some[:, None] + np.arange(-slack, len(words) + slack)
            inside = (place >= 0) & (place < len(code))
            enough = (held[code[np.where(inside, place, 0)]] & inside).sum(axis=1) >= len(words) - most
            out += some[enough].tolist()
        return out

    def search(self, docs: list[list[str]]) -> list[list[tuple[int, int, int]]]:
        """(item number, edits, first word) of the items found in each document, given as lists of words."""
        out: list[list] = [[] for _ in docs]
        if not self.items:
            return out
        get = self.vocabulary.get
        code = np.fromiter(map(get, chain.from_iterable(docs), repeat(0)), np.int32, sum(map(len, docs)))
        ends = np.cumsum([len(words) for words in docs])
        wanted: dict[tuple[int, int], set[int]] = {}
        found = self._candidates(code)
        if not found:
            return out
        # A window belongs to the document that holds its walk's words; its first word may be cut off by the document's start.
        for (number, first) in found:
            n = len(self.items[number][1])
            for d in range(int(np.searchsorted(ends, max(first, 0), "right")), len(docs)):
                begin = int(ends[d]) - len(docs[d])
                if begin >= first + n:
                    break
                wanted.setdefault((d, number), set()).add(first - begin)
        for (d, number), firsts in sorted(wanted.items()):
            words = self.items[number][1]
            pattern = [get(w) for w in words]
            held = set(pattern)
            most = self.most(words)
            slack, best, places = 2 + most, None, []
            for first in sorted(firsts):
                a, b = max(0, first - slack), first + len(words) + slack
                if places and a <= places[-1][1] - len(words):
                    places[-1][1] = b
                else:
                    places.append([a, b])
            begin = int(ends[d]) - len(docs[d])
            for a, b in places:
                stretch = code[begin + a: begin + min(b, len(docs[d]))].tolist()
                # Each word of the item that is not edited is a word of the stretch.
                if sum(map(held.__contains__, stretch)) < len(words) - most:
                    continue
                hit = infix_distance(pattern, stretch, most if best is None else best[0] - 1)
                if hit:
                    best = (hit[0], max(0, a + hit[1] - len(words)))
            if best:
                out[d].append((number, *best))
        return out

    def find(self, texts: list[str | None]) -> list[list[tuple[int, int, int, int]]]:
        """(item_id, edits, first word, item length) of the items found in each text, worked on in batches of bounded size."""
        reach = max((len(w) + 2 * (2 + self.most(w)) for _, w in self.items), default=0)
        best: list[dict[int, tuple[int, int]]] = [{} for _ in texts]
        batch: list[tuple[int, int, list[str]]] = []

        def flush():
            for (n, shift, _), hits in zip(batch, self.search([words for _, _, words in batch])):
                for number, edits, first in hits:
                    best[n][number] = min(best[n].get(number, (edits, first + shift)), (edits, first + shift))
            batch.clear()

        held = 0
        for n, text in enumerate(texts):
            words = split_words(text)
            for a in range(0, max(1, len(words) - reach), BATCH_WORDS):
                piece = words[a:a + BATCH_WORDS + reach]
                if held + len(piece) > BATCH_WORDS and batch:
                    flush()
                    held = 0
                batch.append((n, a, piece))
                held += len(piece)
        flush()
        return [[(self.items[k][0], *hit, len(self.items[k][1])) for k, hit in sorted(found.items())] for found in best]


def blocks(benchmark: DataFrame, text: str, item_id: str, max_edits: float, block_bytes: int):
    """Indexes of the benchmark's items, block by block; a block's texts have ``block_bytes`` on average."""
    items = benchmark.select(F.col(item_id).cast("long").alias("id"), F.col(text).alias("text")).filter(F.col("text").isNotNull()).distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-size // block_bytes)
    for k in range(count):
        part = items.filter(F.pmod(F.xxhash64("id", "text"), F.lit(count)) == k)
        yield Index.build([(r["id"], r["text"]) for r in part.orderBy("id", "text").collect()], max_edits)


def with_hits(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_text: str = "text", item_id: str = "item_id",
              max_edits: float = MAX_EDITS, block_bytes: int = BLOCK_BYTES, drop: tuple[str, ...] = ()) -> tuple[DataFrame, str]:
    """``docs`` with an array of the items found in each; and that column's name."""
    import pyarrow as pa

    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("edits", pa.int32()), ("first_word", pa.int64()), ("item_words", pa.int32())]))
    made, name = [], fresh("hits", docs.columns)

    def finder(index: Index):
        def run(texts):
            found = index.find(texts)
            names = ("item_id", "edits", "first_word", "item_words")
            return [pa.array([[dict(zip(names, h)) for h in hits] for hits in found], kind)]

        return run

    out = docs
    for k, index in enumerate(blocks(benchmark, item_text, item_id, max_edits, block_bytes)):
        made.append(fresh(f"__hits{k}", docs.columns))
        out = map_texts(out, text, [T.StructField(made[-1], HIT)], finder(index))
    every = F.concat(*made) if made else F.array().cast(HIT)
    return out.select(*(F.col(f"`{c}`") for c in docs.columns if c not in drop), every.alias(name)), name


def contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """One row for each item found in a document: doc_id, item_id, edits, first_word, similarity."""
    found, name = with_hits(docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), benchmark, drop=("text",), **options)
    hit = found.select("doc_id", F.explode(name).alias("h"))
    return hit.select("doc_id", "h.item_id", "h.edits", "h.first_word", F.round(1 - F.col("h.edits") / F.col("h.item_words"), 6).alias("similarity"))


def clean(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without those in which an item was found."""
    found, name = with_hits(docs, benchmark, text, **options)
    return found.filter(F.size(name) == 0).select(*(F.col(f"`{c}`") for c in docs.columns))
