"""BPE encoding and decoding: speculate on the tokens of a word, verify them, and merge exactly only where that fails.

Every distinct word of a group of texts gets the tokens of a greedy longest match. That guess is the exact encoding if and only
if no merge crosses a border of two tokens, which one vectorised walk decides for all adjacent pairs together: going back in
time, the left token opens along its right edge and the right one along its left edge, and the pair is compatible if no two
symbols that lie next to each other at some time have a merge due before either goes into its own. Words with an incompatible
pair are merged exactly by rank; of words longer than ``LONG`` bytes only windows around such pairs are, widened until both
their borders are compatible, so a word of megabytes costs time in proportion to its length.

The vocabulary is a file of the ``tokenizers`` format (a parameter, never copied): byte-level BPE with word ends, NFC, white
space collapsed, lower case. The driver reads it once and broadcasts its bytes (1.7 MB; the vocabulary does not grow with
the data). A file of another form raises. Texts with code points that Python's Unicode tables do not know are normalised and
split by the file's own steps, as newer tables may know them.

Null texts count as empty, empty texts have no tokens. Very long texts are cut before single spaces into pieces of about
``PIECE`` characters, which changes no word. Special tokens written in a text are those tokens. Repeated rows are encoded
each, ties do not occur (equal texts have equal tokens), empty tables give empty results. All other columns are kept; a
column named like a new one stays, and the new one gets underscores.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
import zlib

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from .common import fresh, map_texts

PIECE = 1 << 19
LONG = 256
CACHED_WORDS = 1 << 18
_NEVER = np.int64(1) << 40
_MODELS: dict[int, Model] = {}


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _byte_names() -> list[str]:
    """The character that stands for each byte in the file: itself if visible in Latin-1, else the next one from 256 on."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


class Model:
    """A vocabulary with its merges as arrays by token id: parts, and the rank of the merge that makes it (-1: a byte)."""

    def __init__(self, raw: bytes):
        import regex
        from tokenizers import Tokenizer

        spec = json.loads(raw)
        model, split = spec["model"], spec["pre_tokenizer"]["pretokenizers"]
        known = (
            model["type"] == "BPE" and model["end_of_word_suffix"] == "</w>" and not model["continuing_subword_prefix"] and not model["dropout"]
            and [x["type"] for x in spec["normalizer"]["normalizers"]] == ["NFC", "Replace", "Lowercase"]
            and [x["type"] for x in split] == ["Split", "ByteLevel"] and spec["decoder"] is None)
        if not known:
            raise ValueError("not a byte-level vocabulary with word ends, lower case and collapsed white space")
        vocab, suffix, names = model["vocab"], model["end_of_word_suffix"], _byte_names()
        self.size = max([*vocab.values(), *(x["id"] for x in spec["added_tokens"])]) + 1
        self.names: list[str] = [""] * self.size
        for token, i in [*vocab.items(), *((x["content"], x["id"]) for x in spec["added_tokens"])]:
            self.names[i] = token
        self.first, self.second = np.zeros(self.size, np.int64), np.zeros(self.size, np.int64)
        self.birth = np.full(self.size, -1, np.int64)
        self.ranks: dict[int, tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = (vocab[x] for x in (pair.split(" ") if isinstance(pair, str) else pair))
            made = vocab[self.names[a] + self.names[b]]
            if self.birth[made] >= 0 or max(self.birth[a], self.birth[b]) >= rank:
                raise ValueError("a merge uses what a later one makes")
            self.first[made], self.second[made], self.birth[made] = a, b, rank
            self.ranks[a * self.size + b] = (rank, made)
        keys = np.fromiter(self.ranks, np.int64, len(self.ranks))
        order = np.argsort(keys)
        self.keys, self.key_ranks = keys[order], order.astype(np.int64)
        self.rank_of, self.made = {k: r for k, (r, _) in self.ranks.items()}, [made for _, made in self.ranks.values()]
        self.inner_bytes, self.final_bytes = [vocab[c] for c in names], [vocab[c + suffix] for c in names]
        byte = {c: b for b, c in enumerate(names)}
        self.inner: dict[bytes, int] = {}
        self.final: dict[bytes, int] = {}
        for token, i in vocab.items():
            ends = token.endswith(suffix)
            (self.final if ends else self.inner)[bytes(byte[c] for c in (token[: -len(suffix)] if ends else token))] = i
        self.reach = max(map(len, [*self.inner, *self.final]))
        self.special = {x["content"]: np.uint32(x["id"]).tobytes() for x in spec["added_tokens"]}
        self.specials = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        pattern = split[0]["pattern"]["Regex"]
        self.words = regex.compile(pattern)
        latin = "".join(map(chr, range(0x250)))  # the same pattern for the faster module, with its classes spelled out
        classes = {c: "".join(map(re.escape, regex.findall(rf"\{c}", latin))) for c in (r"p{L}", r"p{N}", "s")}
        self.latin_words = re.compile(re.sub(r"\\(p\{L\}|p\{N\}|s)", lambda m: classes[m[1]], pattern))
        self.foreign = re.compile("[^\\u0000-\\u024f]")
        file = Tokenizer.from_str(raw.decode())
        self.file_steps = (file.normalizer, file.pre_tokenizer)
        self.cache: dict[str, bytes] = {}
        self.fit: dict[int, bool] = {}

    # -- words of a text

    def split(self, text: str) -> list[str]:
        """The words of a text without special tokens, normalised. White space is in no word, so none need be collapsed."""
        if text.isascii():
            return self.latin_words.findall(text.lower())
        if self.foreign.search(text) and any(unicodedata.category(c) == "Cn" for c in set(text)):
            text = self.file_steps[0].normalize_str(text)
            return [text[a:b] for _, (a, b) in self.file_steps[1].pre_tokenize_str(text)]
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        return (self.words if self.foreign.search(text) else self.latin_words).findall(text)

    # -- speculate

    def propose(self, word: bytes) -> list[int]:
        """Tokens by greedy longest match; the last one ends the word."""
        out, at, n, inner, final, reach = [], 0, len(word), self.inner, self.final, self.reach
        while at < n:
            end = at + reach
            if end >= n:
                token, end = final.get(word[at:]), n
                if token is not None:
                    out.append(token)
                    break
                end = n - 1
            while (token := inner.get(word[at:end])) is None:
                end -= 1
                if end <= at:
                    break
            if token is None:  # the last byte, as one that ends the word
                token, end = final[word[at:at + 1]], at + 1
            out.append(token)
            at = end
        return out

    # -- verify

    def due(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, or never."""
        key = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.key_ranks[at], _NEVER)

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether exact merging of both tokens' text, taken together, ends in these two tokens."""
        good, open_ = np.ones(len(left), bool), np.arange(len(left))
        l_ends, r_ends = np.full(len(left), _NEVER), np.full(len(left), _NEVER)
        while len(open_):
            due = self.due(left, right)
            crossed = (due < l_ends) & (due <= r_ends) & (due < _NEVER)  # of equal merges the left one comes first
            good[open_[crossed]] = False
            l_born, r_born = self.birth[left], self.birth[right]
            go = ~crossed & ((l_born >= 0) | (r_born >= 0))
            open_, left, right, l_ends, r_ends, l_born, r_born = (x[go] for x in (open_, left, right, l_ends, r_ends, l_born, r_born))
            later = l_born >= r_born
            l_ends, r_ends = np.where(later, l_born, l_ends), np.where(later, r_ends, r_born)
            left, right = np.where(later, self.second[left], left), np.where(later, right, self.first[right])
        return good

    def fits(self, left: int, right: int) -> bool:
        key = left * self.size + right
        if key not in self.fit:
            if len(self.fit) > CACHED_WORDS:
                self.fit.clear()
            self.fit[key] = bool(self.compatible(np.array([left]), np.array([right]))[0])
        return self.fit[key]

    # -- merge exactly

    def symbols(self, token: int) -> list[int]:
        """The byte tokens that a token is made of, in order."""
        out, todo = [], [token]
        while todo:
            t = todo.pop()
            if self.birth[t] < 0:
                out.append(t)
            else:
                todo += (int(self.second[t]), int(self.first[t]))
        return out

    def merge(self, symbols: list[int]) -> list[int]:
        """Merges of lowest rank first, of equal ones the leftmost."""
        if len(symbols) <= LONG:
            return self._merge_short(symbols)
        n, ids, ranks, size = len(symbols), list(symbols), self.ranks, self.size
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(*found, i, i + 1) for i in range(n - 1) if (found := ranks.get(ids[i] * size + ids[i + 1]))]
        heapq.heapify(heap)
        while heap:
            _, made, i, j = heapq.heappop(heap)
            if ids[i] < 0 or after[i] != j or ranks.get(ids[i] * size + ids[j], (0, -1))[1] != made:
                continue
            ids[i], ids[j], after[i] = made, -1, after[j]
            if after[i] < n:
                before[after[i]] = i
                if found := ranks.get(made * size + ids[after[i]]):
                    heapq.heappush(heap, (*found, i, after[i]))
            if before[i] >= 0 and (found := ranks.get(ids[before[i]] * size + made)):
                heapq.heappush(heap, (*found, before[i], i))
        return [t for t in ids if t >= 0]

    def _merge_short(self, symbols: list[int]) -> list[int]:
        """``merge`` by a scan of all pairs at every step, which is faster for short words."""
        ids, size, rank_of, never = list(symbols), self.size, self.rank_of, int(_NEVER)
        due = [rank_of.get(a * size + b, never) for a, b in zip(ids, ids[1:])]
        while due and (rank := min(due)) < never:
            i = due.index(rank)
            made = ids[i] = self.made[rank]
            del ids[i + 1], due[i]
            if i < len(due):
                due[i] = rank_of.get(made * size + ids[i + 1], never)
            if i:
                due[i - 1] = rank_of.get(ids[i - 1] * size + made, never)
        return ids

    def mend(self, ids: list[int]) -> list[int]:
        """The exact tokens of a long word: windows around incompatible pairs are merged and widened until they fit in."""
        done, at = [], 0
        while at < len(ids):
            if not done or self.fits(done[-1], ids[at]):
                done.append(ids[at])
                at += 1
                continue
            back = ahead = 4
            while True:
                window = done[-back:] + ids[at:at + ahead]
                at = min(at + ahead, len(ids))
                del done[-back:]
                window = self.merge([s for t in window for s in self.symbols(t)])
                fits = (not done or self.fits(done[-1], window[0])) and (at == len(ids) or self.fits(window[-1], ids[at]))
                done += window
                if fits:
                    break
                back, ahead = len(window) + ahead, 2 * ahead
        return done

    # -- texts

    def encode_words(self, words: list[str]) -> list[list[int]]:
        proposed, sizes = [], []
        for word in words:
            tokens = self.propose(word.encode())
            proposed += tokens
            sizes.append(len(tokens))
        ids, ends = np.array(proposed, np.int64), np.cumsum(np.array(sizes, np.int64))
        inside = np.ones(max(len(ids) - 1, 0), bool)
        inside[ends[:-1] - 1] = False
        where = np.flatnonzero(inside)
        pairs, which = np.unique(ids[where] * self.size + ids[where + 1], return_inverse=True)
        good = self.compatible(pairs // self.size, pairs % self.size)
        failing = set(np.searchsorted(ends, where[~good[which]], "right").tolist())
        out = [proposed[e - n:e] for e, n in zip(ends.tolist(), sizes)]
        for k in failing:
            word = words[k].encode()
            out[k] = self.mend(out[k]) if len(word) > LONG else self.merge([*map(self.inner_bytes.__getitem__, word[:-1]), self.final_bytes[word[-1]]])
        return out

    def pieces(self, text: str) -> list[str]:
        """``text`` cut before spaces into pieces of about ``PIECE`` characters."""
        out, at = [], 0
        while len(text) - at > PIECE:
            end = text.find(" ", at + PIECE)
            if end < 0:
                break
            out.append(text[at:end])
            at = end
        return [*out, text[at:]]

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of every text as little-endian unsigned 32-bit integers."""
        out: list[list[bytes]] = [[] for _ in texts]
        todo: list[tuple[int, list[str] | bytes]] = []
        waiting = 0
        for k, text in enumerate(texts):
            for piece in self.pieces(text or ""):
                for part in self.specials.split(piece) if self.specials else [piece]:
                    if part:
                        todo.append((k, self.special[part] if part in self.special else self.split(part)))
                waiting += len(piece)
                if waiting >= PIECE:
                    self._flush(todo, out)
                    todo, waiting = [], 0
        self._flush(todo, out)
        return [b"".join(x) for x in out]

    def _flush(self, todo: list, out: list[list[bytes]]) -> None:
        here = {w for _, part in todo if isinstance(part, list) for w in part}
        new = [w for w in here if w not in self.cache]
        if len(self.cache) + len(new) > CACHED_WORDS:
            self.cache.clear()
            new = list(here)
        if new:
            self.cache.update(zip(new, (np.array(x, "<u4").tobytes() for x in self.encode_words(new))))
        for k, part in todo:
            out[k].append(part if isinstance(part, bytes) else b"".join(map(self.cache.__getitem__, part)))
        if sum(len(w) for w in new) > 8 * PIECE:  # very long words are not kept
            self.cache.clear()

    def decode(self, packed: bytes | None) -> str:
        """The names of the tokens with spaces between, as the file has no decoder. Ids outside the vocabulary are left out."""
        ids = np.frombuffer(packed or b"", "<u4")
        names = self.names
        return " ".join([names[i] for i in ids[ids < self.size].tolist()])


def model(raw: bytes) -> Model:
    """The model of a vocabulary file, built once in a process."""
    key = zlib.crc32(raw)
    if key not in _MODELS:
        _MODELS[key] = Model(raw)
    return _MODELS[key]


def _shipped(df: DataFrame, vocabulary: str | None):
    with open(vocabulary or default_vocabulary(), "rb") as f:
        raw = f.read()
    model(raw)  # a file of another form raises here
    return df.sparkSession.sparkContext.broadcast(raw)


def encode(docs: DataFrame, text: str = "text", vocabulary: str | None = None, ids: str = "ids") -> DataFrame:
    """``docs`` with a binary column of token ids, little-endian unsigned 32-bit integers one behind the other."""
    raw, ids = _shipped(docs, vocabulary), fresh(ids, docs.columns)

    def fn(texts):
        import pyarrow as pa

        return [pa.array(model(raw.value).encode(texts), pa.binary())]

    return map_texts(docs, text, [T.StructField(ids, T.BinaryType(), False)], fn)


def decode(df: DataFrame, ids: str = "ids", vocabulary: str | None = None, decoded: str = "decoded") -> DataFrame:
    """``df`` with the text of its packed ids."""
    raw, decoded = _shipped(df, vocabulary), fresh(decoded, df.columns)

    def fn(packed):
        import pyarrow as pa

        return [pa.array([model(raw.value).decode(x) for x in packed], pa.string())]

    return map_texts(df, ids, [T.StructField(decoded, T.StringType(), False)], fn)


def round_trip(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", vocabulary: str | None = None) -> DataFrame:
    """Number of tokens and digests of ids and decoded text of every document, encoded and decoded by the same worker."""
    raw = _shipped(docs, vocabulary)
    narrow = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def fn(texts):
        import pyarrow as pa

        own = model(raw.value)
        packed = own.encode(texts)
        return [pa.array(packed, pa.binary()), pa.array(map(own.decode, packed), pa.string())]

    fields = [T.StructField("ids", T.BinaryType(), False), T.StructField("decoded", T.StringType(), False)]
    return map_texts(narrow, "text", fields, fn, ["text"]).select(
        "doc_id", F.floor(F.length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
