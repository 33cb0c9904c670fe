"""Byte-level BPE: encoding by batched merge rounds over flat arrays, and decoding.

`encode` gives the ids that the tokenizers library gives for a vocabulary file
with a byte-level pre-tokenizer, `decode` its text of them. Texts are cut into
words by the file's pattern; words not seen before by a worker are merged
together in numpy: their symbols lie in one flat array, and every round merges
the lowest-ranked pair of each word wherever it occurs in it. Ranks come from a
binary search over the sorted keys of all pairs.

A null text counts as empty and has no ids. Every row is coded by itself, so
repeated rows, repeated or null ids, ties and other columns of any name don't
matter; only doc_id and the text are read. No rows give no rows.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import text_blocks
from .tokens import _byte_letters

#: The byte-level pre-tokenizer's pattern, for letters within SETTLED. Contractions are its fixed values.
WORDS = re.compile(r" ?[^\W\d_]++|'(?:[stmd]|re|ve|ll)| ?\d++| ?(?:[^\s\w]|_)++|\s+(?!\S)|\s+")
#: Letters whose classes are the same here and in the library; texts with others are cut by the library, whose Unicode tables are older.
SETTLED = re.compile("[\0-\x1b -\xb1\xb4-\xb8\xba\xbb\xbf-\u0530\u2010-\u2027\u2030-\u205e\u3041-\u3096\u30a1-\u30fa\u4e00-\u9fa5\uac00-\ud7a3\U0001f300-\U0001f320]*+")
#: Words that a worker keeps; beyond that it starts anew.
CACHE = 250_000
#: Symbols in a flat array; a longer word has one of its own.
SYMBOLS = 1 << 20
#: Letters of a text, or ids, that are worked on at a time.
PIECE = 1 << 20
#: No word goes on behind a letter that a space follows, so a long text can be cut here.
SAFE = re.compile(r"\S \S")

NONE = np.int32(np.iinfo(np.int32).max)


class ByteCoder:
    """Ids and texts of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, split = spec["model"], spec["pre_tokenizer"]
        self.path, self.cutter = path, None
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges") if model.get(k)]
        if odd or spec["normalizer"] or split["type"] != "ByteLevel" or split["add_prefix_space"]:
            raise ValueError("a byte-level vocabulary without normaliser, prefix space or word ends is needed")
        vocab, letters = model["vocab"], _byte_letters()
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in spec["added_tokens"]):
            raise ValueError("added tokens must stand for themselves")
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        pairs = np.array([[vocab[a], vocab[b]] for a, b in merges], np.int64).reshape(-1, 2)
        self.product = np.array([vocab[a + b] for a, b in merges], np.int64)
        if len(np.unique(self.product)) < len(merges):
            raise ValueError("each merge must have a product of its own, so that later merges rank higher")
        keys = pairs[:, 0] << 32 | pairs[:, 1]
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int32)
        self.byte_ids = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.byte_ids[byte] = vocab[letter]
        bodies = [b""] * (max([*vocab.values(), *added.values()]) + 1)
        for token, i in (vocab | added).items():
            bodies[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        self.sizes = np.array([len(b) for b in bodies], np.int64)
        self.begins = np.cumsum(self.sizes) - self.sizes
        self.bodies = np.frombuffer(b"".join(bodies), np.uint8)
        self.added = {t: np.array([i], "<i4").tobytes() for t, i in added.items()}
        self.at_added = re.compile("(" + "|".join(sorted(map(re.escape, added), key=len, reverse=True)) + ")") if added else None
        self.known = dict(self.added)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair of symbols, NONE where the file doesn't merge it."""
        wanted = left << 32 | right
        at = np.searchsorted(self.keys, wanted)
        at[at == len(self.keys)] = 0
        return np.where(self.keys[at] == wanted, self.ranks[at], NONE)

    def merge(self, symbols: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words, one behind the other, and how many each has. sizes: symbols of each word, 1 or more.

        Merged symbols leave a gap, which links skip; words that are done and
        gaps go when they take up much of the array.
        """
        words = np.arange(len(sizes))
        done: list[tuple[np.ndarray, np.ndarray]] = []
        while len(words):
            n = len(symbols)
            ends = np.cumsum(sizes)
            starts = ends - sizes
            following, before = np.arange(1, n + 1), np.arange(-1, n - 1)
            following[ends - 1], before[starts] = -1, -1
            ranks = np.full(n, NONE, np.int32)
            live = np.ones(n, bool)
            inner = np.flatnonzero(following >= 0)
            ranks[inner] = self.rank(symbols[inner], symbols[inner + 1])
            gaps = 0
            while True:
                least = np.minimum.reduceat(ranks, starts)
                open_words = least < NONE
                if 2 * (gaps + int(sizes[~open_words].sum())) > n or not open_words.any():
                    break
                left = np.flatnonzero(ranks == (least[0] if len(least) == 1 else np.repeat(np.where(open_words, least, -1), sizes)))
                # of a run of one symbol, pairs are taken from the left
                place = np.arange(len(left))
                first = np.ones(len(left), bool)
                first[1:] = following[left[:-1]] != left[1:]
                left = left[(place - np.maximum.accumulate(np.where(first, place, 0))) % 2 == 0]
                right = following[left]
                after = following[right]
                symbols[left] = self.product[ranks[left]]
                following[left] = after
                before[after[after >= 0]] = left[after >= 0]
                live[right], ranks[right], ranks[left] = False, NONE, NONE
                gaps += len(right)
                anew = np.concatenate([left[after >= 0], before[left][before[left] >= 0]])
                ranks[anew] = self.rank(symbols[anew], symbols[following[anew]])
            kept = np.add.reduceat(live, starts, dtype=np.int64)
            stays = np.repeat(open_words, sizes)
            done.append((np.repeat(words[~open_words], kept[~open_words]), symbols[live & ~stays]))
            symbols, sizes, words = symbols[live & stays], kept[open_words], words[open_words]
        owner = np.concatenate([w for w, _ in done]) if done else np.zeros(0, np.int64)
        order = np.argsort(owner, kind="stable")
        ids = np.concatenate([s for _, s in done])[order] if done else np.zeros(0, np.int64)
        return ids, np.bincount(owner).astype(np.int64)

    def learn(self, words: list[str]) -> None:
        """Ids of words that aren't known yet, a flat array of symbols at a time."""
        coded = [w.encode() for w in words]
        sizes = np.array([len(c) for c in coded], np.int64)
        ends, a = np.cumsum(sizes), 0
        while a < len(words):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + SYMBOLS, "right")))
            symbols = self.byte_ids[np.frombuffer(b"".join(coded[a:b]), np.uint8)]
            ids, counts = self.merge(symbols, sizes[a:b])
            raw, last = ids.astype("<i4").tobytes(), 0
            for word, end in zip(words[a:b], (np.cumsum(counts) * 4).tolist(), strict=True):
                self.known[word] = raw[last:end]
                last = end
            a = b

    def parts(self, text: str) -> Iterator[str]:
        """A text cut at added tokens and, if long, where no word goes on."""
        found = self.at_added and any(t in text for t in self.added)
        for part in self.at_added.split(text) if found else [text]:
            a = 0
            while len(part) - a > 2 * PIECE and (cut := SAFE.search(part, a + PIECE)):
                yield part[a : cut.start() + 1]
                a = cut.start() + 1
            yield part[a:]

    def words(self, part: str) -> list[str]:
        if SETTLED.fullmatch(part):
            return WORDS.findall(part)
        if self.cutter is None:
            self.cutter = Tokenizer.from_file(self.path).pre_tokenizer
        return [part[a:b] for _, (a, b) in self.cutter.pre_tokenize_str(part)]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each text; about PIECE letters are worked on at a time."""
        out: list[list[bytes]] = [[] for _ in texts]
        waiting: list[tuple[int, list[str]]] = []

        def flush() -> None:
            seen = set().union(*(w for _, w in waiting))
            if new := seen.difference(self.known):
                if len(self.known) + len(new) > CACHE:
                    self.known = dict(self.added)
                    new = seen.difference(self.known)
                self.learn(list(new))
            known = self.known
            for i, words in waiting:
                out[i].append(b"".join([known[w] for w in words]))
            waiting.clear()

        letters = 0
        for i, text in enumerate(texts):
            for part in self.parts(text):
                waiting.append((i, [part] if part in self.added else self.words(part)))
                letters += len(part)
                if letters > PIECE:
                    flush()
                    letters = 0
        flush()
        return [b"".join(pieces) for pieces in out]

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes behind ids."""
        out = []
        for a in range(0, len(ids), PIECE):
            part = ids[a : a + PIECE]
            sizes = self.sizes[part]
            where = np.arange(int(sizes.sum())) + np.repeat(self.begins[part] - np.cumsum(sizes) + sizes, sizes)
            out.append(self.bodies[where].tobytes())
        return b"".join(out)


@lru_cache(2)
def coder(path: str) -> ByteCoder:
    """One coder for a Python worker."""
    return ByteCoder(path)


def _encoded(vocabulary: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id and ids of doc_id and text, about PIECE bytes of text at a time."""
    own = coder(vocabulary)
    for batch in batches:
        for a, b, _, _ in text_blocks(batch.column(1), PIECE):
            coded = own.encode([t or "" for t in batch.column(1).slice(a, b - a).to_pylist()])
            ends = np.cumsum([0, *map(len, coded)]) // 4
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(coded), "<i4")))
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), ids], ["doc_id", "ids"])


def _decoded(vocabulary: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """doc_id, ids and text of doc_id and ids, about PIECE ids at a time."""
    own = coder(vocabulary)
    for batch in batches:
        ids, ends = batch.column(1), np.cumsum(pc.fill_null(pc.list_value_length(batch.column(1)), 0).to_numpy())
        a = 0
        while a < len(batch):
            b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + PIECE, "right")))
            texts = [own.decode(i.values.to_numpy(zero_copy_only=False)).decode("utf-8", "replace") if i.is_valid else "" for i in ids.slice(a, b - a)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), ids.slice(a, b - a), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])
            a = b


def encode(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """doc_id and ids (array of int) of every text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col(text).alias("text")).mapInArrow(lambda batches: _encoded(vocabulary, batches), f"doc_id {kind}, ids array<int>")


def decode(coded: DataFrame, vocabulary: str) -> DataFrame:
    """coded with the text behind its ids, special tokens included; bytes that aren't UTF-8 become the replacement character. Null ids count as none."""
    kind = coded.schema["doc_id"].dataType.simpleString()
    return coded.select("doc_id", "ids").mapInArrow(lambda batches: _decoded(vocabulary, batches), f"doc_id {kind}, ids array<int>, text string")


def round_trip(docs: DataFrame, vocabulary: str, text: str = "text") -> DataFrame:
    """decode(encode(docs)) in one pass of a worker."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col(text).alias("text")).mapInArrow(lambda batches: _decoded(vocabulary, _encoded(vocabulary, batches)), f"doc_id {kind}, ids array<int>, text string")


def digests(decoded: DataFrame) -> DataFrame:
    """Number of ids, and hashes of the ids (decimal, joined by commas) and of the text."""
    return decoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
