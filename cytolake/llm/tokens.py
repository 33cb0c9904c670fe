"""Token ids of whole texts by a public BPE vocabulary file with word ends."""

from __future__ import annotations

import json
import re
import unicodedata
from functools import lru_cache

import numpy as np
import regex
import tiktoken
from tokenizers import Tokenizer

#: Texts within these characters take the fast path; others go to `tokenizers` as they are.
PLAIN = regex.compile(r"[!-~¡-ſ]+")
#: The pre-tokenizer's pattern in the vocabulary file (fixed value).
PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
#: Python's split() takes these for white space, the vocabulary file's pattern doesn't.
OWN_SPACES = frozenset("\x1c\x1d\x1e\x1f")
#: Cuts at ASCII white space alone.
WORDS = re.compile(r"[^ \t-\r]+")
WORD_END = "</w>"
#: Chunks that a worker keeps; beyond that it starts anew.
CACHE = 400_000


def _byte_letters() -> dict[str, int]:
    """The byte behind each letter of a byte-level vocabulary: printable bytes stand for themselves, the others follow from 256."""
    kept = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + i): b for i, b in enumerate(rest)}


class WordEncoder:
    """Ids of `tokenizers` for texts, without special tokens.

    No token spans ASCII white space here, so each chunk between white space is
    encoded once and then looked up. Unseen plain chunks are merged in bulk by
    the file's own ranks (id order is merge order in these files, which the
    constructor checks); all other chunks go through `tokenizers` itself.
    """

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        vocab, letters = model["vocab"], _byte_letters()
        base = len(letters) * 2
        if model.get("end_of_word_suffix") != WORD_END or any(vocab["".join(m)] != base + i for i, m in enumerate(model["merges"])):
            raise ValueError("ids must follow the order of merges, with word ends")
        ranks = {}
        for token, i in vocab.items():
            body = token.removesuffix(WORD_END)
            if i < base + len(model["merges"]):
                ranks[bytes(letters[c] for c in body) + b"\0" * (body != token)] = i
        self.merger = tiktoken.Encoding("words", pat_str=r"[^\x00\x01]+\x00|\x01", mergeable_ranks=ranks, special_tokens={})
        self.gap = ranks[b"\x01"]
        self.known: dict[str, bytes] = {}

    def learn(self, chunks: list[str]) -> None:
        plain = [c for c in chunks if PLAIN.fullmatch(c) and "<|" not in c]
        if plain:
            # one gap after each chunk; letters are lower-cased one by one, so a final sigma stays as it is
            low = [c.lower() if c.isascii() else "".join(map(str.lower, unicodedata.normalize("NFC", c))) for c in plain]
            ids = np.array(self.merger.encode_ordinary("".join(["\0".join(PIECES.findall(c)) + "\0\1" for c in low])), "<u4")
            ends = np.flatnonzero(ids == self.gap)
            raw, last = ids.tobytes(), 0
            for chunk, end in zip(plain, (ends * 4).tolist(), strict=True):
                self.known[chunk] = raw[last:end]
                last = end + 4
        if len(plain) < len(chunks):
            other = [c for c in chunks if "<|" in c or not PLAIN.fullmatch(c)]
            for chunk, e in zip(other, self.whole.encode_batch(other, add_special_tokens=False), strict=True):
                self.known[chunk] = np.array(e.ids, "<u4").tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        split = [t.split() if not any(c in t for c in OWN_SPACES) else WORDS.findall(t) for t in texts]
        seen = set().union(*split)
        if new := seen.difference(self.known):
            if len(self.known) + len(new) > CACHE:
                self.known.clear()
                new = seen
            self.learn(list(new))
        known = self.known
        return [b"".join([known[c] for c in s]) for s in split]


@lru_cache(2)
def encoder(path: str) -> WordEncoder:
    """One encoder for a Python worker."""
    return WordEncoder(path)
