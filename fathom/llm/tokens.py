"""Token ids of whole texts.

The tokenizer of ``word_bpe_49k.json`` drops white space and never joins two
characters across it, so a text's ids are the ids of its blank-separated
chunks one after another. Each Python worker keeps the ids of chunks it has
seen (a bounded table), which is faster than encoding every repetition. Only
the blank and the line feed cut chunks: the tokenizer sees every other
character itself. To meet fewer different chunks, a text of Latin-1 characters
is lower-cased first, as the tokenizer does character by character. A new
chunk's closing full stop or comma after a letter or digit is looked up apart
(the tokenizer always cuts there), and new chunks of lower-case Latin-1 letters
alone go through the same vocabulary without the normaliser, which leaves them
as they are.
"""

from __future__ import annotations

import json
from itertools import chain

import numpy as np

DEFAULT_TOKENIZER = "word_bpe_49k.json"
END_ID = 2
#: Chunks kept per worker; when the table is full, others are encoded each time (bounds memory, not results).
CACHE_WORDS = 700_000
#: Words looked up together.
GROUP_WORDS = 6_000
#: Longer chunks are encoded but not kept.
CACHE_CHARS = 64

_ENCODERS: dict[str, "WordEncoder"] = {}


def tokenizer_path(name_or_path: str = DEFAULT_TOKENIZER) -> str:
    """Place of a public vocabulary file, or the path itself."""
    if "/" in name_or_path:
        return name_or_path
    import public_tokenizers
    return public_tokenizers.path(name_or_path)


class WordEncoder:
    """Ids of whole texts; new chunks are encoded together, kept apart by a mark that is a token of its own."""

    MARK = "~"

    def __init__(self, name_or_path: str):
        from tokenizers import Tokenizer
        path = tokenizer_path(name_or_path)
        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        spec["normalizer"] = None
        spec["pre_tokenizer"]["pretokenizers"][0] = {"type": "WhitespaceSplit"}
        self.letters = Tokenizer.from_str(json.dumps(spec))
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        mark = self._ids(self.tok, self.MARK)
        if len(mark) != 1:
            raise ValueError("the vocabulary has no token for the mark")
        self.mark = int(mark[0])
        self.known: dict[str, bytes] = {"": b""}

    def _ids(self, tok, text: str) -> np.ndarray:
        return np.array(tok.encode(text, add_special_tokens=False).ids, dtype=self.dtype)

    def _together(self, tok, chunks: list[str]) -> dict[str, bytes]:
        if not chunks:
            return {}
        ids = self._ids(tok, f" {self.MARK} ".join(chunks))
        ends = np.append(np.flatnonzero(ids == self.mark), len(ids)).tolist()
        raw, w, at, out = ids.tobytes(), self.dtype.itemsize, 0, {}
        for chunk, end in zip(chunks, ends, strict=True):
            out[chunk] = raw[at * w:end * w]
            at = end + 1
        return out

    def _encode_new(self, chunks: set[str]) -> dict[str, bytes]:
        out, closed, bare = {}, [], set()
        for c in chunks:
            if c[-1] in ".," and c[-2:-1].isalnum():
                closed.append(c)
                bare.add(c[:-1])
            else:
                bare.add(c)
        bare = {c for c in bare if c not in self.known}
        plain = {c for c in bare if c.isalpha() and c == c.lower() and max(c) < "\u0100"}
        marked = {c for c in bare if self.MARK in c}
        out.update(self._together(self.letters, list(plain)))
        out.update(self._together(self.tok, list(bare - plain - marked)))
        for c in marked:
            out[c] = self._ids(self.tok, c).tobytes()
        ends = {e: self._ids(self.tok, e).tobytes() for e in ".,"}
        for c in closed:
            out[c] = (out[c[:-1]] if c[:-1] in out else self.known[c[:-1]]) + ends[c[-1]]
        return out

    @staticmethod
    def _chunks(text: str | None) -> list[str]:
        text = text or ""
        if "<|" not in text:  # a special token's string is known in its own case only
            try:
                text.encode("latin-1")
                text = text.lower()
            except UnicodeEncodeError:
                pass
        return text.replace("\n", " ").split(" ")

    def _encode_group(self, group: list[list[str]]) -> list[np.ndarray]:
        flat = list(chain.from_iterable(group))
        got = list(map(self.known.get, flat))
        gaps = [i for i, v in enumerate(got) if v is None]
        if gaps:
            new = self._encode_new({flat[i] for i in gaps})
            for i in gaps:
                got[i] = new[flat[i]]
            if len(self.known) < CACHE_WORDS:
                self.known.update((c, v) for c, v in new.items() if len(c) <= CACHE_CHARS)
        out, at = [], 0
        for chunks in group:
            out.append(np.frombuffer(b"".join(got[at:at + len(chunks)]), dtype=self.dtype))
            at += len(chunks)
        return out

    def encode_all(self, texts: list[str | None]) -> list[np.ndarray]:
        """Ids of whole texts (null: none), without special tokens."""
        out: list[np.ndarray] = []
        group: list[list[str]] = []
        size = 0
        for i, text in enumerate(texts):
            group.append(self._chunks(text))
            size += len(group[-1])
            if size >= GROUP_WORDS or i == len(texts) - 1:
                out += self._encode_group(group)
                group, size = [], 0
        return out


def encoder(name_or_path: str = DEFAULT_TOKENIZER) -> WordEncoder:
    """The worker's encoder for one vocabulary file."""
    if name_or_path not in _ENCODERS:
        _ENCODERS[name_or_path] = WordEncoder(name_or_path)
    return _ENCODERS[name_or_path]
