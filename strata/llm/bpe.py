"""Token ids of texts: UTF-8 bytes, or byte pairs with each word encoded once per worker."""

from __future__ import annotations

import base64
from functools import cache
from itertools import chain

import numpy as np

from strata.llm.tables import located

CACHED_BYTES = 64 << 20  # of words and ids a worker remembers, roughly


class BytePairEncoder:
    """Ordinary encoding (no special tokens) with a rank file and a pattern.

    The tokenizer's pattern must not join a space to what precedes it, so that a
    text may be cut before each single space between two characters that are
    not white space. Texts with other white space around a space are encoded
    uncut.
    """

    def __init__(self, ranks_path: str, pattern: str):
        import tiktoken

        with open(located(ranks_path), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self._encoding = tiktoken.Encoding("corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self._width = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self._width[rank] = len(token)
        self._ids: dict[str, bytes] = {}  # of a word after a space
        self._room = CACHED_BYTES

    def encode(self, text: str | None) -> np.ndarray:
        """Ids of a text (NULL: none) as unsigned 32-bit integers."""
        return self.encode_batch([text])[0]

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        parts = [t.split(" ") if t else [""] for t in texts]
        self._learn(set(chain.from_iterable(p[1:] for p in parts)))
        get = self._ids.__getitem__
        out = []
        for text, words in zip(texts, parts):
            if not text:
                out.append(np.zeros(0, np.uint32))
                continue
            first = words[0]
            try:
                if not first or first[-1].isspace():
                    raise KeyError(first)
                rest = b"".join(map(get, words[1:]))
            except KeyError:  # white space beside a space
                out.append(np.array(self._encoding.encode_ordinary(text), np.uint32))
                continue
            head = np.array(self._encoding.encode_ordinary(first), np.uint32)
            out.append(np.concatenate((head, np.frombuffer(rest, np.uint32))))
        return out

    def _learn(self, words: set[str]) -> None:
        """Ids of the words not yet known, from one call over all of them."""
        if self._room < 0:
            self._ids.clear()
            self._room = CACHED_BYTES
        new = [w for w in words if w not in self._ids and w and not w[0].isspace() and not w[-1].isspace()]
        if not new:
            return
        ids = np.array(self._encoding.encode_ordinary(" " + " ".join(new)), np.uint32)
        ends = np.cumsum([1 + len(w.encode()) for w in new])
        stops = np.searchsorted(np.cumsum(self._width[ids]), ends) + 1
        data = ids.tobytes()
        begin = 0
        for word, stop in zip(new, (stops * 4).tolist()):
            self._ids[word] = data[begin:stop]
            begin = stop
        self._room -= len(data) + 100 * len(new)


class ByteEncoder:
    """Ids of the published byte-level scheme: a text's UTF-8 bytes plus 3 (0 pad,
    1 end of document, 2 unknown)."""

    END = 1

    def encode_batch(self, texts: list[str | None]) -> list[np.ndarray]:
        return [np.frombuffer((t or "").encode(), np.uint8).astype(np.uint32) + 3 for t in texts]


@cache
def encoder(ranks_path: str | None = None, pattern: str | None = None) -> BytePairEncoder | ByteEncoder:
    """The encoder of a Python worker, loaded once: byte pairs with a rank file
    and its pattern, else bytes."""
    return BytePairEncoder(ranks_path, pattern) if ranks_path else ByteEncoder()
