"""Token ids of texts by a byte-pair vocabulary file.

Texts of Latin letters without special tokens take a faster library that knows the same
vocabulary by its ranks; all others take the library of the vocabulary file.  That one is loaded
only when a text needs it, and nothing is kept in a worker after the task that asked.
"""

from __future__ import annotations

import base64
import json
from array import array
from functools import cache

import numpy as np

#: Above this character the two libraries may part a text differently.
LATIN_END = 0x250


def _latin(text: str) -> bool:
    return text.isascii() or int(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").max()) < LATIN_END


def encoder(vocabulary: str, ranks: str | None = None, end: int | None = None):
    """A function from a text to its ids (unsigned 32 bits), closed by ``end`` if that is given."""
    @cache
    def whole():
        from tokenizers import Tokenizer

        return Tokenizer.from_file(vocabulary)

    fast, special = None, ()
    if ranks is not None:
        import public_tokenizers
        import tiktoken

        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("same-ids", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        with open(vocabulary, encoding="utf-8") as f:
            special = tuple(t["content"] for t in json.load(f).get("added_tokens", ()))

    def encode(text: str) -> np.ndarray:
        if fast is not None and _latin(text) and not any(s in text for s in special):
            ids = fast.encode_ordinary(text)
        else:
            ids = whole().encode(text, add_special_tokens=False).ids
        if end is not None:
            ids.append(end)
        return np.frombuffer(array("I", ids), np.uint32)
    return encode
