"""Byte-level BPE ids of whole texts.

The vocabulary is one of the public tokenizer files; its path is a parameter.
``byte_bpe_50k.tiktoken`` holds the ranks of the vocabulary in
``byte_bpe_50k.json``: both give the same ids (held by a test).  Special token
strings in a text are ordinary text, or (``special``) get their own id, as the
``tokenizers`` library does unless told otherwise.
"""

from __future__ import annotations

import base64
import functools

import numpy as np

VOCABULARY = "byte_bpe_50k.tiktoken"
#: A run without white space beyond this many characters is encoded by the ``tokenizers`` library, whose
#: time does not grow with the square of such a run.
LONG_RUN = 2000
SPECIAL = "<|endoftext|>"   # the special token of the vocabulary


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@functools.lru_cache(maxsize=4)
def encoder(path: str | None = None):
    """The encoder of a rank file, one per Python worker."""
    import public_tokenizers
    import tiktoken

    with open(path or vocabulary_path(), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


@functools.lru_cache(maxsize=4)
def _slow_encoder(path: str, special: bool):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = not special
    return t


def encode(text: str, path: str | None = None, special: bool = False) -> np.ndarray:
    """uint32 ids of ``text``; ``special``: special token strings are such tokens."""
    if not text:
        return np.empty(0, np.uint32)
    special = special and SPECIAL in text
    if special or len(text) > LONG_RUN and len(max(text.split(), key=len, default="")) > LONG_RUN:
        json_path = (path or vocabulary_path()).removesuffix(".tiktoken") + ".json"
        return np.array(_slow_encoder(json_path, special).encode(text, add_special_tokens=False).ids, np.uint32)
    return np.asarray(encoder(path).encode_to_numpy(text, disallowed_special=()), np.uint32)


def count(text: str, path: str | None = None) -> int:
    return len(encode(text, path))
