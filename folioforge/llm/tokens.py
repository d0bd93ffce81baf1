"""Token ids of texts by public tokenizers, whose files are parameters."""

from __future__ import annotations

import base64
import functools
import re

import numpy as np

#: Both libraries split plain text alike; any other character sends a text to the slower reference library.
UNUSUAL = re.compile(r"[^\n\t -~À-ɏ]")


@functools.lru_cache(maxsize=2)
def reference(path: str):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


@functools.lru_cache(maxsize=2)
def ranked(path: str, pattern: str):
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encode(text: str | None, path: str, ranks: tuple[str, str] | None = None) -> np.ndarray:
    """Ids of a text; null is the empty text.

    ``path``: a ``tokenizers`` file. ``ranks``: the same vocabulary's rank file and splitting pattern, used
    for plain texts because it is several times faster and gives the same ids.
    """
    if not text:
        return np.empty(0, np.uint32)
    if ranks and not UNUSUAL.search(text):
        return np.array(ranked(*ranks).encode_ordinary(text), np.uint32)
    return np.array(reference(path).encode(text, add_special_tokens=False).ids, np.uint32)
