"""Token ids of whole texts by the public byte-level BPE of 50k ids.

Plain texts (Latin letters and common signs, on which the character tables of both libraries agree) go through tiktoken
with the same ranks, five times as fast; all others, and those that spell the special token, through the tokenizers
library, which defines the ids.
"""

from __future__ import annotations

import base64
import re
from array import array

SPECIAL = "<|endoftext|>"
_PLAIN = re.compile(r"[\t\n\x20-\x7e¡-ɏ]*")
_loaded: dict[tuple, TokenBytes] = {}


class TokenBytes:
    """text -> its ids as little-endian unsigned 32-bit numbers, joined in one bytes object."""

    def __init__(self, tokenizer: str, ranks: str, pattern: str, special_is_text: bool):
        import tiktoken
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_file(tokenizer)
        self.exact.encode_special_tokens = special_is_text
        with open(ranks, "rb") as f:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=table, special_tokens={})

    def __call__(self, text: str) -> bytes:
        if _PLAIN.fullmatch(text) and SPECIAL not in text:
            return array("I", self.fast.encode_ordinary(text)).tobytes()
        return array("I", self.exact.encode(text, add_special_tokens=False).ids).tobytes()


def token_bytes(folder: str | None = None, special_is_text: bool = False) -> TokenBytes:
    """One encoder per Python process. folder: where the vocabulary files lie, by default where their package says."""
    if (key := (folder, special_is_text)) not in _loaded:
        import public_tokenizers as public

        path = (lambda name: f"{folder}/{name}") if folder else public.path
        _loaded[key] = TokenBytes(path("byte_bpe_50k.json"), path("byte_bpe_50k.tiktoken"), public.PATTERN, special_is_text)
    return _loaded[key]
