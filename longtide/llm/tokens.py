"""Lengths of texts in tokens of a public tokenizer, whose vocabulary file is a parameter."""

from __future__ import annotations

import base64
from collections.abc import Callable
from functools import lru_cache

#: Where the vocabulary files of the public tokenizers lie; pass another path where they lie elsewhere.
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this vocabulary's texts are cut before its merges apply.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Characters that are counted at a time. A longer text is counted in parts cut before a blank, as no token crosses one
#: from its left, so the count is the same.
PART = 1 << 20


@lru_cache(4)
def counter(path: str = TOKENIZER) -> Callable[[list[str]], list[int]]:
    """A function that counts the tokens of texts; kept for the life of the Python worker."""
    if path.endswith(".tiktoken"):
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        enc = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        one = lambda texts: [len(enc.encode_ordinary(t)) for t in texts]
    elif path.endswith(".model"):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        one = lambda texts: [len(x) for x in sp.encode(texts, num_threads=1)]
    else:
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(path)
        t.encode_special_tokens = True
        one = lambda texts: [len(x.ids) for x in t.encode_batch(texts, add_special_tokens=False)]
    return lambda texts: [sum(one(list(_parts(t)))) if len(t) > PART else one([t])[0] for t in texts]


def _parts(text: str):
    a = 0
    while len(text) - a > PART:
        b = a + PART
        while b < len(text) and not (text[b] == " " and text[b - 1].isalnum() and b + 1 < len(text) and text[b + 1].isalnum()):
            b += 1
        yield text[a:b]
        a = b
    if a < len(text):
        yield text[a:]
