"""Token ids of whole texts under a public byte-level vocabulary."""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache

import numpy as np

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs one task per core

LONG_RUN = re.compile(r"\s{2000}|\w{20000}|[^\w\s]{20000}")


def vocabulary_path(name: str) -> str:
    """Path of a public vocabulary file; ``name`` may already be one."""
    if os.path.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def tokenizer(name: str):
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(vocabulary_path(name))
    found.no_padding()
    found.no_truncation()
    return found


def printable_bytes() -> dict[str, int]:
    """The character that byte-level vocabularies write for each byte."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


@lru_cache(maxsize=2)
def encoding(name: str):
    """A fast encoder with the vocabulary of a byte-level tokenizer file, special strings included.

    In such a vocabulary ids follow the order of merges, so they serve as ranks.
    """
    import public_tokenizers
    import tiktoken

    with open(vocabulary_path(name), encoding="utf-8") as file:
        data = json.load(file)
    special = {t["content"]: t["id"] for t in data["added_tokens"]}
    code = printable_bytes()
    ranks = {bytes(code[c] for c in token): i for token, i in data["model"]["vocab"].items() if token not in special}
    return tiktoken.Encoding("vocabulary", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


def token_ids(name: str, text: str) -> np.ndarray:
    """The ids that the ``tokenizers`` library gives without added special tokens.

    Texts with very long runs of one class go to that library itself, which has no limit there.
    """
    if LONG_RUN.search(text):
        return np.array(tokenizer(name).encode(text, add_special_tokens=False).ids, np.uint32)
    return np.asarray(encoding(name).encode_to_numpy(text, allowed_special="all"), np.uint32)
