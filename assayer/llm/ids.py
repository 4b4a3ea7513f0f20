"""Fast ids of a byte-level BPE file, for operators that only use a tokenizer."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import lru_cache

import tiktoken

from assayer.llm.bpe import PATTERN, byte_letters


@lru_cache(maxsize=2)
def fast_encoder(path: str) -> Callable[[str], bytes]:
    """A function from a text to its ids, as little-endian unsigned 32-bit integers; added tokens in a text are found.

    The merges of the file are handed to the rank-based library, which gives the same ids where a later merge always has the
    higher id. That is checked here.
    """
    with open(path, encoding="utf-8") as file:
        stated = json.load(file)
    values = {letter: b for b, letter in enumerate(byte_letters())}
    ranks = {bytes(values[x] for x in token): i for token, i in stated["model"]["vocab"].items()}
    merges = [m.split(" ") if isinstance(m, str) else m for m in stated["model"]["merges"]]
    made = [stated["model"]["vocab"][a + b] for a, b in merges]
    if made != sorted(made) or min(made) < 256 or stated["normalizer"] or stated["model"]["end_of_word_suffix"]:
        raise ValueError(f"{path} is not a byte-level BPE with ids in the order of its merges")
    added = {t["content"]: t["id"] for t in stated["added_tokens"]}
    coder = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=added)
    return lambda text: coder.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes()
