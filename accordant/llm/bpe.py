"""Byte-level BPE as a lazily compiled deterministic transducer over space-delimited symbols.

A single space between two non-space characters is always a token boundary of the byte-level
pre-tokenizer, whatever stands before it, so a text is a walk over symbols cut at such spaces. The
transducer has two states, the start of a text and inside it; each transition, one per symbol, is
annotated with the tokens it emits. Transitions are compiled when first met.
"""

from __future__ import annotations

import base64
import re

import numpy as np

#: A cut: one space between characters that no pattern of the pre-tokenizer treats as white space.
CUT = re.compile(r"(?<=\S) (?=\S)")
SPECIAL = "<|endoftext|>"
SPECIAL_ID = 50256
_OTHER_SPACE = re.compile(r"[^\S \n]")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def load_ranks(path: str):
    """Encoder of single symbols, from the vocabulary and merges of a tokenizer file."""
    import json

    import tiktoken

    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    table = _byte_characters()
    ranks = {bytes(table[c] for c in token): i for token, i in model["vocab"].items() if token != SPECIAL}
    pattern = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
    return tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


def _byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def symbols(text: str) -> list[str]:
    """``text`` cut at single spaces between non-space characters; the cutting space is left out."""
    if ("  " in text or " \n" in text or "\n " in text or text[:1].isspace() or text[-1:].isspace()
            or _OTHER_SPACE.search(text)):
        return CUT.split(text)
    return text.split(" ")


class Transducer(dict):
    """Transitions that leave the inner state, compiled on first use, at most ``limit`` at a time.

    ``emit`` turns the ids of a symbol into the transition's annotation: their number, or the ids.
    """

    def __init__(self, path: str, emit, limit: int = 400_000):
        super().__init__()
        self.encode, self.emit, self.limit = load_ranks(path), emit, limit

    def __missing__(self, symbol: str):
        if len(self) >= self.limit:
            self.clear()
        value = self[symbol] = self.emit(self.encode(" " + symbol))
        return value

    def start(self, symbol: str):
        """Annotation of the transition out of the start state."""
        return self.emit(self.encode(symbol))


def count_of(ids: list[int]) -> int:
    return len(ids)


def packed(ids: list[int]) -> bytes:
    return np.array(ids, "<u4").tobytes()
