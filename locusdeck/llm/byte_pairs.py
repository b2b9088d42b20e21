"""Byte-level BPE ids as the ``tokenizers`` library gives them, for whole texts of any length.

The vocabulary file is read once a process and handed to ``tiktoken``, which merges by rank; the file
has to be of the kind for which that is the same: merges in the order of their ids, plain byte-level splitting, no
normaliser. Runs of white space too long for its pattern engine go through ``tokenizers`` itself.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np

# --- fixed value: how byte-level BPE splits a text into words ---
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# --- end of fixed value ---

#: Longest run of white space for the pattern engine (it gives up beyond about 600,000).
SPACES = 100_000
_SPACES = re.compile(rf"\s{{{SPACES}}}")
# A cut behind a character that is no space, at a single space: no token crosses it.
_CUT = re.compile("(?<=[^\\s▁]) (?=[^\\s▁])")


def _byte_of_char() -> dict[str, int]:
    """The printable characters that stand for bytes in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class BytePairs:
    """ids and token bytes of a byte-level BPE file."""

    def __init__(self, tokenizer_file: str):
        import tiktoken

        with open(tokenizer_file, encoding="utf-8") as f:
            spec = json.load(f)
        splitter, model = spec["pre_tokenizer"], spec["model"]
        if model["type"] != "BPE" or spec["normalizer"] or splitter["type"] != "ByteLevel" or splitter["add_prefix_space"]:
            raise ValueError("only byte-level BPE without a normaliser")
        byte = _byte_of_char()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        usual = {p: i for p, i in model["vocab"].items() if p not in special}
        ranks = {bytes(byte[c] for c in piece): i for piece, i in usual.items()}
        merged = [usual["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if merged != sorted(merged) or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError("merges have to be in the order of their ids, special tokens plain")
        self.file = tokenizer_file
        self.tool = tiktoken.Encoding("byte_pairs", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=special)
        self.bytes_of = [b""] * (max([*usual.values(), *special.values()]) + 1)
        for data, i in ranks.items():
            self.bytes_of[i] = data
        for text, i in special.items():
            self.bytes_of[i] = text.encode()
        self._slow = None

    def encode(self, text: str, special: bool = True) -> np.ndarray:
        """Ids (unsigned 32 bit) of a text; ``special``: whether names of special tokens in it are those tokens."""
        if len(text) >= SPACES and _SPACES.search(text):
            if self._slow is None:
                from tokenizers import Tokenizer

                self._slow = Tokenizer.from_file(self.file)
            self._slow.encode_special_tokens = not special
            return np.array(self._slow.encode(text, add_special_tokens=False).ids, np.uint32)
        if special:
            return self.tool.encode_to_numpy(text, allowed_special="all")
        return self.tool.encode_to_numpy(text, disallowed_special=())


_loaded: dict[str, BytePairs] = {}


def byte_pairs(tokenizer_file: str) -> BytePairs:
    """The process's encoder for a vocabulary file, which every worker can open."""
    if tokenizer_file not in _loaded:
        _loaded[tokenizer_file] = BytePairs(tokenizer_file)
    return _loaded[tokenizer_file]


def stretches(text: str, block: int) -> Iterator[str]:
    """The text in stretches of about ``block`` characters, cut at single spaces, which belong to no stretch.

    A space and the stretch behind it have the ids that they have in the whole text. Without such a space
    a stretch is longer.
    """
    start = 0
    while len(text) - start > block:
        cut = _CUT.search(text, start + block)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:] if start else text
