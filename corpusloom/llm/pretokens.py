"""The pieces that a byte-level BPE vocabulary works on, and a vocabulary.

A text is cut at the vocabulary's special strings and then by the fixed
pattern; merges never cross a piece. White space is spelled out, because
regular expression libraries disagree on its short form.
"""

from __future__ import annotations

import json
from functools import lru_cache

import regex

_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
# Fixed value: the pattern of the byte-level vocabularies.
PIECES = (
    rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{_SPACE}\p{{L}}\p{{N}}]+"
    rf"|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+"
)
PATTERN = regex.compile(PIECES)
# A blank with white space or the end behind it.
_LOOSE = regex.compile(rf" (?:[{_SPACE}]|\Z)")


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """Where a public vocabulary file stands on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def read_json(path: str) -> dict:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def byte_letters() -> dict[str, int]:
    """The printable letters that stand for bytes in the file: printable ones
    for themselves, the others for code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def merge_pairs(spec: dict) -> list[list[str]]:
    """The merges in order of rank; files write a pair as a list or a string."""
    return [x if isinstance(x, list) else x.split(" ") for x in spec["model"]["merges"]]


def special_strings(spec: dict) -> dict[str, int]:
    return {t["content"]: t["id"] for t in spec["added_tokens"]}


def blocks(text: str) -> list[str]:
    """A text cut before each blank that a word follows, where no piece can
    cross; texts that have other blanks, too, stay whole."""
    if _LOOSE.search(text):
        return [text]
    first, *rest = text.split(" ")
    return ([first] if first else []) + [" " + x for x in rest]


class Memo:
    """What was worked out for a block, for the two last generations of at most
    ``size`` blocks: frequent ones stay, memory is bounded."""

    def __init__(self, size: int):
        self.size, self.new, self.old = size, {}, {}

    def missing(self, keys) -> list[str]:
        """The distinct ``keys`` that are not known; known ones are kept."""
        out = []
        for key in set(keys).difference(self.new):
            value = self.old.get(key)
            if value is None:
                out.append(key)
            else:
                self.new[key] = value
        return out

    def add(self, keys, values) -> None:
        self.new.update(zip(keys, values))

    def turn(self) -> None:
        """Between batches: a full generation becomes the old one."""
        if len(self.new) > self.size:
            self.old, self.new = self.new, {}
