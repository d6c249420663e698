"""Byte-level BPE vocabularies, and texts cut into parts that are tokenized on their own."""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from functools import lru_cache
from operator import add

import regex

#: How the byte-level vocabularies split a text before merging; a fixed value.
PRETOKEN = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)
_RARE_SPACES = [chr(i) for i in range(0x3001) if chr(i).isspace() and chr(i) not in " \n"]
_SIGNS = set("!\"#$%&()*+,-./:;<=>?@[]^_`{|}~")
_BOUNDARY = re.compile(r"(?<=\S)(?= \S)")


def byte_alphabet() -> dict[str, int]:
    """The character that stands for each byte: itself if printable, else one above 255."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [byte for byte in range(256) if byte not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Merges and bytes of a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        ids, byte = content["model"]["vocab"], byte_alphabet()
        self.special = {x["content"]: x["id"] for x in content["added_tokens"]}
        self.size = 1 + max([*ids.values(), *self.special.values()])
        self.octets = {i: bytes(byte[c] for c in token) for token, i in ids.items()}
        self.symbol = [0] * 256
        for character, b in byte.items():
            self.symbol[b] = ids[character]
        self.products: list[int] = []  # by rank
        self.ranks: dict[int, int] = {}  # by left * size + right
        self.made_by: dict[int, tuple[int, int, int]] = {}  # rank, left and right of a token
        for rank, merge in enumerate(content["model"]["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            product, a, b = ids[left + right], ids[left], ids[right]
            self.products.append(product)
            self.ranks.setdefault(a * self.size + b, rank)
            self.made_by.setdefault(product, (rank, a, b))
        self._special = regex.compile("|".join(map(regex.escape, self.special))) if self.special else None

    def sections(self, text: str) -> list[tuple[str, int | None]]:
        """(text, None) or (special string, its id), in order."""
        if not self.special or not any(x in text for x in self.special):
            return [(text, None)]
        found, at = [], 0
        for match in self._special.finditer(text):
            found += [(text[at : match.start()], None), (match[0], self.special[match[0]])]
            at = match.end()
        return [*found, (text[at:], None)]


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def splits_at_blanks(text: str) -> bool:
    """Whether every blank of the text is a place where it may be cut, but for those at its ends."""
    return not (
        "  " in text or " \n" in text or "\n " in text or any(space in text for space in _RARE_SPACES)
    )


class Memo:
    """Values of the parts of texts, each computed once while it is remembered.

    A text is cut before every single space between two characters that are not
    white space. No pretoken crosses such a place, and none looks beyond it, so
    the parts can be tokenized on their own; the value of a text is the sum of
    those of its parts. The same holds between a word of letters only and one
    sign after it. ``compute`` maps a list of parts to their values. Parts longer
    than ``longest`` are not remembered, and of the others the ``limit`` used
    latest at least; that bounds memory and changes no result.
    """

    def __init__(self, compute: Callable[[list[str]], list], limit: int = 200_000, longest: int = 48):
        self.compute, self.limit, self.longest = compute, limit, longest
        self.new: dict[str, dict] = {"": {}, " ": {}}  # by the space before the part
        self.old: dict[str, dict] = {"": {}, " ": {}}

    def _look_up(self, parts: list[str], before: str) -> list:
        new, old = self.new[before], self.old[before]
        absent = set(parts).difference(new)
        if not absent:
            return list(map(new.__getitem__, parts))
        missing = []
        for part in absent:
            value = old.get(part)
            if value is None:
                missing.append(part)
            else:
                new[part] = value
        signed = [x for x in missing if x[-1:] in _SIGNS and x[:-1].isalpha()]
        if signed and len(missing) > 1:
            words = self._look_up([x[:-1] for x in signed], before)
            signs = self._look_up([x[-1] for x in signed], "")
            new = self.new[before]  # which may have been turned over
            new.update(zip(signed, map(add, words, signs)))
            missing = list(set(missing).difference(signed))
        if missing:
            new.update(zip(missing, self.compute([before + part for part in missing])))
        try:
            values = list(map(new.__getitem__, parts))
        except KeyError:  # turned over while the signed words were looked up
            return self._look_up(parts, before)
        for part in absent:
            if len(part) > self.longest:
                del new[part]
        if len(new) > self.limit:
            self.old[before], self.new[before] = new, {}
        return values

    def looked_up(self, parts: list[str], before: str) -> list:
        """The values of parts that come after ``before``, a blank or nothing."""
        return self._look_up(parts, before)

    def values(self, text: str) -> list:
        """The values of the text's parts, in order."""
        if not text:
            return []
        if not splits_at_blanks(text):
            return self._look_up(_BOUNDARY.split(text), "")
        first, *rest = text.split(" ")
        start = self._look_up([first], "") if first else []
        return start + self._look_up(rest, " ") if rest else start
