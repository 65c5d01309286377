"""Cutting texts into pre-tokens, so that equal ones are done once.

Merges never cross the border of two pre-tokens, so a text's tokens are those of its
pre-tokens in turn.  Pre-tokens repeat heavily: each task keeps the result per pre-token
and makes only the unseen ones.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable, Iterable

# Characters for which Python's and the library's classes, lower case and composition are
# the same: ASCII, Latin letters, common dashes and quotes.
_OTHER_SCRIPT = re.compile("[^\x00-ɏ‐-‟…]")

# The vocabulary's split pattern for these characters; its letter, digit and space classes
# are written out, as Python's differ from the library's on a few signs.
_LETTERS, _DIGITS, _SPACES = "a-zA-ZªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾", "\t-\r \x85\xa0"
_SPLIT = f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^{_LETTERS}{_DIGITS}{_SPACES}]+"
_LIBRARY_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

# A cache is emptied at so many entries (some 200 bytes each beside their letters) or letters (at most
# some 40 bytes each, an identifier a letter): 150 MB in a Python worker at worst, 50 MB as a rule.
CACHE_ENTRIES = 250_000
CACHE_LETTERS = 2_500_000
# Longer pre-tokens hardly repeat and are made anew.
LONGEST_KEPT = 64


class _Cache(dict):
    """A dictionary that makes what it lacks, and empties itself when full."""

    def __init__(self, make: Callable[[str], object]):
        super().__init__()
        self.make = make
        self.letters = 0

    def __missing__(self, key: str):
        value = self.make(key)
        if len(key) > LONGEST_KEPT:
            return value
        if len(self) >= CACHE_ENTRIES or self.letters >= CACHE_LETTERS:
            self.clear()
            self.letters = 0
        self[key] = value
        self.letters += len(key)
        return value


class PretokenResults:
    """What ``of_pretoken`` gives for each pre-token, joined over a text by ``join``.

    ``of_pretoken`` takes a pre-token in the vocabulary's byte letters, ``of_special`` the
    id of an added token.
    """

    def __init__(
        self,
        path: str,
        of_pretoken: Callable[[str], object],
        of_special: Callable[[int], object],
        join: Callable[[Iterable], object],
    ):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.tokenizer = Tokenizer.from_file(path)
        splits = [p.get("pattern", {}).get("Regex") for p in spec["pre_tokenizer"]["pretokenizers"]]
        lowers = [n["type"] for n in spec["normalizer"]["normalizers"]] == ["NFC", "Replace", "Lowercase"]
        self.known_split = lowers and splits[0] == _LIBRARY_SPLIT
        self.split = re.compile(_SPLIT).findall
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
        self.any_special = re.compile("|".join(map(re.escape, self.specials)) or r"(?!)")
        letters = byte_letters()
        self.of_special, self.join = of_special, join
        self.lettered = _Cache(of_pretoken)
        self.plain = _Cache(lambda p: of_pretoken("".join([letters[b] for b in p.encode()])))

    def of_text(self, text: str | None):
        if not text:
            return self.join([])
        special = self.any_special.search(text) if "<" in text else None
        if self.known_split and not special and (
            text.isascii() or not _OTHER_SCRIPT.search(text) and unicodedata.is_normalized("NFC", text)
        ):
            return self.join(map(self.plain.__getitem__, self.split(text.lower())))
        results, at = [], 0
        for found in self.any_special.finditer(text):
            results += self._by_library(text[at : found.start()])
            results.append(self.of_special(self.specials[found.group()]))
            at = found.end()
        return self.join([*results, *self._by_library(text[at:])])

    def _by_library(self, text: str) -> list:
        normal = self.tokenizer.normalizer.normalize_str(text)
        return [self.lettered[p] for p, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str(normal)]


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies.

    Visible Latin-1 characters stand for themselves, the other bytes in order for the
    characters from U+0100 on.
    """
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(rest)) for b in range(256)]
