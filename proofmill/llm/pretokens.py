"""Pre-tokens of texts as the public tokenizers split them, with a quick way for plain texts.

Both tokenizers split a text into pre-tokens that are encoded independently. Python's ``re``
agrees with the library's splitter on ASCII, Latin letters and common punctuation; a text with
any other character is split by the library itself, so results never depend on the route.
"""

from __future__ import annotations

import gc
import os
import re
import unicodedata
from collections.abc import Callable
from functools import cache
from typing import ClassVar

import pyarrow as pa

#: Characters on which ``re`` and the tokenizers' splitters may differ: control separators, numerals
#: that are no decimal digits, combining marks, and all scripts beyond Latin.
_OTHER = re.compile("[^\x00-\x1b\x20-\x84\x86-\x9f\xa1-\xb1\xb4-\xb8\xba\xbb\xbf-įı-ɏ‐-‧‰-⁞₠-₿]")

# The splitting patterns of the two vocabularies, for the characters above.
_BYTE_LEVEL = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[^\W\d_]+| ?\d+| ?(?:_|[^\s\w])+|\s+(?!\S)|\s+")
_WORD_LEVEL = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:_|[^\s\w])+")
_LOOSE_SPACES = [" " + c for c in " \n\t\r\x0b\x0c\x85\xa0"]
_PLAIN = bytes(b for b in range(256) if not _OTHER.match(chr(b)))


@cache
def load(path: str):
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@cache
def byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies use for each byte (a rule: printable bytes stand for themselves)."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(kept)]
    return {b: chr(b) for b in kept} | {b: chr(256 + i) for i, b in enumerate(rest)}


def byte_level(piece: str) -> str:
    return piece.encode().decode("latin-1").translate(byte_letters())


@cache
def specials(path: str) -> tuple[re.Pattern | None, dict[str, int]]:
    """Special strings inside texts count as one token each, as is the library's default."""
    ids = {t.content: i for i, t in load(path).get_added_tokens_decoder().items()}
    longest_first = sorted(ids, key=len, reverse=True)
    return (re.compile("(" + "|".join(map(re.escape, longest_first)) + ")") if ids else None), ids


class Known(dict):
    """A bounded cache: ``make`` gives what is missing; what was used since the last change of generations stays.

    Python workers live on after a task. A cache with an ``owner`` is kept for that operator's next task, and dropped as
    soon as a task of another operator begins (``claim``), so a worker holds the caches of one operator only.
    """

    held: ClassVar[list[Known]] = []

    def __init__(self, make: Callable, size: int, owner: str | None = None) -> None:
        super().__init__()
        self.make, self.size, self.old, self.owner = make, size, {}, owner
        if owner is not None:
            Known.held.append(self)

    def forget(self) -> None:
        self.old = {}
        self.clear()

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.size:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


def claim(owner: str | None) -> None:
    """A task of this operator begins: the caches of all others go."""
    if any((k or k.old) and k.owner != owner for k in Known.held):
        for k in Known.held:
            if k.owner != owner:
                k.forget()
        gc.collect()
        pa.default_memory_pool().release_unused()


def other(text: str) -> bool:
    """Whether the library itself has to split this text."""
    if text.isascii():
        return bool(text.encode().translate(None, _PLAIN))
    try:
        return bool(text.encode("latin-1").translate(None, _PLAIN))
    except UnicodeEncodeError:
        return _OTHER.search(text) is not None


def byte_pretokens(text: str, path: str) -> list[str]:
    """Pre-tokens of a byte-level vocabulary."""
    if other(text):
        return [text[s:e] for _, (s, e) in load(path).pre_tokenizer.pre_tokenize_str(text)]
    return _BYTE_LEVEL.findall(text)


def spaced(text: str) -> bool:
    """Whether every space stands before a visible character. There a pre-token of a byte-level vocabulary
    always begins, so such a text may be cut before each of its spaces."""
    return not text.endswith(" ") and not any(pair in text for pair in _LOOSE_SPACES)


def word_chunks(text: str, path: str) -> list[str]:
    """Normalised parts of the text between white space, each a whole number of pre-tokens."""
    if other(text):
        tokenizer = load(path)
        plain = tokenizer.normalizer.normalize_str(text)
        return [plain[s:e] for _, (s, e) in tokenizer.pre_tokenizer.pre_tokenize_str(plain)]
    return unicodedata.normalize("NFC", text).lower().split()


def word_pretokens(chunk: str, path: str) -> list[str]:
    if chunk.isalpha() and chunk.isascii():
        return [chunk]
    if other(chunk):
        return [chunk[s:e] for _, (s, e) in load(path).pre_tokenizer.pre_tokenize_str(chunk)]
    return _WORD_LEVEL.findall(chunk)
