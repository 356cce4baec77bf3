"""Split texts into pre-tokens exactly as the tokenizer files of the ``tokenizers`` library do.

The library's own splitter is exact but slow. Letters and digits below U+0250
have had fixed classes for decades, so texts that stay below that code point
(and general punctuation) go through a compiled pattern of the standard
library; any other text goes through the library.
"""

from __future__ import annotations

import os
import re
import unicodedata
from functools import lru_cache

END = 0x250
WIDE = re.compile("[^\x00-ɏ‐-‧]")
SPACE = "\t-\r \x85\xa0"  # Unicode white space below END; \s of the standard library has four more


def _class(first: str) -> str:
    return "".join(re.escape(chr(c)) for c in range(END) if unicodedata.category(chr(c))[0] == first)


@lru_cache(1)
def byte_level_pattern() -> re.Pattern:
    """The published splitting rule of byte-level BPE, with classes written out."""
    letter, digit = _class("L"), _class("N")
    return re.compile(
        f"'(?:[stmd]|re|ve|ll)| ?[{letter}]+| ?[{digit}]+| ?[^{SPACE}{letter}{digit}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+")


@lru_cache(1)
def word_pattern() -> re.Pattern:
    """The splitting rule of the lower-case word BPE, which drops white space."""
    letter, digit = _class("L"), _class("N")
    return re.compile(f"'(?:[stmd]|re|ve|ll)|[{letter}]+|[{digit}]|[^{SPACE}{letter}{digit}]+")


@lru_cache(1)
def byte_letters() -> dict[int, str]:
    """Code point below END (or of general punctuation) -> its UTF-8 bytes in the letters that byte-level vocabularies use.

    Fixed values: a visible Latin-1 character stands for the byte of its own
    number, the other bytes follow in order from U+0100.
    """
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letter = {b: chr(b) for b in own} | {b: chr(0x100 + n) for n, b in enumerate(b for b in range(256) if b not in own)}
    points = [*range(END), *range(0x2010, 0x2028)]
    return {c: "".join(letter[b] for b in chr(c).encode()) for c in points}


@lru_cache(4)
def load(path: str):
    """The tokenizer of a file, with one thread: Spark runs a task per core."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def special_strings(tokenizer) -> re.Pattern:
    """The special strings that the library finds inside a text before it splits the rest."""
    names = sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)
    return re.compile("(" + "|".join(map(re.escape, names)) + ")") if names else re.compile("(?!)")


def byte_level_pieces(text: str, tokenizer) -> list[str]:
    """Pre-tokens of a text without special strings."""
    if not WIDE.search(text):
        return byte_level_pattern().findall(text)
    return [text[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(text)]
