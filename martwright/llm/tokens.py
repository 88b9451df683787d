"""Per-process views of the public tokenizer files, with the strings that skip the merge step.

A byte-level BPE tokenizer cuts a text into pre-tokens by a pattern, maps each one's bytes to
printable characters and merges these by rank. Both tokenizers here do so; one of them first lower-cases.
"""

from __future__ import annotations

import json
import re
from functools import cache

import regex
from tokenizers import Tokenizer

# Fixed value: the pattern that the library's byte-level step has built in.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# In these characters every Unicode version agrees on letters, spaces and lower case, and no two of
# them compose. A text with any other character is left to the library as a whole.
UNUSUAL = re.compile("[^\t\n\r -~¡-įı-ɏ]")
# What was found for a word is remembered for this many words of a process; later ones are worked out again.
REMEMBERED = 1 << 20


def byte_characters() -> dict[int, str]:
    """The printable character of each byte: itself where it is visible, else the next one from 256 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(256 + i) for i, b in enumerate(hidden)}


# Latin-1 decoding gives each byte as one character, which this table then replaces.
CHARACTERS = byte_characters()
BYTES = {c: b for b, c in CHARACTERS.items()}


def pre_token_pattern(settings: dict) -> str:
    """The pattern whose matches a tokenizer file encodes one by one; other ways of cutting are refused."""
    steps = settings.get("pretokenizers", [settings])
    kinds = [x["type"] for x in steps]
    if kinds == ["ByteLevel"] and steps[0]["use_regex"] and not steps[0]["add_prefix_space"]:
        return BYTE_PATTERN
    if kinds == ["Split", "ByteLevel"] and not (steps[1]["use_regex"] or steps[1]["add_prefix_space"]):
        # The matches themselves are the pieces.
        if steps[0]["behavior"] == "Removed" and steps[0]["invert"] and "Regex" in steps[0]["pattern"]:
            return steps[0]["pattern"]["Regex"]
    raise ValueError(f"this tokenizer cuts texts in another way: {settings}")


class Vocabulary:
    """A tokenizer file: the library's tokenizer, its pattern, and its special strings."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as file:
            settings = json.load(file)
        self.lower = settings["normalizer"] is not None
        self.pattern = regex.compile(pre_token_pattern(settings["pre_tokenizer"]))
        self.special = [x["content"] for x in settings["added_tokens"]]

    def plain(self, text: str) -> bool:
        """Whether pre-tokens may be taken one by one: usual characters and no special string."""
        return not UNUSUAL.search(text) and not any(x in text for x in self.special)

    def merge(self, pre_token: str) -> list[int]:
        """Ids of one pre-token by the library's merge step."""
        mapped = pre_token.encode().decode("latin-1").translate(CHARACTERS)
        return [t.id for t in self.tokenizer.model.tokenize(mapped)]

    def encode(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids


class Remembered(dict):
    """A function of a string that keeps its first results, REMEMBERED of them unless told otherwise."""

    def __init__(self, find, most: int = REMEMBERED):
        super().__init__()
        self.find, self.most = find, most

    def __missing__(self, key: str):
        value = self.find(key)
        if len(self) < self.most:
            self[key] = value
        return value


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def whole_tokens(path: str) -> list[str]:
    """Vocabulary strings proven to encode alone as their one token.

    A string counts when its bytes are text, the pattern leaves it in one piece, and the library
    returns exactly its id for it. Merging depends on nothing but the piece, so the proof holds for
    every occurrence of the string as a pre-token.
    """
    v = vocabulary(path)
    proven = []
    for token, number in sorted(v.tokenizer.get_vocab(with_added_tokens=False).items()):
        try:
            string = bytes(BYTES[c] for c in token).decode()
        except (KeyError, UnicodeDecodeError):
            continue
        if v.plain(string) and v.pattern.findall(string) == [string] and v.encode(string) == [number]:
            proven.append(string)
    return proven
