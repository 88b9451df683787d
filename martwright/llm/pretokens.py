"""Pre-tokens of many texts at once, each distinct one resolved once."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
import regex

# Pre-tokens resolved together; a text of more characters than LONG_TEXT is cut by and by.
BLOCK = 1 << 18
LONG_TEXT = 1 << 20


class Splitter:
    """Cuts texts into the matches of a pattern.

    `others` are characters that the pattern library takes for letters or digits of a newer Unicode
    version, and the tokenizer's library does not; the pattern sees a private character in their place.
    """

    def __init__(self, pattern: str, others: str = ""):
        self.pattern = regex.compile(pattern)
        self.others = frozenset(others)
        self.shown = dict.fromkeys(map(ord, others), "\ue000")

    def cut(self, text: str) -> Iterator[list[str]]:
        """The matches of a text in order, a list of at most about BLOCK at a time."""
        if not text.isascii() and not self.others.isdisjoint(text):
            seen = text.translate(self.shown)
            found = (text[m.start() : m.end()] for m in self.pattern.finditer(seen))
        elif len(text) <= LONG_TEXT:
            yield self.pattern.findall(text)
            return
        else:
            found = (m.group() for m in self.pattern.finditer(text))
        while part := list(islice(found, BLOCK)):
            yield part

    def runs(self, texts: Sequence[str]) -> Iterator[tuple[list[str], list[tuple[int, int]]]]:
        """Runs of pre-tokens, with (row of the text, number of its pre-tokens in the run)."""
        run: list[str] = []
        shares: list[tuple[int, int]] = []
        for row, text in enumerate(texts):
            for part in self.cut(text):
                run += part
                shares.append((row, len(part)))
                if len(run) >= BLOCK:
                    yield run, shares
                    run, shares = [], []
        if shares:
            yield run, shares


def gathered(flat: np.ndarray, ends: np.ndarray, picked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The picked slices of a flat array one behind the other, and the end of each.

    Slice k of the flat array goes from ends[k] to ends[k + 1].
    """
    sizes = (ends[1:] - ends[:-1])[picked]
    out = np.cumsum(sizes)
    if not len(out):
        return flat[:0], out
    at = np.repeat(ends[:-1][picked] - out + sizes, sizes)
    at += np.arange(out[-1])
    return flat[at], out


def token_ids(
    splitter: Splitter, texts: Sequence[str], resolve: Callable[[list[str]], Sequence[bytes]]
) -> list[np.ndarray]:
    """Token ids of each text: the ids of its pre-tokens one behind the other.

    `resolve` gives the ids of each of a list of distinct pre-tokens, as little-endian unsigned 32-bit
    numbers; Arrow finds the distinct ones of a run, so an often repeated word costs one step in a run.
    """
    found: list[list[np.ndarray]] = [[] for _ in texts]
    for run, shares in splitter.runs(texts):
        coded = pa.array(run, pa.string()).dictionary_encode()
        own = resolve(coded.dictionary.to_pylist())
        ends = np.zeros(len(own) + 1, np.int64)
        np.cumsum([len(x) // 4 for x in own], out=ends[1:])
        ids, after = gathered(np.frombuffer(b"".join(own), "<u4"), ends, coded.indices.to_numpy())
        after = np.concatenate([[0], after])
        at = 0
        for row, n in shares:
            found[row].append(ids[after[at] : after[at + n]])
            at += n
    none = np.zeros(0, np.uint32)
    return [x[0] if len(x) == 1 else np.concatenate(x) if x else none for x in found]


def runs_of_texts(column: pa.Array, size: int) -> Iterator[tuple[int, list[str]]]:
    """Consecutive texts of a column, about `size` characters a time, and the first one's row; null is empty."""
    first, texts, n = 0, [], 0
    for row, text in enumerate(column):
        texts.append(text.as_py() or "")
        n += len(texts[-1])
        if n >= size:
            yield first, texts
            first, texts, n = row + 1, [], 0
    if texts:
        yield first, texts
