"""Quality rules on repetition: suffix array and longest-common-prefix intervals over words.

Texts are worked on in blocks of about ``BLOCK_WORDS`` words, so that numpy handles many
short texts at once.  The symbols of a block are (text, word) pairs, and a symbol of its own
ends each text, so no repeat crosses texts.  Prefix doubling ranks windows of 1, 2, 4, ...
words; only positions that still tie are sorted again, which ends early for ordinary
prose.  The last ranks give the suffix array, and the ranks of all rounds give the common
prefix of neighbours in it by halving steps.  A text longer than ``ROUND_WORDS`` keeps the last ranks only, and
its common prefixes are found in one linear pass.

A suffix and its neighbour share the longest repeat that starts there, so the spans
``[i, i + longest(i))`` of at least ``min_repeat`` words cover the same words as all maximal
repeated substrings, the intervals of the longest-common-prefix array.  A text fails when
these spans cover more than ``max_covered`` of its words, or when one repeat is longer than
``max_longest`` of them.

Defined results: NULL and empty texts have no words and fail ``min_words``.  A single text
longer than a block is one block.  Other columns and repeated rows pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import BLANKS, drop_worker_tables, free_memory

BLOCK_WORDS = 100_000
ROUND_WORDS = 1_000_000
SYMBOLS = "#*$%&|<>"
FIGURES = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "covered_words long, longest_repeat long"
)


class SuffixBlock:
    """Suffix array of several texts, one symbol array.

    ``first`` holds where each text starts and one position past the last end mark.
    """

    def __init__(self, texts: list[list[bytes]]):
        codes, first, base = [], [0], 0
        for text in texts:
            seen: dict[bytes, int] = {}
            codes.extend([seen.setdefault(w, base + len(seen)) for w in text])
            base += len(seen)
            codes.append(base)
            base += 1
            first.append(len(codes))
        self.first = np.array(first)
        self.size = len(codes)
        symbols = np.array(codes, dtype=np.int64)
        counts = np.bincount(symbols, minlength=base) if codes else np.zeros(0, dtype=np.int64)
        starts = np.cumsum(counts) - counts
        rank = starts[symbols] if codes else np.zeros(0, dtype=np.int64)
        self.symbols = symbols
        # The ranks of every round make common prefixes a few array steps, but take much room for one very long text.
        self.whole = self.size <= ROUND_WORDS
        self.rounds = [rank]
        tied = np.flatnonzero(counts[symbols] > 1) if codes else np.zeros(0, dtype=np.int64)
        step = 1
        while len(tied):
            # A tie ends before the end mark of its text, so tied + step stays inside the block.
            second = rank[tied + step]
            order = np.lexsort((second, rank[tied]))
            at, lead, tail = tied[order], rank[tied][order], second[order]
            new_lead = np.concatenate([[True], lead[1:] != lead[:-1]])
            new_key = new_lead | np.concatenate([[True], tail[1:] != tail[:-1]])
            place = np.arange(len(at))
            lead_start = np.maximum.accumulate(np.where(new_lead, place, 0))
            key_start = np.maximum.accumulate(np.where(new_key, place, 0))
            rank = rank.copy()
            rank[at] = lead + key_start - lead_start
            if self.whole or step == 1:
                self.rounds.append(rank)
            run = np.diff(np.append(np.flatnonzero(new_key), len(at)))
            tied = at[np.repeat(run > 1, run)]
            step *= 2
        self.rank = rank

    def windows_seen_twice(self, length: int) -> np.ndarray:
        """For lengths 2 to 4: the starts of windows that occur at least twice in their text."""
        if len(self.rounds) < 2 or self.size == 0:
            return np.zeros(0, dtype=np.int64)
        pairs = self.rounds[1]
        counts = np.bincount(pairs, minlength=self.size)
        at = np.flatnonzero(counts[pairs] > 1)
        at = at[at + length - 2 < self.size]
        head, tail = pairs[at], pairs[at + length - 2]
        _, where, times = np.unique(head * self.size + tail, return_inverse=True, return_counts=True)
        return at[times[where] > 1]

    def longest_repeats(self, least: int) -> np.ndarray:
        """For each position the longest substring from there that occurs elsewhere too, 0 if below ``least``."""
        longest = np.zeros(self.size, dtype=np.int64)
        if not self.whole:
            left, right, common = self._neighbour_prefixes()
            np.maximum.at(longest, left, common)
            np.maximum.at(longest, right, common)
            longest[longest < least] = 0
            return longest
        level = least.bit_length() - 1
        if len(self.rounds) <= level:
            return longest
        suffixes = np.empty(self.size, dtype=np.int64)
        suffixes[self.rounds[-1]] = np.arange(self.size)
        window = self.rounds[level]
        pairs = np.flatnonzero(window[suffixes[1:]] == window[suffixes[:-1]])
        left, right = suffixes[pairs], suffixes[pairs + 1]
        a, b, common = left.copy(), right.copy(), np.zeros(len(pairs), dtype=np.int64)
        for k in range(len(self.rounds) - 1, -1, -1):
            same = self.rounds[k][a] == self.rounds[k][b]
            for moved in (a, b, common):
                moved[same] += 1 << k
        np.maximum.at(longest, left, common)
        np.maximum.at(longest, right, common)
        longest[longest < least] = 0
        return longest

    def _neighbour_prefixes(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Neighbours in the suffix array and their common prefix, from ranks and symbols alone.

        Going through the text, the common prefix shrinks by one at most, so all comparisons together are linear.
        """
        suffixes = np.empty(self.size, dtype=np.int64)
        suffixes[self.rank] = np.arange(self.size)
        before = np.full(self.size, -1, dtype=np.int64)
        before[suffixes[1:]] = suffixes[:-1]
        common = np.zeros(self.size, dtype=np.int64)
        symbols, above, out, length = memoryview(self.symbols), memoryview(before), memoryview(common), 0
        for i in range(self.size):
            j = above[i]
            if j < 0:
                length = 0
                continue
            # End marks are symbols of their own, so a comparison ends inside the block.
            while symbols[i + length] == symbols[j + length]:
                length += 1
            out[i] = length
            if length:
                length -= 1
        at = np.flatnonzero(common)
        return before[at], at, common[at]

    def covered(self, start: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        """How many positions of each text lie in spans given by start and length."""
        edges = np.zeros(self.size + 1, dtype=np.int64)
        np.add.at(edges, start, 1)
        np.add.at(edges, start + length, -1)
        inside = np.concatenate([[0], np.cumsum(np.cumsum(edges[:-1]) > 0)])
        return inside[self.first[1:]] - inside[self.first[:-1]]


def figures(texts: list[str | None], min_repeat: int) -> list[tuple]:
    """The values of ``FIGURES`` for each text of a block."""
    split = [t.encode().split() if t else [] for t in texts]
    block = SuffixBlock(split)
    triples = block.covered(block.windows_seen_twice(3), 3)
    longest = block.longest_repeats(min_repeat)
    at = np.flatnonzero(longest)
    covered = block.covered(at, longest[at])
    rows = []
    for i, text in enumerate(texts):
        text = text or ""
        lines = [x for x in text.split("\n") if x.strip(BLANKS)]
        most = longest[block.first[i]:block.first[i + 1]].max()
        rows.append((
            len(split[i]),
            len(text) - sum(text.count(c) for c in BLANKS),
            sum(text.count(c) for c in SYMBOLS),
            len(lines) - len(set(lines)),
            int(triples[i]),
            int(covered[i]),
            int(most),
        ))
    return rows


def _blocks(texts: pd.Series) -> Iterator[list[str | None]]:
    """Runs of texts with about ``BLOCK_WORDS`` words; six characters count as a word."""
    block, size = [], 0
    for text in texts:
        block.append(text)
        size += len(text or "") // 6 + 1
        if size >= BLOCK_WORDS:
            yield block
            block, size = [], 0
    if block:
        yield block


def repetition_figures(docs: DataFrame, *, text_column: str = "text", into: str = "repetition", min_repeat: int = 10) -> DataFrame:
    """Add ``into``, a struct of ``FIGURES``; ``min_repeat`` is the least length of a counted repeat in words."""

    @F.pandas_udf(FIGURES)
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        drop_worker_tables()
        for texts in batches:
            rows = [row for block in _blocks(texts) for row in figures(block, min_repeat)]
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in FIGURES.split(", ")])
        free_memory()

    return docs.withColumn(into, measure(F.col(text_column)))


def judge(
    docs: DataFrame,
    *,
    text_column: str = "text",
    into: str = "repetition",
    min_repeat: int = 10,
    min_words: int = 50,
    max_repeat_percent: int = 50,
    max_covered: float = 0.4,
    max_longest: float = 0.3,
) -> DataFrame:
    """Add ``into``: the figures, ``base_failed`` (too short, or too many repeated triples) and ``kept``."""
    docs = repetition_figures(docs, text_column=text_column, into=into, min_repeat=min_repeat)
    f = lambda name: F.col(f"{into}.{name}")
    failed = (f("n_words") < min_words) | (100 * f("n_repeat_words") > max_repeat_percent * f("n_words"))
    repetitive = (f("covered_words") > max_covered * f("n_words")) | (f("longest_repeat") > max_longest * f("n_words"))
    return docs.withColumn(
        into, F.col(into).withField("base_failed", failed).withField("kept", ~failed & ~repetitive)
    )
