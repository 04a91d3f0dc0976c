"""Token ids of whole texts with a tokenizer that drops blanks, looked up word by word.

With such a tokenizer (here ``word_bpe_49k.json``) no token crosses an ASCII blank, so a
text's ids are its words' ids one after the other, and each worker encodes a word once
and looks it up from then on.  The split between a run of letters and punctuation behind
it is a token boundary too, which lets ``word``, ``word,`` and ``Word.`` share one entry:
Arrow cuts and lower-cases all distinct words of a batch at once, before the lookup.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from string import ascii_letters

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from .shared import worker_table

MARKS = ".,!?;:"


class WordEncoder:
    """Texts to little-endian token ids.

    A worker keeps two tables: ``words`` has Latin words without punctuation and all other words whole,
    ``cores`` the parts of these others.  ``most_words`` and ``most_cores`` bound them, at about 200 bytes each;
    what is beyond is encoded again whenever it occurs, which changes the time and not the ids.
    """

    def __init__(
        self, path: str, as_text: bool, width: str = "<u4", most_words: int = 500_000, most_cores: int = 300_000
    ):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = as_text
        self.by_bytes = _model_alone_agrees(self.tokenizer)
        self.letters = LATIN if self.by_bytes else ascii_letters
        self.width, self.most_words, self.most_cores = np.dtype(width), most_words, most_cores
        self.words: dict[str, bytes] = {}
        self.cores: dict[str, bytes] = {}

    def _encode(self, cores: list[str]) -> dict[str, bytes]:
        """The ids of each part.  Plain words of letters go to the model itself, which saves the steps before it."""
        plain = [self.by_bytes and t.isalpha() and (t.isascii() or (max(t) < PLAIN_END and DOTTED not in t)) for t in cores]
        # One by one: encode_batch starts a thread per core of the machine, and each keeps a heap of its own.
        encode, tokenize = self.tokenizer.encode, self.tokenizer.model.tokenize
        ids = [
            [x.id for x in tokenize(_byte_letters(t))] if p else encode(t, add_special_tokens=False).ids
            for t, p in zip(cores, plain)
        ]
        return {c: np.array(i, dtype=self.width).tobytes() for c, i in zip(cores, ids)}

    def _new_words(self, new: list[str]) -> dict[str, bytes]:
        parts = [_split(w) for w in new]
        known = self.cores
        missing = {p for pair in parts for p in pair if p not in known}
        found = self._encode(list(missing)) if missing else {}
        get = lambda p: known[p] if p in known else found[p]
        result = {w: get(a) + get(b) for w, (a, b) in zip(new, parts)}
        if len(known) < self.most_cores:
            known.update(found)
        return result

    def _bare(self, words: pa.Array) -> tuple[pa.Array, pa.Array]:
        """Words of Latin letters in lower case without the punctuation behind them, others whole; and that punctuation."""
        rest = pc.utf8_ltrim(words, self.letters)
        latin = pc.and_(pc.equal(pc.utf8_ltrim(rest, MARKS), ""), pc.less(pc.binary_length(rest), pc.binary_length(words)))
        return pc.if_else(latin, pc.utf8_lower(pc.utf8_rtrim(words, MARKS)), words), pc.if_else(latin, rest, "")

    def _looked_up(self, entries: pa.Array) -> list[bytes]:
        """The ids of distinct words as ``_bare`` leaves them; new ones are encoded and kept while there is room."""
        names = entries.to_numpy(zero_copy_only=False).tolist()
        each = list(map(self.words.get, names))
        if None in each:
            new = [n for n, e in zip(names, each) if e is None]
            latin = pc.equal(pc.utf8_ltrim(pa.array(new, pa.large_string()), self.letters), "").to_pylist()
            extra = self._encode([n for n, p in zip(new, latin) if p]) | self._new_words([n for n, p in zip(new, latin) if not p])
            each = [extra[n] if e is None else e for n, e in zip(names, each)]
            if len(self.words) < self.most_words:
                self.words.update(extra)
        return each

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the texts one after the other, and how many each text has; NULL has none.

        Each distinct word is looked up once per call; the rest is copying by position.
        """
        split = pc.ascii_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
        coded = split.flatten().dictionary_encode()
        bare, marks = (x.dictionary_encode() for x in self._bare(coded.dictionary))
        each = [*self._looked_up(bare.dictionary), *self._looked_up(marks.dictionary)]
        pool = np.frombuffer(b"".join(each), dtype=self.width)
        size = np.fromiter(map(len, each), dtype=np.int64, count=len(each)) // self.width.itemsize
        parts = np.stack([_codes(bare), _codes(marks) + len(bare.dictionary)], axis=1).ravel()
        pool, size = _copied(pool, size, parts), size[parts].reshape(-1, 2).sum(axis=1)
        code = _codes(coded)
        ends = np.concatenate([[0], np.cumsum(size[code])])
        edges = split.offsets.to_numpy()
        return _copied(pool, size, code), np.diff(ends[edges - edges[0]])

    def closed_ids(self, texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """The same with ``end_id`` behind each text, counted."""
        ids, counts = self.ids(texts)
        ends = np.cumsum(counts + 1)
        out = np.full(int(ends[-1]) if len(ends) else 0, end_id, dtype=self.width)
        inside = np.ones(len(out), dtype=bool)
        inside[ends - 1] = False
        out[inside] = ids
        return out, counts + 1


def _codes(coded: pa.DictionaryArray) -> np.ndarray:
    return coded.indices.to_numpy(zero_copy_only=False)


def _copied(pool: np.ndarray, size: np.ndarray, code: np.ndarray) -> np.ndarray:
    """``pool`` is runs of so many items, one after the other; the runs of the given numbers."""
    counts, firsts = size[code], (np.cumsum(size) - size)[code]
    ends = np.cumsum(counts)
    return pool[np.arange(counts.sum()) + np.repeat(firsts - ends + counts, counts)]


def _split(word: str) -> tuple[str, str]:
    """Letters and the punctuation behind them; a word of another shape stays whole."""
    core = word.rstrip(MARKS)
    if core.isalpha() and (core.isascii() or core.lower().isalpha()):
        return core.lower() if core.isascii() else core, word[len(core):]
    return word, ""


# A byte of a token is written as a printable character: itself where it is one, else a character from U+0100 on.
_PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_OTHERS = [b for b in range(256) if b not in _PRINTABLE]
_LETTERS = str.maketrans({chr(b): chr(0x100 + n) for n, b in enumerate(_OTHERS)})
# Latin letters, whose lower case does not depend on the letters around them.
PLAIN_END, DOTTED = "\u0250", "\u0130"
# Those of them that are composed and single in lower case too.
LATIN = ascii_letters + "".join(c for c in map(chr, range(0xC0, ord(PLAIN_END))) if c.isalpha() and c != DOTTED and c.lower() < PLAIN_END)


def _byte_letters(word: str) -> str:
    """A word of letters as the model reads it: composed, in lower case, one character per UTF-8 byte."""
    if word.isascii():
        return word.lower()
    return unicodedata.normalize("NFC", word).lower().encode().decode("latin-1").translate(_LETTERS)


def _model_alone_agrees(tokenizer: Tokenizer) -> bool:
    """Whether this tokenizer composes, lower-cases and reads bytes as assumed, tried on a few words."""
    tried = ["House", "straße", "ÉTÉ", "niño", "aaaaaaaaaaaa", "Żółw"]
    return all([x.id for x in tokenizer.model.tokenize(_byte_letters(w))] == tokenizer.encode(w, add_special_tokens=False).ids for w in tried)


def slices(texts: pa.Array, characters: int = 2 << 20) -> Iterator[pa.Array]:
    """Runs of texts with about so many bytes, so that a task holds few ids at a time."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = np.flatnonzero(np.diff(np.cumsum(sizes) // characters)) + 1
    for first, last in zip([0, *cuts], [*cuts, len(texts)]):
        if last > first:
            yield texts.slice(first, last - first)


def encoder(path: str, as_text: bool, width: str = "<u4", **bounds: int) -> WordEncoder:
    """This worker's encoder, with ``bounds`` of its tables if given; these outlive the task."""
    return worker_table((path, as_text, width, *sorted(bounds.items())), lambda: WordEncoder(path, as_text, width, **bounds))
