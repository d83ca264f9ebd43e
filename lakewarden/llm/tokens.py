"""Token ids of whole texts inside tasks, with a bounded cache of words.

Where a tokenizer's own splitting never joins characters over a blank or a line feed, a text's ids
are those of its blank-separated words in turn; each word is encoded once while it is cached, and
a word with punctuation behind it as the word and the punctuation. What a tokenizer allows is found by
trying it out: others than that get whole texts.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words and their characters that are cached before those not met again go.
CACHED_WORDS, CACHED_CHARS = 300_000, 1 << 22
ENCODED_WORDS = 1 << 13
SLICE_CHARS = 1 << 20
MARK = "\x01"
JOINED_WORDS = 64
HELD_WORDS = 20_000
HELD_CHARS = 1 << 21
TAIL = ".,!?;:"
LETTERS = frozenset("abcdefghijklmnopqrstuvwxyz")
#: Texts that a splitting by words must leave as they are.
PROBES = ("The quick-brown fox", "AB cd\nEf  GH 12 3.4", " lead", "trail ", "a\n\nb", "don't we'll 's", "é ß Ä\u0301 日本 x", "#a $b %% (c) [d]", "\t tab\tin", "x <y> z")


class _Index(dict):
    """Number of each word in order of arrival; new words are noted."""

    def __init__(self):
        super().__init__()
        self.fresh: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = at = len(self)
        self.fresh.append(word)
        return at


def _lower(text: str) -> str:
    """A-Z in lower case, other letters as they are."""
    return text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._clear()
        plain = lambda texts: [e.ids for e in self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)]
        whole = plain(PROBES)
        by_word = lambda text: [i for ids in plain(text.replace("\n", " ").split(" ")) for i in ids]
        #: Ids of a text are those of its words; A-Z may be lower-cased first; punctuation may be split off behind a letter.
        self.words_apart = all(by_word(t) == ids for t, ids in zip(PROBES, whole, strict=True))
        self.lowers = plain(_lower(t) for t in PROBES) == whole
        self.tails_apart = self.words_apart and all(plain([w + t])[0] == plain([w])[0] + plain([t])[0] for w in ("word", "éa", "l", "it's", "12x", "#a") for t in (*TAIL, ",.", "...", "?!:"))

    def _clear(self) -> None:
        self.index = _Index()
        self.starts = np.zeros(1 << 12, np.int64)
        self.sizes = np.zeros(1 << 12, np.int64)
        self.again = np.zeros(1 << 12, np.bool_)
        self.ids = np.zeros(1 << 14, np.uint32)
        self.known = self.used = self.chars = 0

    def _trim(self) -> None:
        """Where the cache is full, words not met again since they were learned, or since the last time, go; where that leaves too many, all."""
        if len(self.index) <= CACHED_WORDS and self.chars <= CACHED_CHARS:
            return
        kept = np.flatnonzero(self.again[:self.known])
        words = [w for w, again in zip(self.index, self.again[:self.known].tolist(), strict=True) if again]
        ids, sizes = self._gathered(kept)[0], self.sizes[kept]
        self._clear()
        chars = sum(map(len, words))
        if 2 * len(words) <= CACHED_WORDS and 2 * chars <= CACHED_CHARS:
            self.index.update(zip(words, range(len(words)), strict=True))
            self._grow(len(words))
            self._store(np.arange(len(words)), ids, sizes)
            self.known, self.chars = len(words), chars

    @staticmethod
    def _room(array: np.ndarray, need: int) -> np.ndarray:
        return array if need <= len(array) else np.concatenate([array, np.zeros(max(need - len(array), len(array)), array.dtype)])

    def _grow(self, total: int) -> None:
        self.starts, self.sizes, self.again = (self._room(a, total) for a in (self.starts, self.sizes, self.again))

    def _encoded(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in turn and how many each has, some words at a time: a tokenizer's own results are many times as large as the ids."""
        if not words:
            return np.zeros(0, np.uint32), np.zeros(0, np.int64)
        ids, sizes = zip(*(self._encoded_part(words[k:k + ENCODED_WORDS]) for k in range(0, len(words), ENCODED_WORDS)), strict=True)
        return np.concatenate(ids), np.concatenate(sizes)

    def _encoded_part(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Many words are encoded as one text, with a mark between them."""
        encode = lambda texts: [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        mark = encode([MARK])[0]
        if len(mark) == 1 and not any(MARK in w for w in words):
            joined = [f" {MARK} ".join([*words[k:k + JOINED_WORDS], ""]) for k in range(0, len(words), JOINED_WORDS)]
            ids = np.concatenate([np.array(found, np.uint32) for found in encode(joined)])
            ends = np.flatnonzero(ids == mark[0])
            if len(ends) == len(words):  # else other words have the mark's id too
                return np.delete(ids, ends), np.diff(ends, prepend=-1) - 1
        found = encode(words)
        return np.fromiter((i for ids in found for i in ids), np.uint32), np.fromiter(map(len, found), np.int64, len(found))

    def _parts(self, word: str) -> tuple[str, str] | None:
        """A word that ends in a-z and the punctuation behind it, if there is any."""
        if not self.tails_apart or word[-1:] not in TAIL or not word:
            return None
        stem = word.rstrip(TAIL)
        return (stem, word[len(stem):]) if stem[-1:] in LETTERS and stem else None

    def _learn(self) -> None:
        fresh, self.index.fresh = self.index.fresh, []
        parts = [self._parts(w) for w in fresh]
        pairs = [(self.index[p[0]], self.index[p[1]]) for p in parts if p]
        more, self.index.fresh = self.index.fresh, []
        plain = [k for k, p in enumerate(parts) if not p] + list(range(len(fresh), len(fresh) + len(more)))
        words = fresh + more
        total = self.known + len(words)
        self._grow(total)
        self.chars += sum(map(len, words))
        ids, sizes = self._encoded([words[k] for k in plain])
        self._store(np.array(plain, np.int64) + self.known, ids, sizes)
        if pairs:
            stem, tail = np.array(pairs, np.int64).T
            self.again[np.concatenate([x[x < self.known] for x in (stem, tail)])] = True
            self._store(np.flatnonzero([p is not None for p in parts]) + self.known, *self._joined(stem, tail))
        self.known = total

    def _joined(self, stem: np.ndarray, tail: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of known stems with their tails, one after the other, and how many each pair has."""
        both = np.stack([stem, tail], 1).ravel()
        return self._gathered(both)[0], self.sizes[stem] + self.sizes[tail]

    def _store(self, at: np.ndarray, ids: np.ndarray, sizes: np.ndarray) -> None:
        self.ids = self._room(self.ids, self.used + len(ids))
        self.sizes[at] = sizes
        self.starts[at] = self.used + np.cumsum(sizes) - sizes
        self.ids[self.used:self.used + len(ids)] = ids
        self.used += len(ids)

    def _gathered(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of known words in turn, and where each word's end."""
        sizes = self.sizes[at]
        ends = np.cumsum(sizes)
        last = int(ends[-1]) if len(ends) else 0
        places = np.repeat(self.starts[at] - (ends - sizes), sizes)
        places += np.arange(last)
        return self.ids[places], ends

    def _words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the words in turn, and where each word's end."""
        self._trim()
        return self._gathered(self._numbers(words))

    def _numbers(self, words: list[str]) -> np.ndarray:
        at = np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
        self.again[at[at < self.known]] = True
        if self.index.fresh:
            self._learn()
        return at

    def _split(self, text: str) -> list[str]:
        """Words between blanks and line feeds, A-Z in lower case if the tokenizer does that too.

        A text with what may be a special token keeps its case, as those are told by it.
        """
        if self.lowers and "<|" not in text:
            text = _lower(text)
        return text.replace("\n", " ").split(" ")

    def encode_column(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each whole text of an Arrow column; none for a null or empty one.

        Words are split and told apart column by column; only distinct ones are looked up.
        """
        column = pc.fill_null(column.cast(pa.large_string()), "")
        ends = np.cumsum(pc.binary_length(column).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(column):
            to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + HELD_CHARS, "right")))
            part = column.slice(at, to - at)
            # special tokens, long texts and other tokenizers go text by text
            if not self.words_apart or ends[to - 1] - (ends[at - 1] if at else 0) > HELD_CHARS or pc.any(pc.match_substring(part, "<|")).as_py():
                yield from self.encode_many(x.as_py() for x in part)
            else:
                self._trim()
                lists = pc.split_pattern(pc.replace_substring(pc.ascii_lower(part) if self.lowers else part, "\n", " "), " ")
                words = lists.flatten().dictionary_encode()
                numbers = self._numbers(words.dictionary.to_pylist())[words.indices.to_numpy()]
                ids, word_ends = self._gathered(numbers)
                cuts = word_ends[np.cumsum(lists.value_lengths().to_numpy()) - 1]
                yield from np.split(ids, cuts[:-1])
            at = to

    def encode_many(self, texts: Iterable[str | None]) -> Iterator[np.ndarray]:
        """The ids of each whole text; none for a null or empty one. Short texts are looked up together."""
        words: list[str] = []
        counts: list[int] = []
        if not self.words_apart:
            for text in texts:
                yield np.array(self.tokenizer.encode(text or "", add_special_tokens=False).ids, np.uint32)
            return
        for text in texts:
            text = text or ""
            if len(text) > SLICE_CHARS:
                yield from self._flush(words, counts)
                words, counts = [], []
                yield self._long(text)
                continue
            mine = self._split(text)
            words += mine
            counts.append(len(mine))
            if len(words) > HELD_WORDS:
                yield from self._flush(words, counts)
                words, counts = [], []
        yield from self._flush(words, counts)

    def _flush(self, words: list[str], counts: list[int]) -> Iterator[np.ndarray]:
        if counts:
            ids, ends = self._words(words)
            cuts = ends[np.cumsum(counts) - 1]
            yield from np.split(ids, cuts[:-1])

    def _long(self, text: str) -> np.ndarray:
        parts, at = [], 0
        while len(text) - at > SLICE_CHARS:
            cuts = [c for c in (text.find(" ", at + SLICE_CHARS), text.find("\n", at + SLICE_CHARS)) if c >= 0]
            if not cuts:
                break
            parts.append(self._words(self._split(text[at:min(cuts)]))[0])
            at = min(cuts) + 1
        parts.append(self._words(self._split(text[at:]))[0])
        return np.concatenate(parts)

    def encode(self, text: str | None) -> np.ndarray:
        return next(iter(self.encode_many([text])))


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder per worker process and vocabulary, kept from task to task."""
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def texts_of(batch, column: str) -> Iterator[str | None]:
    """Texts of an Arrow batch one at a time, so that only one is a Python string at once."""
    for value in batch.column(column):
        yield value.as_py()


def word_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
