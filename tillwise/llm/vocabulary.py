"""Public vocabularies applied to the words of many texts at once.

A word is encoded once per task as long as the store of known words holds it; the ids of a
text are then gathered by array operations.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Callable, Sequence

import numpy as np

from tillwise.llm.text import Words, release

#: Bytes of known words that a process keeps for a vocabulary, about 40 a word; the words used longest ago go first.
KEPT_BYTES = 96 << 20


def path(name: str) -> str:
    """Place of a public vocabulary file of this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


class _Generation:
    """Words and their ids: sorted runs, each at least twice as long as the next, over one buffer of ids."""

    def __init__(self):
        self.runs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.ids = np.zeros(1 << 12, np.int32)
        self.used = 0

    @property
    def bytes(self) -> int:
        return self.ids.nbytes + sum(a.nbytes for run in self.runs for a in run)

    def add(self, keys: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        """New words; ``keys`` in order."""
        while self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros_like(self.ids)])
        self.ids[self.used : self.used + len(ids)] = ids
        run = keys, self.used + np.cumsum(size) - size, size.astype(np.int32)
        self.used += len(ids)
        while self.runs and len(self.runs[-1][0]) < 2 * len(run[0]):
            both = [np.concatenate(x) for x in zip(self.runs.pop(), run, strict=True)]
            order = np.argsort(both[0], kind="stable")
            run = tuple(x[order] for x in both)
        self.runs.append(run)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the words' ids begin (-1: unknown) and how many they are."""
        at, size = np.full(len(keys), -1), np.zeros(len(keys), np.int64)
        for known, begin, count in self.runs:
            row = np.minimum(np.searchsorted(known, keys), len(known) - 1)
            hit = known[row] == keys
            at[hit], size[hit] = begin[row[hit]], count[row[hit]]
        return at, size


def _gathered(ids: np.ndarray, at: np.ndarray, size: np.ndarray) -> np.ndarray:
    """``ids`` of all ranges in a row."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return ids[np.repeat(at - (ends - size), size) + np.arange(total)]


class WordIds:
    """Token ids of words, remembered by the words' hashes.

    When the young generation has half of the memory, it becomes the old one and the old one is
    forgotten; a word of the old one that is met again moves to the young one.
    """

    def __init__(self, encode: Callable[[list[str]], Sequence[Sequence[int]]], kept_bytes: int = KEPT_BYTES):
        self.encode, self.kept_bytes = encode, kept_bytes
        self.young, self.old = _Generation(), _Generation()

    def __call__(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and the number of ids of each word."""
        unique, first, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
        if not len(unique):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        if self.young.bytes > self.kept_bytes // 2:
            self.old, self.young = self.young, _Generation()
        at, _ = self.young.find(unique)
        missing = np.flatnonzero(at < 0)
        if len(missing) and self.old.runs:
            at, size = self.old.find(unique[missing])
            again = at >= 0
            if again.any():
                self.young.add(unique[missing[again]], size[again], _gathered(self.old.ids, at[again], size[again]))
            missing = missing[~again]
        if len(missing):
            data = words.data.tobytes()
            places = zip(words.start[first[missing]].tolist(), words.end[first[missing]].tolist(), strict=True)
            lists = self.encode([data[a:b].decode("utf-8", "replace") for a, b in places])
            size = np.fromiter(map(len, lists), np.int64, len(lists))
            flat = np.fromiter((i for ids in lists for i in ids), np.int32, int(size.sum()))
            self.young.add(unique[missing], size, flat)
        at, size = self.young.find(unique)
        return _gathered(self.young.ids, at[inverse], size[inverse]), size[inverse]


def forget(but: str | tuple[str, ...] | None = None) -> None:
    """Drop the vocabularies of other stages that a worker has kept; ``but`` names those to go on with."""
    global _last
    if _last != but:
        for cached in (pieces_of, kinds_of, token_ids_of, byte_ids_of):
            cached.cache_clear()
        _last = but
        release()


#: The vocabularies that the worker used last.
_last: str | tuple[str, ...] | None = None


@functools.cache
def pieces_of(file: str) -> tuple[WordIds, int, int]:
    """A sentence piece vocabulary: ids of words with their word mark, and the range of byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=file)
    bytes_ = [i for i in range(model.get_piece_size()) if model.is_byte(i)]
    first, last = (bytes_[0], bytes_[-1]) if bytes_ else (-1, -1)
    return WordIds(lambda words: model.encode(words, num_threads=1)), first, last


#: What a piece holds apart from its word mark.
LETTERS, MARKS, DIGITS, NOTHING = range(4)


@functools.cache
def kinds_of(file: str) -> np.ndarray:
    """The kind of each piece: letters if it has one (bytes count so), else digits, else marks."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=file)

    def kind(i: int) -> int:
        found = {unicodedata.category(c)[0] for c in model.id_to_piece(i).replace("\u2581", "")}
        if model.is_byte(i) or found & {"L", "M"}:
            return LETTERS
        return DIGITS if "N" in found else MARKS if found else NOTHING

    return np.array([kind(i) for i in range(model.get_piece_size())], np.int8)


@functools.cache
def token_ids_of(file: str) -> WordIds:
    """A tokenizer that drops white space, so a text's ids are those of its words one by one."""
    import os

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(file)
    return WordIds(
        lambda words: [e.ids for e in tokenizer.encode_batch_fast(words, add_special_tokens=False)]
    )


@functools.cache
def byte_ids_of(file: str) -> WordIds:
    """A byte-level vocabulary given as ranks: ids of words with the blank before them."""
    import base64

    import public_tokenizers
    import tiktoken

    with open(file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return WordIds(lambda words: [encoding.encode_ordinary(f" {word}") for word in words], KEPT_BYTES // 2)
