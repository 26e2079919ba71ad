"""Quality rules by tokeniser fertility.

Two public vocabularies read every word of a text: pieces with byte fallback, and byte-level
tokens of many languages. Fluent text of a script they know gives several characters per
token, few fallback bytes, many different tokens, some of them whole words, and does not need many
tokens a word that carry few letters each. Noise, wrong encodings, symbol junk and endless
repeats do. Each script has its bands; shares of mark and digit tokens complete them.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tillwise.llm import vocabulary
from tillwise.llm.text import SPACED, Words, byte_set, covered, mix, pieces, texts_of, window_hash

WINDOW = 5
#: The public vocabularies that read the words.
FIRST, SECOND = "piece_bpe_32k.model", "byte_bpe_multi_50k.tiktoken"
SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
NO_BREAK = ~byte_set((0x0A, 0x0A))

#: First bytes of the letters of each script in UTF-8 (a coarse cut along blocks).
SCRIPTS: dict[str, np.ndarray] = {
    "latin": byte_set((0x41, 0x5A), (0x61, 0x7A), (0xC3, 0xC9)),
    "greek": byte_set((0xCE, 0xCF)),
    "cyrillic": byte_set((0xD0, 0xD3)),
    "semitic": byte_set((0xD7, 0xDB)),
    "indic": byte_set((0xE0, 0xE0)),
    "east_asian": byte_set((0xE3, 0xED)),
}
OTHER = "other"
#: First bytes of letters; punctuation, signs and emoji begin with others (a coarse cut as well).
LETTERS = byte_set((0x41, 0x5A), (0x61, 0x7A), (0xC3, 0xE1), (0xE3, 0xEF))


@dataclass(frozen=True)
class Band:
    """What a kept text has: characters per token, share of fallback bytes, entropy in bits.

    ``most_marks`` and ``most_digits`` bound the tokens without a letter, as shares of the
    tokens that are more than a word mark; ``FEW_MARKS`` marks are free, so that a short text
    may end its lines. ``least_whole`` is a share of the words: those that are one token.
    Fertility rejects a text whose words with a letter take more than ``most_per_word`` tokens that
    carry fewer than ``least_letters`` letters each, both as means over the vocabularies: long words
    take many tokens as well, but full ones, and many short tokens are common where words are short.
    The least entropy and share of whole words and the fertility hold from ``entropy_tokens`` tokens on, since a
    short text can't have much.
    """

    least_chars: float
    most_chars: float
    most_bytes: float
    least_entropy: float
    entropy_tokens: int = 100
    most_marks: float = 0.19
    most_digits: float = 0.8
    least_whole: float = 0.0
    most_per_word: float = np.inf
    least_letters: float = 0.0


FEW_MARKS = 3

#: Each bound lies about halfway between prose and noise where the two differ. Marks: the
#: labelled rows of sf0.01 (clean up to 0.153, symbol junk from 0.221); in the other scripts,
#: which spell out more, a passage of prose and the same with a bar behind every word.
#: Digits: labelled clean rows of sf0.1 (up to 0.52) and digit noise (1.0). Whole words: those
#: clean rows from 0.083, prose in six more Latin languages from 0.11, random letters up to
#: 0.02. Characters and bytes: a passage of prose and 300 random words of each script. Where
#: prose of some language reads like noise (see README) a bound leaves both in.
BANDS: dict[str, Band] = {
    "latin": Band(1.0, 8.0, 0.2, 5.3, 120, least_whole=0.04, most_per_word=3.1, least_letters=1.45),
    "greek": Band(0.7, 8.0, 0.2, 4.0, most_marks=0.09, most_per_word=6.0, least_letters=0.95),
    "cyrillic": Band(1.3, 8.0, 0.2, 4.5, most_marks=0.15, most_per_word=3.5, least_letters=1.3),
    "semitic": Band(0.6, 8.0, 0.2, 3.8, most_marks=0.11, most_per_word=5.5, least_letters=0.8),
    "indic": Band(0.25, 8.0, 0.9, 3.5, most_marks=0.1),
    "east_asian": Band(0.45, 4.0, 0.6, 3.5, most_marks=0.16, most_per_word=4.0, least_letters=0.45),
    OTHER: Band(0.2, 12.0, 1.0, 3.5, most_marks=0.09),
}

_SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long,"
    " base_failed boolean, kept boolean, script string, n_tokens long, chars_per_token double,"
    " byte_share double, token_entropy double, tokens_per_word double, letters_per_token double, reasons string"
)
_NAMES = [part.split()[0] for part in _SCHEMA.split(", ")]


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of the flags between the bounds."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return np.diff(sums[bounds])


def repeated(keys: np.ndarray) -> np.ndarray:
    """True for keys that occur twice or more."""
    order = np.argsort(keys)
    ordered = keys[order]
    same = ordered[1:] == ordered[:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _of_text(hashes: np.ndarray, text: np.ndarray) -> np.ndarray:
    """Keys that are equal for equal hashes of one text."""
    with np.errstate(over="ignore"):
        return mix(hashes + mix(text.astype(np.uint64) + np.uint64(1)))


def base_counts(data: np.ndarray, offsets: np.ndarray, words: Words) -> dict[str, np.ndarray]:
    texts = len(offsets) - 1
    inside = SPACED[data]
    whole = words.windows(WINDOW)
    keys = _of_text(window_hash(words.hash, WINDOW), words.text)
    twice = np.zeros(len(words), bool)
    at = np.flatnonzero(whole)
    twice[at[repeated(keys[at])]] = True
    lines = Words(data, offsets, NO_BREAK)
    sums = np.concatenate([[0], np.cumsum(inside)])
    full = np.flatnonzero(sums[lines.end] > sums[lines.start])
    line_text = lines.text[full]
    line_keys = np.unique(_of_text(lines.hash[full], line_text), return_index=True)[1]
    return {
        "n_words": words.counts,
        "word_chars": _per_text(inside & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": _per_text(SYMBOLS[data], offsets),
        "n_dup_lines": np.bincount(line_text, minlength=texts)
        - np.bincount(line_text[line_keys], minlength=texts),
        "n_repeat_words": _per_text(covered(twice, WINDOW), words.first),
    }


def token_measures(words: Words, file: str, second: str) -> dict[str, np.ndarray]:
    """Tokens, share of fallback bytes, entropy in bits, tokens by kind and whole words of each text.

    ``tokens_per_word`` and ``letters_per_token`` are means over both vocabularies; 0 without words that have a letter.
    """
    ids_of, first_byte, last_byte = vocabulary.pieces_of(file)
    _, other_size = vocabulary.byte_ids_of(second)(words)
    ids, size = ids_of(words)
    sums = np.concatenate([[0], np.cumsum(size)])
    bounds = sums[words.first]
    tokens = np.diff(bounds)
    text = np.repeat(np.arange(len(tokens)), tokens)
    keys = np.sort((text << 32) | ids)
    edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    count = np.diff(np.append(edges, len(keys)))
    spread = np.bincount(keys[edges] >> 32, count * np.log2(count), minlength=len(tokens))
    some = np.maximum(tokens, 1)
    others = _per_text(other_size, words.first)
    letter = np.concatenate([[0], np.cumsum(LETTERS[words.data])])
    lettered = np.maximum(_per_text(letter[words.end] > letter[words.start], words.first), 1)
    letters = np.diff(letter[words.offsets])
    kind = vocabulary.kinds_of(file)[ids]
    return {
        "n_tokens": tokens,
        "filled": tokens - _per_text(kind == vocabulary.NOTHING, bounds),
        "marks": _per_text(kind == vocabulary.MARKS, bounds),
        "digits": _per_text(kind == vocabulary.DIGITS, bounds),
        "whole": _per_text(size == 1, words.first),
        "byte_share": _per_text((ids >= first_byte) & (ids <= last_byte), bounds) / some,
        "token_entropy": np.where(tokens > 0, np.maximum(np.log2(some) - spread / some, 0.0), 0.0),
        "tokens_per_word": np.where(letters > 0, (tokens + others) / (2 * lettered), 0.0),
        "letters_per_token": (letters / some + letters / np.maximum(others, 1)) / 2,
    }


def scripts_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """The script with the most letters in each text; the first named wins a tie."""
    counts = np.stack([_per_text(flags[data], offsets) for flags in SCRIPTS.values()])
    names = np.array([*SCRIPTS, OTHER])
    return names[np.where(counts.max(axis=0) > 0, counts.argmax(axis=0), len(SCRIPTS))]


def broken(out: Mapping[str, np.ndarray], band: Band) -> dict[str, np.ndarray]:
    """Which texts break which measure of a band."""
    tokens, long = out["n_tokens"], out["n_tokens"] >= band.entropy_tokens
    chars = out["chars_per_token"]
    return {
        "chars": (chars < band.least_chars) | (chars > band.most_chars),
        "bytes": out["byte_share"] > band.most_bytes,
        "entropy": (out["token_entropy"] < band.least_entropy) & long,
        "fertility": (out["tokens_per_word"] > band.most_per_word) & (out["letters_per_token"] < band.least_letters) & long,
        "whole": (out["whole"] < band.least_whole * out["n_words"]) & long,
        "marks": out["marks"] > band.most_marks * out["filled"] + FEW_MARKS,
        "digits": (out["digits"] > band.most_digits * out["filled"]) & (tokens > 0),
    }


def judge(texts: pa.Array, file: str, bands: Mapping[str, Band], second: str | None = None) -> dict[str, np.ndarray]:
    """All columns but ``doc_id`` for some texts, and counts that the bands need."""
    data, offsets = texts_of(texts)
    words = Words(data, offsets, SPACED)
    out = base_counts(data, offsets, words)
    n, repeats = out["n_words"], out["n_repeat_words"]
    out["base_failed"] = (n < 10) | (100 * repeats > 20 * n)
    out |= token_measures(words, file, second or vocabulary.path(SECOND))
    script = out["script"] = scripts_of(data, offsets)
    out["chars_per_token"] = out["word_chars"] / np.maximum(out["n_tokens"], 1)
    reasons = np.where(out["base_failed"], "base", "").astype(object)
    for name, band in bands.items():
        for measure, breaks in broken(out, band).items():
            breaks = breaks & (script == name)
            reasons[breaks] = [f"{r},{measure}" if r else measure for r in reasons[breaks]]
    out["reasons"] = reasons
    out["kept"] = reasons == ""
    return out


def _vocabularies(file: str | None, second: str | None) -> tuple[str, str]:
    return file or vocabulary.path(FIRST), second or vocabulary.path(SECOND)


def quality(
    docs: DataFrame, file: str | None = None, bands: Mapping[str, Band] | None = None, second: str | None = None
) -> DataFrame:
    """Return counts, token measures and the verdict ``kept`` for every document.

    Tokens are the vocabulary's pieces of each word with its word mark; line breaks and
    spaces are no tokens. ``n_tokens``, characters per token, byte share and entropy are of the first
    vocabulary; ``reasons`` names what rejects a document (``base`` and the measures of its
    script's band), comma-joined, and is empty for kept ones. Null and empty texts have no words, no tokens and fail the base
    rules (fewer than 10 words). Repeated rows are judged alike and kept; no rows give no
    rows; other columns are not read. One pass, no shuffle.
    """
    files, bands = _vocabularies(file, second), dict(bands or BANDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary.forget(but=files)
        for batch in batches:
            for piece in pieces(batch):
                out = judge(piece.column("text"), files[0], bands, files[1])
                columns = [piece.column("doc_id").cast(pa.int64())]
                columns += [pa.array(out[name]) for name in _NAMES[1:]]
                yield pa.RecordBatch.from_arrays(columns, names=_NAMES)

    return docs.select("doc_id", "text").mapInArrow(run, _SCHEMA)


def keep_good(docs: DataFrame, **options) -> DataFrame:
    """The documents that :func:`quality` keeps, with all their columns as they are.

    The verdict is made on the rows themselves, so ids may be null or repeat.
    """
    files = _vocabularies(options.get("file"), options.get("second"))
    bands = dict(options.get("bands") or BANDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary.forget(but=files)
        for batch in batches:
            for piece in pieces(batch):
                yield piece.filter(pa.array(judge(piece.column("text"), files[0], bands, files[1])["kept"]))

    return docs.mapInArrow(run, docs.schema)


# ----------------------------------------------------------------------- query


def query(spark, folder: str) -> DataFrame:
    return quality(spark.read.parquet(f"{folder}/documents.parquet"))
