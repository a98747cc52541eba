"""Numbers that describe a text's form, for many documents at once."""

import numpy as np

from .repetition import covered, repeated
from .words import LEADS, SOLID, Block, Words, byte_class, span_hash

_CLASSES = {
    "upper": byte_class((0x41, 0x5A)),
    "lower": byte_class((0x61, 0x7A)),
    "digit": byte_class((0x30, 0x39)),
    "stop": byte_class(*((ord(c),) * 2 for c in ".,;:?'")),
    "mark": byte_class(*((ord(c),) * 2 for c in "#*$%&|<>=@^~\\{}[]_")),
    "bang": byte_class((0x21, 0x21)),
    "quote": byte_class(*((ord(c),) * 2 for c in "\"()-/+`")),
    "newline": byte_class((0x0A, 0x0A)),
    "beyond": byte_class((0xC0, 0xFF)),
}

NAMES = (
    "n_words", "n_chars", "word_length", "longest_word", "words_per_line", "line_share",
    "space_share", *(f"{c}_share" for c in _CLASSES), "distinct_share", "repeat_2", "repeat_4", "repeat_8",
    "marked_words", "stopped_words", "upper_words", "digit_words", "short_words", "long_words", "entropy",
)


def features(block: Block) -> np.ndarray:
    """One row per document, one column per name; all zero for a text without words."""
    data, n = block.data, len(block)
    words = Words(block, data, SOLID)
    leads = np.concatenate(([0], np.cumsum(LEADS[data])))
    size = leads[words.ends] - leads[words.starts]
    doc, count = words.doc, words.counts
    least = np.maximum(count, 1)

    def per_word(values) -> np.ndarray:
        return np.bincount(doc, values, n) / least

    chars = np.maximum(np.diff(leads[block.offsets]), 1)
    longest = np.zeros(n)
    np.maximum.at(longest, doc, size)
    starts, ends, of = block.spans(data != 10)
    lines = np.maximum(np.diff(of), 1)
    owner = np.repeat(np.arange(n), np.diff(of))
    key = span_hash(words.sums, starts, ends) ^ (owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    again = np.ones(len(key), bool)
    again[np.unique(key, return_index=True)[1]] = False
    column = {
        "n_words": np.log1p(count),
        "n_chars": np.log1p(np.diff(leads[block.offsets])),
        "word_length": per_word(size),
        "longest_word": np.log1p(longest),
        "words_per_line": np.log1p(count / lines),
        "line_share": np.bincount(owner[again], minlength=n) / lines,
        "space_share": block.count(~SOLID[data]) / chars,
    }
    inside = {}
    for name, kind in _CLASSES.items():
        marked = kind[data]
        column[f"{name}_share"] = block.count(marked) / chars
        sums = np.concatenate(([0], np.cumsum(marked)))
        inside[name] = sums[words.ends] - sums[words.starts]
    again = repeated(np.arange(len(words)), words.hashes, doc)
    column["distinct_share"] = 1 - per_word(again)
    for length in (2, 4, 8):
        first, hashes = words.grams(length)
        column[f"repeat_{length}"] = per_word(covered(first, repeated(first, hashes, doc[first]), length, len(words)))
    column["marked_words"] = per_word(inside["mark"] > 0)
    column["stopped_words"] = per_word(inside["stop"] > 0)
    column["upper_words"] = per_word((inside["upper"] > 0) & (inside["lower"] == 0))
    column["digit_words"] = per_word(inside["digit"] > 0)
    column["short_words"] = per_word(size <= 2)
    column["long_words"] = per_word(size >= 15)
    # entropy of the bytes, in bits
    cells = np.bincount(np.repeat(np.arange(n), np.diff(block.offsets)) * 256 + data, minlength=256 * n).reshape(n, 256)
    share = cells / np.maximum(cells.sum(axis=1, keepdims=True), 1)
    column["entropy"] = -(share * np.log2(np.where(share > 0, share, 1))).sum(axis=1)
    out = np.stack([column[name] for name in NAMES], 1).astype(float)
    out[count == 0] = 0
    return out
