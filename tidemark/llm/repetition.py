"""Quality rules on repetition: characters inside duplicated n-grams and lines.

Rolling hashes of the word sequence give every n-word window of a text for
several n. The characters of the words that lie in a window found twice or
more, the first included, are the window length's coverage. Lines are compared
whole. A text is kept if no coverage passes its limit and the basic rules hold.

Defined results: a null or empty text has no words, fails the rule on the
least number of words, and is not kept. A null id is kept as null. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .words import LEADS, SOLID, Block, Words, byte_class, byte_prefix, map_blocks, span_hash

SYMBOLS = byte_class(*((ord(c), ord(c)) for c in "#*$%&|<>"))
#: Largest share of word characters, in percent, that repeated windows of n words may cover. Windows of
#: two or three words repeat in any long text, so they are no sign.
LIMITS = {4: 50, 8: 30, 16: 30}
#: Largest share of word characters in lines equal to an earlier one, and of symbols, in percent.
LINE_LIMIT, SYMBOL_LIMIT = 30, 10
LEAST_WORDS, REPEATED_WORDS = 20, 30


def repeated(first: np.ndarray, hashes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Marks values whose hash occurs again in the same document."""
    key = hashes ^ (doc.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    ranked = key[order]
    same = np.zeros(len(key) + 1, bool)
    same[1:-1] = ranked[1:] == ranked[:-1]
    out = np.zeros(len(key), bool)
    out[order] = same[1:] | same[:-1]
    return out


def covered(first: np.ndarray, hit: np.ndarray, n: int, total: int) -> np.ndarray:
    """Marks positions inside a marked window of n."""
    steps = np.zeros(total + 1, np.int64)
    np.add.at(steps, first[hit], 1)
    np.add.at(steps, first[hit] + n, -1)
    return np.cumsum(steps)[:total] > 0


def measures(block: Block, lengths=tuple(LIMITS)) -> dict[str, np.ndarray]:
    """Counts per document of a block; ``chars_n`` are characters in repeated n-word windows."""
    data = block.data
    words = Words(block, data, SOLID)
    leads = np.concatenate(([0], np.cumsum(LEADS[data])))
    size = leads[words.ends] - leads[words.starts]
    doc = words.doc
    n = len(block)

    def per_doc(weights):
        return np.bincount(doc, weights, n).astype(np.int64)

    out = {
        "n_words": words.counts,
        "word_chars": per_doc(size),
        "n_symbols": block.count(SYMBOLS[data]),
    }
    # lines: whole, white space included, if they hold a word
    starts, ends, of = block.spans(data != 10)
    owner = np.repeat(np.arange(n), np.diff(of))
    first_word = np.searchsorted(words.starts, starts)
    last_word = np.searchsorted(words.starts, ends)
    real = last_word > first_word
    starts, ends, owner = starts[real], ends[real], owner[real]
    key = span_hash(words.sums, starts, ends) ^ (owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    earlier = np.ones(len(key), bool)
    earlier[np.unique(key, return_index=True)[1]] = False
    out["n_dup_lines"] = np.bincount(owner[earlier], minlength=n)
    chars = np.concatenate(([0], np.cumsum(size)))
    line_chars = chars[last_word[real]] - chars[first_word[real]]
    out["line_chars"] = np.bincount(owner[earlier], line_chars[earlier], n).astype(np.int64)
    for length in lengths:
        first, hashes = words.grams(length)
        mark = covered(first, repeated(first, hashes, doc[first]), length, len(words))
        out[f"chars_{length}"] = per_doc(size * mark)
        if length == 8:
            out["n_repeat_words"] = per_doc(mark)
    return out


def repetition_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: the measures, ``base_failed`` and ``kept``."""

    def make():
        def work(block: Block) -> dict:
            m = measures(block)
            failed = (m["n_words"] < LEAST_WORDS) | (100 * m["n_repeat_words"] > REPEATED_WORDS * m["n_words"])
            bad = failed | (100 * m["line_chars"] > LINE_LIMIT * m["word_chars"])
            bad |= 100 * m["n_symbols"] > SYMBOL_LIMIT * m["word_chars"]
            for n, limit in LIMITS.items():
                bad |= 100 * m[f"chars_{n}"] > limit * m["word_chars"]
            names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
            out = {k: pa.array(m[k], pa.int64()) for k in names}
            out |= {"base_failed": pa.array(failed), "kept": pa.array(~bad)}
            return out | {k: pa.array(m[k], pa.int64()) for k in ["line_chars", *(f"chars_{n}" for n in LIMITS)]}

        return work

    extra = "".join(f", {k} long" for k in ["line_chars", *(f"chars_{n}" for n in LIMITS)])
    return map_blocks(
        docs,
        "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        f"base_failed boolean, kept boolean{extra}",
        make, id_col, text_col,
    )
