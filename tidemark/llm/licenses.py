"""Licence scan by a positional index of rare words.

The index holds, for every licence template, the places of its words. The words
of all documents decide how rare a template's words are. A file that holds all words
of a template's key phrases is looked up by the rarest of them: the places they
imply for the template's first word are intersected. A place on which all entries
agree is verified: every mandatory key phrase stands at its place, word for word.
Each verified place is labelled; the share of the other words that stand there
too, rare ones counting more, is its score.

Defined results: null and empty texts have no words, no place and score 0. A
null id is kept. Equal texts get equal results. An empty table gives none. Texts
of any length are read whole, one at a time beyond a block's size. Other columns,
whatever their names and types, are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import ALNUM, LOWER, Block, Words, byte_prefix, map_blocks, map_rows, span_hash


@dataclass(frozen=True)
class Template:
    """A licence text in lower-case words. Without key phrases all its words are mandatory."""

    label: str
    text: str
    keys: tuple[str, ...] = ()
    base: bool = False


# Phrases of the scan's contract, then words of public licence notices.
TEMPLATES = (
    Template("cc-by", "cc by", base=True),
    Template("gpl", "general public license", base=True),
    Template("reserved", "all rights reserved", base=True),
    Template("apache", "licensed under the apache license version 2 0", ("apache license",)),
    Template("bsd", "redistribution and use in source and binary forms with or without modification "
             "are permitted provided that the following conditions are met",
             ("redistribution and use in source and binary forms",)),
    Template("cc-by-nc", "cc by nc"),
    Template("cc-by-nd", "cc by nd"),
    Template("cc-by-sa", "cc by sa"),
    Template("cc0", "cc0 1 0 universal", ("cc0",)),
    Template("agpl", "gnu affero general public license"),
    Template("lgpl", "gnu lesser general public license"),
    Template("gnu-gpl", "this work is licensed under the gnu general public license version",
             ("gnu general public license",)),
    Template("isc", "permission to use copy modify and or distribute this software for any purpose "
             "with or without fee is hereby granted", ("distribute this software for any purpose",)),
    Template("mit", "released under the mit license", ("mit license",)),
    Template("mit", "permission is hereby granted free of charge to any person obtaining a copy of "
             "this software and associated documentation files",
             ("permission is hereby granted free of charge",)),
    Template("mpl", "this source code form is subject to the terms of the mozilla public license",
             ("mozilla public license",)),
    Template("unlicense", "this is free and unencumbered software released into the public domain",
             ("released into the public domain",)),
)

#: Rare words of its key phrases by which a template is entered. They all have to agree, as all are mandatory.
ENTRIES = 4


def _hashes(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    ends = np.cumsum([len(w.encode()) + 1 for w in words]) - 1
    starts = ends - [len(w.encode()) for w in words]
    return span_hash(byte_prefix(data), starts, ends)


class Index:
    """Postings of the templates' words; ``frequency`` is their number of documents."""

    def __init__(self, templates, frequency: dict[str, int] | None = None):
        self.templates = templates
        self.words = sorted({w for t in templates for w in t.text.split()})
        hashes = _hashes(self.words)
        order = np.argsort(hashes)
        self.words, self.hashes = [self.words[i] for i in order], hashes[order]
        number = {w: i for i, w in enumerate(self.words)}
        self.ids = [np.array([number[w] for w in t.text.split()]) for t in templates]
        self.seen = np.zeros(1 << 16, bool)
        self.seen[(self.hashes & np.uint64(0xFFFF)).astype(np.int64)] = True
        frequency = frequency or {}
        rarity = np.array([frequency.get(w, 0) for w in self.words])
        self.idf = 1.0 / (1.0 + np.log1p(rarity))
        self.must, self.ranked = [], []
        for t, ids in zip(templates, self.ids, strict=True):
            must = np.ones(len(ids), bool)
            if t.keys:
                must[:] = False
                for key in t.keys:
                    at = f" {t.text} ".index(f" {key} ")
                    first = len(t.text[:at].split())
                    must[first : first + len(key.split())] = True
            self.must.append(must)
            # the rarest mandatory words first; equal ones by their text
            self.ranked.append(sorted(set(ids[must]), key=lambda i: (rarity[i], self.words[i])))

    def look_up(self, hashes: np.ndarray) -> np.ndarray:
        """The index's number of each word, -1 for words in no template."""
        found = np.full(len(hashes), -1, np.int64)
        maybe = np.flatnonzero(self.seen[(hashes & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, hashes[maybe]), len(self.hashes) - 1)
        hit = self.hashes[at] == hashes[maybe]
        found[maybe[hit]] = at[hit]
        return found

    def votes(self, t: int, docs: np.ndarray, hits, words: Words) -> np.ndarray:
        """Places of a template's first word on which all entries agree: document, word."""
        wanted = np.zeros(len(words.block), bool)
        wanted[docs] = True
        out, entries = [], 0
        for w in self.ranked[t][:ENTRIES]:
            word = hits[w][wanted[words.doc[hits[w]]]]
            for at in np.flatnonzero((self.ids[t] == w) & self.must[t]):
                out.append(np.stack([words.doc[word], word - at], 1))
                entries += 1
        votes, agreed = np.unique(np.concatenate(out), axis=0, return_counts=True)
        return votes[agreed == entries]

    def places(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Verified places: document, template, first word in the block, score."""
        number = self.look_up(words.hashes)
        hit = np.flatnonzero(number >= 0)
        present = np.zeros((len(words.block), len(self.words)), bool)
        present[words.doc[hit], number[hit]] = True
        hit = hit[np.argsort(number[hit], kind="stable")]
        hits = np.split(hit, np.searchsorted(number[hit], np.arange(1, len(self.words))))
        out = [[], [], [], []]
        for t, ids in enumerate(self.ids):
            docs = np.flatnonzero(present[:, ids[self.must[t]]].all(axis=1))
            if not len(docs):
                continue
            doc, first = self.votes(t, docs, hits, words).T
            # a template may hang over the ends of its document by words that are not mandatory
            places = first[:, None] + np.arange(len(ids))
            inside = (places >= words.of[doc][:, None]) & (places < words.of[doc + 1][:, None])
            equal = inside & (number[np.where(inside, places, 0)] == ids)
            weight = self.idf[ids]
            score = equal @ weight / weight.sum()
            good = equal[:, self.must[t]].all(axis=1)
            begin = np.maximum(first, words.of[doc])
            for to, values in zip(out, (doc, np.full(len(doc), t), begin, np.minimum(score, 1.0)), strict=True):
                to.append(values[good])
        return tuple(np.concatenate(v) if v else np.zeros(0, np.int64) for v in out)


def word_frequencies(docs: DataFrame, templates=TEMPLATES, text_col: str = "text") -> dict[str, int]:
    """In how many documents each word of the templates stands; one row per template word."""
    templates = tuple(templates)

    def make():
        index = Index(templates)

        def work(block: Block, _ids):
            words = Words(block, LOWER[block.data], ALNUM)
            number = index.look_up(words.hashes)
            hit = number >= 0
            pairs = np.unique(words.doc[hit] * len(index.words) + number[hit])
            counts = np.bincount(pairs % len(index.words), minlength=len(index.words))
            some = np.flatnonzero(counts)
            yield {"word": [index.words[i] for i in some], "n": pa.array(counts[some], pa.int64())}

        return work

    counted = map_rows(docs, "word string, n long", make, None, text_col)
    return {r["word"]: r["n"] for r in counted.groupBy("word").agg(F.sum("n").alias("n")).collect()}


def license_scan(
    docs: DataFrame,
    templates=TEMPLATES,
    id_col: str = "doc_id",
    text_col: str = "text",
    frequency: dict[str, int] | None = None,
) -> DataFrame:
    """One row per document: words, places of base phrases and of all templates, labels, score.

    ``places`` has label, first word, score of every verified place.
    """
    templates = tuple(templates)
    if frequency is None:
        frequency = word_frequencies(docs, templates, text_col)

    def make():
        index = Index(templates, frequency)
        base = np.array([t.base for t in templates])
        names = np.array([t.label for t in templates], object)

        def work(block: Block) -> dict:
            words = Words(block, LOWER[block.data], ALNUM)
            doc, template, first, score = index.places(words)
            n = len(block)
            own = first - words.of[doc]
            based = base[template] if len(template) else np.zeros(0, bool)
            low = np.full(n, np.iinfo(np.int64).max)
            high = np.full(n, -1)
            np.minimum.at(low, doc[based], own[based])
            np.maximum.at(high, doc[based], own[based])
            best = np.zeros(n)
            np.maximum.at(best, doc, score)
            labels = [set() for _ in range(n)]
            base_labels = [set() for _ in range(n)]
            places = [[] for _ in range(n)]
            order = np.lexsort((template, own, doc))
            for d, t, p, s in zip(doc[order], template[order], own[order], score[order], strict=True):
                labels[d].add(names[t])
                places[d].append({"label": names[t], "first": int(p), "score": float(s)})
                if base[t]:
                    base_labels[d].add(names[t])
            return {
                "n_words": pa.array(words.counts, pa.int64()),
                "n_base": pa.array(np.bincount(doc[based], minlength=n), pa.int64()),
                "first_word": pa.array(low, pa.int64(), mask=high < 0),
                "last_word": pa.array(high, pa.int64(), mask=high < 0),
                "base_labels": pa.array([",".join(sorted(x)) for x in base_labels], pa.string()),
                "labels": pa.array([",".join(sorted(x)) for x in labels], pa.string()),
                "score": pa.array(best, pa.float64()),
                "places": pa.array(places, pa.list_(pa.struct(
                    [("label", pa.string()), ("first", pa.int64()), ("score", pa.float64())]))),
            }

        return work

    return map_blocks(
        docs,
        "n_words long, n_base long, first_word long, last_word long, base_labels string, "
        "labels string, score double, places array<struct<label:string,first:bigint,score:double>>",
        make, id_col, text_col,
    )
