"""Licence scan by a positional rare-token index.

Every template is a word sequence with mandatory key phrases. Document
frequencies of the licence words over the whole corpus (one map-side
aggregate over a fixed vocabulary) give their IDF. The index posts, per
template, the highest-IDF word of each key phrase with its place in the
template. A file looks up those of its words that are in the index; each
occurrence proposes a template start, proposals that agree on the relative
position meet in one candidate, and a candidate counts if all its key
phrases stand word by word at their places. As a key phrase cannot stand
without its rarest word, no place of a phrase is missed.

Nulls and edges: a null text is empty (0 words, no label, score 0, null
places); rows that repeat are each returned; other columns are not read; on
an empty table the IDF is flat and the result empty.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame

from .common import python_ready, texts

#: The base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Licence notices: label, words, key phrases that must stand at their place.
NOTICES = (
    ("gpl-3.0", "licensed under the gnu general public license version 3", ("gnu general public license version 3",)),
    ("gpl-2.0", "licensed under the gnu general public license version 2", ("gnu general public license version 2",)),
    ("lgpl", "licensed under the gnu lesser general public license", ("gnu lesser general public license",)),
    ("agpl", "licensed under the gnu affero general public license", ("gnu affero general public license",)),
    ("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    ("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    ("cc-by-nd-4.0", "licensed under cc by nd 4 0", ("cc by nd 4 0",)),
    ("mit-notice", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", ("permission is hereby granted free of charge", "to any person obtaining a copy")),
    ("bsd-notice", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use in source and binary forms", "are permitted provided that")),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license v 2 0",)),
    ("isc-notice", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", ("permission to use copy modify", "with or without fee")),
    ("unlicense", "this is free and unencumbered software released into the public domain", ("free and unencumbered software", "public domain")),
)

#: Words: runs of digits, letters a to z and everything beyond ASCII.
WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


class Template:
    def __init__(self, label: str, text: str, keys: tuple[str, ...], base: bool):
        self.label, self.base = label, base
        self.words = text.encode().split()
        self.keys = []
        for k in keys:
            key = k.encode().split()
            at = next(i for i in range(len(self.words)) if self.words[i : i + len(key)] == key)
            self.keys.append((at, key))


TEMPLATES = [Template(label, phrase, (phrase,), True) for phrase, label in BASE.items()]
TEMPLATES += [Template(label, text, keys, False) for label, text, keys in NOTICES]


def words_of(text: str) -> list[bytes]:
    return WORD.findall(text.encode("utf-8", "surrogatepass").lower())


def licence_words(templates=TEMPLATES) -> frozenset[bytes]:
    return frozenset(w for t in templates for w in t.words)


def inverse_frequencies(docs: DataFrame, templates=TEMPLATES) -> dict[bytes, float]:
    """IDF of every licence word over all documents (one row a word reaches
    the driver)."""
    python_ready(docs.sparkSession)
    vocabulary = licence_words(templates)

    def count(batches) -> Iterator:
        import pyarrow as pa

        seen: dict[str, int] = {}
        n = 0
        for b in batches:
            for text in b.column(0).to_pylist():
                n += 1
                for w in vocabulary.intersection(words_of(text)):
                    seen[w.decode()] = seen.get(w.decode(), 0) + 1
        seen[""] = n
        yield pa.RecordBatch.from_pydict({"word": pa.array(list(seen), pa.string()), "n": pa.array(list(seen.values()), pa.int64())})

    found = texts(docs).select("text").mapInArrow(count, "word string, n long").groupBy("word").sum("n").collect()
    df = {r[0].encode(): r[1] for r in found}
    n = df.pop(b"", 0)
    return {w: math.log((n + 1) / (df.get(w, 0) + 1)) + 1.0 for w in vocabulary}


class RareTokenIndex:
    """Postings: rare word -> (template, its place in the template)."""

    def __init__(self, idf: dict[bytes, float], templates=TEMPLATES):
        self.idf, self.templates = idf, templates
        self.postings: dict[bytes, list[tuple[int, int]]] = {}
        self.anchors: list[list[int]] = []
        for t, template in enumerate(templates):
            places = []
            for at, key in template.keys:
                rarest = max(range(len(key)), key=lambda i: (idf[key[i]], key[i], -i))
                places.append(at + rarest)
                self.postings.setdefault(key[rarest], []).append((t, at + rarest))
            self.anchors.append(places)
        self.weight = [sum(idf[w] for w in t.words) for t in templates]

    def places(self, words: list[bytes]) -> list[tuple[int, int, float]]:
        """(template, start, share of its IDF weight that stands in place),
        for every start at which all key phrases stand."""
        postings, met = self.postings, {}
        for i, w in enumerate(words):
            if w in postings:
                for t, at in postings[w]:
                    met.setdefault((t, i - at), set()).add(at)
        out = []
        for (t, start), at in met.items():
            template = self.templates[t]
            if len(at) < len(set(self.anchors[t])):
                continue
            if all(start + a >= 0 and words[start + a : start + a + len(k)] == k for a, k in template.keys):
                held = sum(self.idf[w] for i, w in enumerate(template.words) if 0 <= start + i < len(words) and words[start + i] == w)
                out.append((t, start, held / self.weight[t]))
        return out


def scan_text(index: RareTokenIndex, text: str) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score."""
    words = words_of(text)
    places = index.places(words)
    base = [(index.templates[t], start + index.templates[t].keys[0][0]) for t, start, _ in places if index.templates[t].base]
    notices = [(index.templates[t], share) for t, _, share in places if not index.templates[t].base]
    starts = [s for _, s in base]
    base_labels = {t.label for t, _ in base}
    labels = base_labels | {t.label for t, _ in notices}
    score = 0.0
    if labels:
        score = 0.5 + 0.5 * max((share for _, share in notices), default=0.0)
    return len(words), len(base), min(starts, default=None), max(starts, default=None), ",".join(sorted(base_labels)), ",".join(sorted(labels)), min(1.0, score)


def license_scan(docs: DataFrame, templates=TEMPLATES) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and
    score (0: no label; 0.5: base phrases alone; else 0.5 and half the best
    notice's IDF share), a row per document."""
    index = RareTokenIndex(inverse_frequencies(docs, templates), templates)

    def run(batches) -> Iterator:
        import pyarrow as pa

        for b in batches:
            cols = list(zip(*[scan_text(index, t) for t in b.column(1).to_pylist()])) or [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, k) for c, k in zip(cols, kinds)]], ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])

    return texts(docs).mapInArrow(run, "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def oracle_sql(templates=TEMPLATES) -> str:
    """The scan as DuckDB SQL: every place of every template in every text."""

    def words(ws) -> str:
        return "[" + ", ".join("'" + w.decode() + "'" for w in ws) + "]"

    places, template_words = [], []
    for t, x in enumerate(templates):
        stands = " AND ".join(f"s + {at} >= 0 AND w[s + {at + 1} : s + {at + len(key)}] = {words(key)}" for at, key in x.keys)
        places.append(f"SELECT n, {t} AS t, '{x.label}' AS label, {x.base} AS base, w, unnest(list_filter(range(-{len(x.words)}, len(w)), lambda s: {stands})) AS start FROM d")
        template_words += [f"({t}, {i}, '{w.decode()}')" for i, w in enumerate(x.words)]
    vocabulary = ", ".join(f"('{w.decode()}')" for w in sorted(licence_words(templates)))
    union = "\n  UNION ALL ".join(places)
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS n, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
seen AS (SELECT word, count(*) AS df FROM (SELECT DISTINCT n, unnest(w) AS word FROM d) GROUP BY word),
idf AS (
  SELECT v.word, ln(((SELECT count(*) FROM d) + 1) / (coalesce(df, 0) + 1)) + 1 AS idf
  FROM (VALUES {vocabulary}) v(word) LEFT JOIN seen ON seen.word = v.word),
tw AS (SELECT t, i, x.word, idf FROM (VALUES {', '.join(template_words)}) x(t, i, word) JOIN idf ON idf.word = x.word),
places AS (
  {union}),
shares AS (
  SELECT p.n, p.label, p.base, p.t, p.start,
         sum(CASE WHEN start + i >= 0 AND start + i < len(w) AND w[start + i + 1] = tw.word THEN idf ELSE 0 END) / sum(idf) AS share
  FROM places p JOIN tw ON tw.t = p.t GROUP BY p.n, p.label, p.base, p.t, p.start),
found AS (
  SELECT n, count(*) FILTER (WHERE base) AS n_base, min(start) FILTER (WHERE base) AS first_word, max(start) FILTER (WHERE base) AS last_word,
         string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE base) AS base_labels, string_agg(DISTINCT label, ',' ORDER BY label) AS labels,
         0.5 + 0.5 * coalesce(max(share) FILTER (WHERE NOT base), 0) AS score
  FROM shares GROUP BY n)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_base, 0) AS BIGINT) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(round(least(coalesce(score, 0), 1), 6) AS DOUBLE) AS score
FROM d LEFT JOIN found ON found.n = d.n
"""
