"""License scan: a generalised suffix automaton of license texts.

All templates and short phrases go into one automaton over word ids. A document
is streamed through it word by word; after each word the state gives the
longest suffix of the words so far that occurs in any template (the matching
statistics). Where a match cannot be extended it is maximal; maximal matches of
MIN_MATCH words or more (or of a whole template) are chained per template while
both the document and the template go forward with gaps of at most MAX_GAP
words. A chain is a covered template span; its coverage is the share of the
template's words in it. Phrases are read off the same walk: a phrase stands
where the state's string ends in it and the match is at least as long.

Words are maximal runs of 0-9, a-z (A-Z lower-cased) and non-ASCII characters.
The automaton is broadcast; its templates are an argument of at most MAX_WORDS
words. Null and empty texts have no words, places or spans; null keys are kept; repeated
rows give repeated results; an empty table gives none; columns beside key and text are
ignored; texts of any length are streamed whole, in bounded slices or alone.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackwise.llm.batches import documents, small_batches, text_slices

MIN_MATCH, MAX_GAP = 4, 6
MIN_COVERAGE = 0.6
MAX_WORDS = 1_000_000

#: bytes of words as they are, A-Z lower-cased, all others blank
WORD_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
                   for c in range(256))

# Phrases of the contract and well-known license wordings.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
TEMPLATES = (
    ("mit", "Released under the MIT License"),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions: The above copyright notice and this permission notice shall be "
            "included in all copies or substantial portions of the Software."),
    ("apache", "Licensed under the Apache License, Version 2.0"),
    ("apache", "you may not use this file except in compliance with the License. You may obtain a copy of the "
               "License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed "
               "to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT "
               "WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied."),
    ("gpl", "This work is licensed under the GNU General Public License, version 3"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
            "General Public License as published by the Free Software Foundation, either version 3 of the License, "
            "or (at your option) any later version."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted "
            "provided that the following conditions are met: Redistributions of source code must retain the above "
            "copyright notice, this list of conditions and the following disclaimer."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
)


def words_of(text: str) -> list[bytes]:
    return text.encode().translate(WORD_BYTES).split()


def build_automaton(templates: Sequence[tuple[str, str]], phrases: Sequence[tuple[str, str]]) -> dict:
    """The automaton as plain lists: step[state][word id], link, length;
    where[state]: {template: last words of all occurrences, ascending}; ends[state]:
    phrases (words, label) that the state's string ends in. The places of all states
    together are at most the sum of the templates' words times the depth of the tree of links
    at them; the bound on the templates' words bounds both."""
    vocab: dict[bytes, int] = {}
    texts = [[vocab.setdefault(w, len(vocab)) for w in words_of(t)] 
             for t in (*(t for _, t in templates), *(p for p, _ in phrases))]
    if sum(map(len, texts)) > MAX_WORDS:
        raise ValueError(f"more than {MAX_WORDS} words of templates")
    step: list[dict[int, int]] = [{}]
    link, length = [-1], [0]

    def state(edges: dict, to: int, n: int) -> int:
        step.append(edges)
        link.append(to)
        length.append(n)
        return len(step) - 1

    def clone(p: int, w: int) -> int:
        """The state after p and w, of strings no longer than p's plus w."""
        q = step[p][w]
        if length[q] == length[p] + 1:
            return q
        c = state(dict(step[q]), link[q], length[p] + 1)
        link[q] = c
        while p >= 0 and step[p].get(w) == q:
            step[p][w] = c
            p = link[p]
        return c

    def extend(last: int, w: int) -> int:
        if w in step[last]:
            return clone(last, w)
        new, p = state({}, 0, length[last] + 1), last
        while p >= 0 and w not in step[p]:
            step[p][w] = new
            p = link[p]
        if p >= 0:
            link[new] = clone(p, w)
        return new

    for text in texts:
        last = 0
        for w in text:
            last = extend(last, w)
    where: list[dict[int, list[int]]] = [{} for _ in step]
    whole: list[list[tuple[int, str]]] = [[] for _ in step]
    for t, text in enumerate(texts):
        s = 0
        for i, w in enumerate(text):
            s = step[s][w]
            if t < len(templates):
                where[s].setdefault(t, []).append(i)
        if t >= len(templates) and text:
            whole[s].append((len(text), phrases[t - len(templates)][1]))
    order = sorted(range(1, len(step)), key=length.__getitem__)
    for s in reversed(order):                 # an occurrence of a state is one of its suffix states
        for t, at in where[s].items():
            where[link[s]].setdefault(t, []).extend(at)
    ends: list[tuple] = [()] * len(step)
    for s in order:
        ends[s] = (*whole[s], *ends[link[s]])
    return {"vocab": vocab, "step": step, "link": link, "length": length, "ends": ends,
            "where": [{t: sorted(at) for t, at in w.items()} for w in where],
            "templates": [(label, len(text)) for (label, _), text in zip(templates, texts)]}


def stream(automaton: Mapping, words: list[bytes], min_match: int = MIN_MATCH):
    """(places: (first word, label), maximal matches: (end, length, state)) of a word sequence."""
    step, link, length, ends = (automaton[k] for k in ("step", "link", "length", "ends"))
    sizes = {n for _, n in automaton["templates"] if n < min_match}
    places, matches = [], []
    s = n = 0
    for j, w in enumerate(map(automaton["vocab"].get, words)):
        if w is None:
            if n:
                if n >= min_match or n in sizes:
                    matches.append((j, n, s))
                s = n = 0
            continue
        nxt = step[s].get(w)
        if nxt is None:
            if n >= min_match or n in sizes:
                matches.append((j, n, s))
            while s and nxt is None:
                s = link[s]
                n = length[s]
                nxt = step[s].get(w)
            if nxt is None:
                n = 0
                continue
        s, n = nxt, n + 1
        for size, label in ends[s]:
            if size <= n:
                places.append((j + 1 - size, label))
    if n >= min_match or n in sizes:
        matches.append((len(words), n, s))
    return places, matches


def chain(automaton: Mapping, matches, min_match: int = MIN_MATCH, max_gap: int = MAX_GAP):
    """Covered template spans: (label, first word, words, coverage).

    A match that stands several times in a template continues an open chain at the
    nearest place behind the chain's end there; at none it begins a chain of its own
    at the first place.
    """
    open_: dict[int, list] = {}     # template: [first word, end, template end, covered words]
    spans = []

    def close(t: int) -> None:
        first, end, _, covered = open_.pop(t)
        label, size = automaton["templates"][t]
        spans.append((label, first, end - first, covered / size))

    for end, n, s in matches:
        for t, places in automaton["where"][s].items():
            if n < min(min_match, automaton["templates"][t][1]):
                continue
            start, c = end - n, open_.get(t)
            if c:
                behind = bisect_right(places, c[2] - 1)                # the first place that ends behind the chain's
                if behind < len(places):
                    t_start, t_end = places[behind] + 1 - n, places[behind] + 1
                    lap = max(0, c[1] - start, c[2] - t_start)      # words that the chain has already
                    if lap < n and start - c[1] <= max_gap and t_start - c[2] <= max_gap:
                        open_[t] = [c[0], end, t_end, c[3] + n - lap]
                        continue
                close(t)
            open_[t] = [start, end, places[0] + 1, n]
    for t in list(open_):
        close(t)
    return spans


PLACE = pa.struct([("word", pa.int64()), ("label", pa.string())])
SPAN = pa.struct([("label", pa.string()), ("word", pa.int64()), ("n_words", pa.int64()), ("coverage", pa.float64())])


def scan(docs: DataFrame, templates=TEMPLATES, phrases=PHRASES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, places: phrases by first word, spans: covered template spans) of every row."""
    from pyspark.sql.pandas.types import to_arrow_type

    small_batches(docs.sparkSession)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    key_type = to_arrow_type(rows.schema["key"].dataType)
    sent = rows.sparkSession.sparkContext.broadcast(build_automaton(templates, phrases))

    def scan_slices(batches):
        automaton = sent.value
        for keys, texts in text_slices(batches, "key", "text"):
            counts, places, spans = [], [], []
            for b in texts:
                words = b.translate(WORD_BYTES).split()
                found, matches = stream(automaton, words)
                counts.append(len(words))
                places.append([{"word": w, "label": x} for w, x in found])
                spans.append([dict(zip(("label", "word", "n_words", "coverage"), x)) for x in chain(automaton, matches)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, key_type), pa.array(counts, pa.int64()), pa.array(places, pa.list_(PLACE)),
                 pa.array(spans, pa.list_(SPAN))], ["key", "n_words", "places", "spans"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(scan_slices, f"key {kind}, n_words long, places array<struct<word:long,label:string>>, "
                           "spans array<struct<label:string,word:long,n_words:long,coverage:double>>"
                           ).withColumnRenamed("key", key)


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = F.col("places.label")
    covered = F.expr(f"filter(spans, s -> s.coverage >= {MIN_COVERAGE}).label")
    return scan(documents(spark, sf_dir)).select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min("places.word").alias("first_word"), F.array_max("places.word").alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, covered)), ",").alias("labels"),
        F.coalesce(F.array_max("spans.coverage"), F.lit(0.0)).alias("score"))


_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: the base columns of the query, phrase by phrase over the words of every text
BASE_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
                  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
p AS (SELECT * FROM (VALUES {', '.join(f"({phrase.split()!r}, '{label}')" for phrase, label in PHRASES)}) t(phrase, label)),
f AS (SELECT r, i, label FROM d, p, unnest(range(0, len(w))) u(i) WHERE list_slice(w, i + 1, i + len(phrase)) = phrase)
SELECT any_value(doc_id) AS doc_id, any_value(len(w))::BIGINT AS n_words, count(i) AS n_base, min(i) AS first_word, max(i) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS base_labels
FROM d LEFT JOIN f USING (r) GROUP BY d.r"""
