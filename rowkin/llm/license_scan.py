"""License scans: a positional rare-token index over licence templates, in DataFrame functions only.

Words are `[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+` of the lower-cased (A-Z) text. The base scan finds every place
where a phrase's words stand consecutively.

The method looks for templates: notices, headers and bodies of licences. Its index holds, for each template, the
positions of its rare tokens: of its distinct words the half with the highest inverse document frequency over all
documents, at most `rarest`. Every word of a text that is in the index is looked up; each posting (template,
position) votes for the place where the template would begin: text position - template position. A place with
votes of the share `agree` of a template's postings, rounded up, is a candidate. There the template is verified: the
words of its mandatory key phrases must stand at their places, and the share `agree` of all its words at theirs.
What else stands in the text doesn't count, nor how many templates it has.

Scale: two passes over the texts, without a shuffle of texts. The first counts document frequencies of the templates'
words, one partial-aggregated number a word. In the second everything happens within a row. Votes are 64-bit
numbers that are sorted once, so that work is n log n in a text's votes; a vote is a place of a rare token, so
common words cost nothing but the look-up. The postings and templates are literals of the plan, as large as the
templates, which are a parameter.

Nulls and odd rows: a null text has no words; a text without licence words has empty labels and score 0;
repeated rows are judged alike; templates that stand several times count once, with their best share; equal document
frequencies are ordered by word; columns named like the results, in any case, are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

#: Splits a lower-cased text.
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Base phrases and their labels: fixed values.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: label: (words of the notice, header or body, mandatory key phrases); licence texts are fixed values.
TEMPLATES = {
    "mit-notice": ("released under the mit license", ["mit license"]),
    "mit-text": (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in "
        "the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of "
        "the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this "
        "permission notice shall be included in all copies or substantial portions of the software",
        ["permission is hereby granted free of charge", "copies or substantial portions of the software"],
    ),
    "apache-2.0": ("licensed under the apache license version 2 0", ["apache license version 2 0"]),
    "apache-2.0-header": (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the "
        "license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is "
        "distributed on an as is basis without warranties or conditions of any kind either express or implied",
        ["apache license version 2 0", "except in compliance with the license"],
    ),
    "gpl-3.0": ("this work is licensed under the gnu general public license version 3", ["gnu general public license version 3"]),
    "gpl-3.0-header": (
        "is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software "
        "foundation either version 3 of the license or at your option any later version",
        ["gnu general public license as published by", "version 3 of the license"],
    ),
    "gpl-2.0": ("this program is free software licensed under the gnu general public license version 2", ["gnu general public license version 2"]),
    "gpl-2.0-header": (
        "is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software "
        "foundation either version 2 of the license or at your option any later version",
        ["gnu general public license as published by", "version 2 of the license"],
    ),
    "lgpl-2.1-header": (
        "is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software "
        "foundation either version 2 1 of the license or at your option any later version",
        ["gnu lesser general public license", "version 2 1 of the license"],
    ),
    "agpl-3.0-header": (
        "is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software "
        "foundation either version 3 of the license or at your option any later version",
        ["gnu affero general public license", "version 3 of the license"],
    ),
    "cc-by-nc-4.0": ("licensed under cc by nc 4 0", ["licensed under cc by nc 4 0"]),
    "cc-by-4.0": ("licensed under cc by 4 0", ["licensed under cc by 4 0"]),
    "cc-by-sa-4.0": ("licensed under cc by sa 4 0", ["licensed under cc by sa 4 0"]),
    "cc-by-4.0-header": (
        "this work is licensed under a creative commons attribution 4 0 international license",
        ["creative commons attribution 4 0 international"],
    ),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted", ["source and binary forms"]),
    "bsd-text": (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met 1 "
        "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer 2 redistributions in binary "
        "form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided "
        "with the distribution",
        ["source and binary forms", "redistributions of source code must retain", "redistributions in binary form must reproduce"],
    ),
    "isc": (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright "
        "notice and this permission notice appear in all copies",
        ["with or without fee is hereby granted"],
    ),
    "mpl-2.0": ("subject to the terms of the mozilla public license v 2 0", ["mozilla public license"]),
    "mpl-2.0-header": (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain "
        "one at",
        ["mozilla public license v 2 0", "if a copy of the mpl was not distributed"],
    ),
    "boost-1.0": ("distributed under the boost software license version 1 0", ["boost software license version 1 0"]),
    "unlicense": ("this is free and unencumbered software released into the public domain", ["unencumbered software"]),
}

#: A vote is template << PLACE_BITS, plus the template's beginning in the text, plus ORIGIN, since that can be negative.
PLACE_BITS, ORIGIN = 40, 1 << 32


def words_of(text: Column) -> Column:
    """The words of a text, A-Z lower-cased; lower() says the same of ASCII texts, and is faster."""
    text = F.coalesce(text, F.lit(""))
    low = F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(ascii_lower(text))
    return F.filter(F.split(low, NOT_WORD), lambda w: w != "")


def _starts(words: str, phrase: str) -> Column:
    """Positions where the phrase starts; words: a column name's array of lower-cased words."""
    parts = phrase.split()

    def here(w, i):
        out = w == parts[0]
        for k, p in enumerate(parts[1:], 1):
            out = out & F.coalesce(F.get(words, i + k) == p, F.lit(False))
        return out

    marked = F.transform(words, lambda w, i: F.when(here(w, i), i.cast("bigint")))
    return F.array_compact(marked)


def _numbers(rows: list[list[int]]) -> Column:
    """A literal array of arrays of bigint."""
    return F.array(*[F.split(F.lit(",".join(map(str, r))), ",").cast("array<bigint>") for r in rows])


def rare_tokens(words: list[str], df: dict[str, int], rarest: int) -> set[str]:
    """The half of the distinct words with the lowest document frequency, at most `rarest`."""
    distinct = sorted(set(words), key=lambda w: (df.get(w, 0), w))
    return set(distinct[: min(rarest, math.ceil(len(distinct) / 2))])


class Index:
    """The templates as literals: postings of the rare tokens, votes needed, all words, places of the key phrases."""

    def __init__(self, templates: dict[str, tuple[str, list[str]]], df: dict[str, int], rarest: int, agree: float):
        postings: dict[str, list[int]] = {}
        need, words, keys = [], [], []
        for t, (notice, must) in enumerate(templates.values()):
            mine = notice.split()
            rare = rare_tokens(mine, df, rarest)
            spots = [(p, w) for p, w in enumerate(mine) if w in rare]
            for p, w in spots:
                postings.setdefault(w, []).append((t << PLACE_BITS) + ORIGIN - p)
            need.append(math.ceil(agree * len(spots) - 1e-9))
            words.append(mine)
            places = set()
            for phrase in must:
                parts = phrase.split()
                at = next((p for p in range(len(mine)) if mine[p : p + len(parts)] == parts), None)
                if at is None:
                    raise ValueError(f"key phrase {phrase!r} isn't in its template")
                places |= set(range(at, at + len(parts)))
            keys.append(sorted(places))
        self.tokens = sorted(postings)
        self.postings = F.map_from_arrays(F.array(*map(F.lit, self.tokens)), _numbers([postings[w] for w in self.tokens]))
        self.need = F.array(*map(F.lit, need))
        self.words = F.array(*[F.split(F.lit(" ".join(w)), " ") for w in words])
        self.keys = _numbers(keys)
        self.labels = F.array(*map(F.lit, templates))

    def votes(self, words: str) -> Column:
        """Sorted votes of an array of words: array<bigint>, null if no word is in the index."""
        spots = F.filter(F.transform(words, lambda w, i: F.when(w.isin(self.tokens), F.struct(w.alias("w"), i.alias("p")))), lambda s: s.isNotNull())
        each = F.transform(spots, lambda s: F.transform(F.element_at(self.postings, s["w"]), lambda x: x + s["p"]))
        return F.when(F.exists(words, lambda w: w.isin(self.tokens)), F.sort_array(F.flatten(each)))

    def candidates(self, votes: str) -> Column:
        """The distinct votes that are cast as often as their template needs."""

        def enough(v, i):
            last = F.get(votes, i + F.get(self.need, F.shiftright(v, PLACE_BITS).cast("int")) - 1)
            first = F.coalesce((i == 0) | (F.get(votes, i - 1) != v), F.lit(True))
            return first & F.coalesce(last == v, F.lit(False))

        return F.filter(votes, enough)

    def verified(self, candidates: str, words: str) -> Column:
        """(label, share) of each candidate whose key phrases stand at their places: the share of its words that do."""

        def judged(v):
            t = F.shiftright(v, PLACE_BITS).cast("int")
            start = (v.bitwiseAND(F.lit((1 << PLACE_BITS) - 1)) - ORIGIN).cast("int")
            mine = F.get(self.words, t)
            there = F.filter(mine, lambda w, j: F.coalesce(w == F.get(words, start + j), F.lit(False)))
            keys = F.forall(F.get(self.keys, t), lambda j: F.coalesce(F.get(mine, j.cast("int")) == F.get(words, start + j.cast("int")), F.lit(False)))
            return F.when(keys, F.struct(F.get(self.labels, t).alias("label"), (F.size(there) / F.size(mine)).alias("share")))

        return F.array_compact(F.transform(candidates, judged))


def document_frequencies(docs: DataFrame, text_col: str, vocabulary: list[str]) -> dict[str, int]:
    """In how many documents each word of the vocabulary is: at most as many rows."""
    mine = docs.select(words_of(F.col(text_col)).alias("_l")).select(F.explode(F.array_distinct(F.filter("_l", lambda w: w.isin(vocabulary)))).alias("w"))
    return {r["w"]: r["n"] for r in mine.groupBy("w").agg(F.count("*").alias("n")).collect()}


def license_scan(
    docs: DataFrame,
    text_col: str = "text",
    phrases: dict[str, str] = PHRASES,
    templates: dict[str, tuple[str, list[str]]] = TEMPLATES,
    rarest: int = 8,
    agree: float = 0.75,
) -> DataFrame:
    """docs without the text, with n_words, n_base, first_word, last_word, base_labels, labels, score."""
    made = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    inner = ["_t", "_may", "_l", "_votes", "_found", *[f"_b{i}" for i in range(len(phrases))]]
    keep = [c for c in docs.columns if c.lower() not in {text_col.lower(), *made, *inner}]
    index = Index(templates, document_frequencies(docs, text_col, sorted({w for t, _ in templates.values() for w in t.split()})), rarest, agree)
    # only texts with the longest word of a base phrase can have the phrase; the test is ASCII case-insensitive
    anchors = sorted({max(p.split(), key=len) for p in phrases})
    out = docs.select(*[F.col(f"`{c}`") for c in keep], words_of(F.col(text_col)).alias("_l"), F.coalesce(F.col(text_col), F.lit("")).rlike("(?i)" + "|".join(anchors)).alias("_may"))
    none = F.array().cast("array<bigint>")
    out = out.withColumns({"_votes": index.votes("_l")} | {f"_b{i}": F.when(F.col("_may"), _starts("_l", p)).otherwise(none) for i, p in enumerate(phrases)})
    out = out.withColumn("_votes", index.candidates("_votes")).withColumn("_found", index.verified("_votes", "_l"))
    based = [F.when(F.size(f"_b{i}") > 0, F.lit(x)) for i, x in enumerate(phrases.values())]
    starts = F.flatten(F.array(*[F.col(f"_b{i}") for i in range(len(phrases))]))
    found = F.coalesce(F.transform(F.filter("_found", lambda x: x["share"] >= agree), lambda x: x["label"]), F.array().cast("array<string>"))
    named = lambda xs: F.array_join(F.array_sort(F.array_distinct(F.array_compact(xs))), ",")
    return out.select(
        *[F.col(f"`{c}`") for c in keep],
        F.size("_l").cast("bigint").alias("n_words"),
        F.size(starts).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        named(F.array(*based)).alias("base_labels"),
        named(F.concat(F.array(*based), found)).alias("labels"),
        F.greatest(F.lit(0.0), F.when(F.size(starts) > 0, F.lit(1.0)), F.array_max(F.transform("_found", lambda x: x["share"]))).alias("score"),
    )
