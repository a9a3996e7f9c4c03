"""License notices in texts, found through a positional index of their rarest words."""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce
from math import log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beforeafter.llm.text import ascii_lower, let, unused
from beforeafter.staging import stage

#: A word: what is no control character, space or sign of ASCII, in lower-cased text.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Template:
    """A notice: its label, its words, and the phrases of it that a copy has to hold.

    Words outside the phrases are indexed if they have ``LEAST_LETTERS`` letters or
    more; they weigh in the score and decide nothing. ``base`` marks the templates
    whose places are counted.
    """

    label: str
    text: str
    phrases: tuple[str, ...]
    base: bool = False


LEAST_LETTERS = 6

#: Phrases and labels of the contract, each within a usual notice.
BASE = (
    Template("gpl", "licensed under the gnu general public license", ("gnu general public license",), True),
    Template("apache", "licensed under the apache license", ("apache license",), True),
    Template("cc-by", "licensed under cc by", ("cc by",), True),
    Template("mit", "released under the mit license", ("mit license",), True),
)

#: Wordings of public licenses and of their usual notices.
NOTICES = (
    Template("apache-2.0", "licensed under the apache license version 2 0", ("apache license version 2 0",)),
    Template("gpl-2.0", "under the terms of the gnu general public license version 2", ("gnu general public license version 2",)),
    Template("gpl-3.0", "under the terms of the gnu general public license version 3", ("gnu general public license version 3",)),
    Template(
        "gpl",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public "
        "license as published by the free software foundation",
        ("free software", "redistribute it and or modify it under the terms of the gnu general public license"),
    ),
    Template(
        "lgpl", "under the terms of the gnu lesser general public license as published by the free software foundation",
        ("gnu lesser general public license",),
    ),
    Template(
        "agpl", "under the terms of the gnu affero general public license as published by the free software foundation",
        ("gnu affero general public license",),
    ),
    Template("cc-by-4.0", "licensed under cc by 4 0", ("cc by 4 0",)),
    Template("cc-by-sa-4.0", "licensed under cc by sa 4 0", ("cc by sa 4 0",)),
    Template("cc-by-nc-4.0", "licensed under cc by nc 4 0", ("cc by nc 4 0",)),
    Template("cc-by-nd-4.0", "licensed under cc by nd 4 0", ("cc by nd 4 0",)),
    Template(
        "cc-by", "this work is licensed under a creative commons attribution 4 0 international license",
        ("creative commons attribution",),
    ),
    Template("cc0", "to the extent possible under law cc0 1 0 universal public domain dedication", ("cc0 1 0 universal",)),
    Template(
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
        "documentation files the software to deal in the software without restriction",
        ("permission is hereby granted free of charge to any person obtaining a copy", "deal in the software without restriction"),
    ),
    Template(
        "bsd",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the "
        "following conditions are met",
        ("redistribution and use in source and binary forms", "provided that the following conditions are met"),
    ),
    Template(
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted "
        "provided that the above copyright notice and this permission notice appear in all copies",
        ("permission to use copy modify and or distribute this software", "is hereby granted"),
    ),
    Template(
        "mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0",
        ("subject to the terms of the mozilla public license v 2 0",),
    ),
    Template(
        "unlicense", "this is free and unencumbered software released into the public domain",
        ("free and unencumbered software released into the public domain",),
    ),
)


@dataclass(frozen=True)
class Posting:
    word: str
    at: int
    mandatory: bool


def postings(template: Template) -> list[Posting]:
    """The template's indexed words with their positions; those of phrases are mandatory."""
    words = re.findall(WORD, template.text)
    must: set[int] = set()
    for phrase in template.phrases:
        parts = re.findall(WORD, phrase)
        starts = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        if not parts or not starts:
            raise ValueError(f"phrase {phrase!r} is not in the template of {template.label}")
        must.update(range(starts[0], starts[0] + len(parts)))
    return [Posting(w, i, i in must) for i, w in enumerate(words) if i in must or len(w) >= LEAST_LETTERS]


def scan(df: DataFrame, templates: tuple[Template, ...] = BASE + NOTICES, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Adds ``n_words``, ``n_base``, ``first_word``, ``last_word``, ``base_labels``,
    ``labels`` and ``score`` to the columns in ``carry`` (default: all but the text).

    A-Z are lower-cased. A template stands at a place if all words of its phrases stand
    at their positions from there, each whole text being searched; its start is that of
    the first phrase. ``n_base`` counts the places of base templates, ``first_word`` and
    ``last_word`` are the least and greatest word number one starts at (null without).
    Labels are distinct, sorted and joined by commas (empty without). ``score`` is the
    greatest share, by inverse document frequency, of a template's indexed words that
    stand in place at one of its places or another; 0 without a place.

    The index files each template under its word that fewest texts hold. A text's words
    look that up, and the start positions they imply are intersected with those of the
    template's other mandatory words, rarest first: what is left is verified in full.
    Frequencies come from all texts. Texts are read once; positions of indexed words are
    written once. Null and empty texts have no words; repeated rows are rows of their
    own; columns of the new names are replaced; an empty table stays empty.
    """
    new = ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    carry = [c for c in (carry if carry is not None else [c for c in df.columns if c != text_col]) if c.lower() not in new]
    indexed = {t: postings(t) for t in templates}
    vocabulary = sorted({p.word for found in indexed.values() for p in found})
    places = unused("_places", carry)
    rows = df.select(*[F.col(f"`{c}`") for c in carry], *_positions(F.col(f"`{text_col}`"), vocabulary, places))
    rows = stage(rows, "license-words")
    idf = _idf(rows, places, vocabulary)

    found = [(t, _starts(indexed[t], idf, F.col(places)), indexed[t]) for t in templates]
    starts = [unused(f"_starts{i}", carry + [places]) for i in range(len(found))]
    looked_up = rows.select(*[F.col(f"`{c}`") for c in carry], "n_words", places, *[s.alias(name) for (_, s, _), name in zip(found, starts)])
    base = [name for (t, _, _), name in zip(found, starts) if t.base]
    count = reduce(lambda a, b: a + b, [F.size(b) for b in base], F.lit(0))
    return looked_up.select(
        *[F.col(f"`{c}`") for c in carry],
        "n_words",
        count.cast("long").alias("n_base"),
        F.array_min(F.array(*[F.array_min(b) for b in base])).cast("long").alias("first_word") if base else F.lit(None).cast("long").alias("first_word"),
        F.array_max(F.array(*[F.array_max(b) for b in base])).cast("long").alias("last_word") if base else F.lit(None).cast("long").alias("last_word"),
        _joined([(t.label, name) for (t, _, _), name in zip(found, starts) if t.base]).alias("base_labels"),
        _joined([(t.label, name) for (t, _, _), name in zip(found, starts)]).alias("labels"),
        F.greatest(F.lit(0.0), F.lit(0.0), *[_score(ps, idf, F.col(places), F.col(name)) for (_, _, ps), name in zip(found, starts)]).alias("score"),
    )


def _positions(text: Column, vocabulary: list[str], name: str) -> list[Column]:
    """``n_words`` and a map from each indexed word of the text to its word numbers."""
    lowered = ascii_lower(F.coalesce(text, F.lit("")))
    # Texts without any indexed word are not cut into words.
    any_word = r"(?:^|[\x00-\x2F\x3A-\x60\x7B-\x7F])(?:" + "|".join(vocabulary) + r")(?:$|[\x00-\x2F\x3A-\x60\x7B-\x7F])"
    words = F.regexp_extract_all(lowered, F.lit(f"({WORD})"), F.lit(0))

    def by_word(all_words: Column) -> Column:
        at = F.filter(F.transform(all_words, lambda w, i: F.struct(w.alias("w"), i.alias("i"))), lambda x: x["w"].isin(vocabulary))
        return let(at, grouped)

    def grouped(at: Column) -> Column:
        held = F.array_distinct(F.transform(at, lambda x: x["w"]))
        return F.map_from_entries(
            F.transform(held, lambda w: F.struct(w, F.transform(F.filter(at, lambda x: x["w"] == w), lambda x: x["i"])))
        )

    nothing = F.lit(None).cast("map<string,array<int>>")
    return [
        F.regexp_count(lowered, F.lit(WORD)).cast("long").alias("n_words"),
        F.when(F.call_function("rlike", lowered, F.lit(any_word)), let(words, by_word)).otherwise(nothing).alias(name),
    ]


def _idf(rows: DataFrame, places: str, vocabulary: list[str]) -> dict[str, float]:
    """ln((1 + texts) / (1 + texts with the word)) + 1 for each indexed word; one figure a word."""
    held = rows.select(F.explode(F.map_keys(places)).alias("word")).groupBy("word").count()
    texts = rows.count()
    seen = {r["word"]: r["count"] for r in held.collect()}
    return {w: log((1 + texts) / (1 + seen.get(w, 0))) + 1 for w in vocabulary}


def _implied(posting: Posting, places: Column, first: int) -> Column:
    """Starts that the places of the posting's word imply (empty if it has none)."""
    at = F.coalesce(F.element_at(places, F.lit(posting.word)), F.array().cast("array<int>"))
    return F.transform(at, lambda p: p - F.lit(posting.at - first))


def _starts(found: list[Posting], idf: dict[str, float], places: Column) -> Column:
    """Word numbers at which all mandatory words stand, looked up by the rarest."""
    must = sorted((p for p in found if p.mandatory), key=lambda p: (-idf[p.word], p.at))
    first = min(p.at for p in must)
    looked_up = reduce(F.array_intersect, [_implied(p, places, first) for p in must])
    none = F.array().cast("array<int>")
    return F.when(F.coalesce(F.map_contains_key(places, F.lit(must[0].word)), F.lit(False)), looked_up).otherwise(none)


def _joined(labelled: list[tuple[str, str]]) -> Column:
    named = [F.when(F.size(name) > 0, F.lit(label)) for label, name in labelled]
    return F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*named)))), ",") if named else F.lit("")


def _score(found: list[Posting], idf: dict[str, float], places: Column, starts: Column) -> Column:
    first = min(p.at for p in found if p.mandatory)
    whole = sum(idf[p.word] for p in found)
    sure = sum(idf[p.word] for p in found if p.mandatory)
    more = [F.when(F.arrays_overlap(starts, _implied(p, places, first)), idf[p.word]).otherwise(0.0) for p in found if not p.mandatory]
    share = F.least(F.lit(1.0), reduce(lambda a, b: a + b, more, F.lit(sure)) / F.lit(whole))
    return F.when(F.size(starts) > 0, share).otherwise(0.0)
