"""Licence scan by ordered signature rules (DataFrame functions only).

A text is lower-cased (A-Z) and reduced to its words joined by one space.
Every rule names its stems, of which each of its matches holds at least one;
texts whose words hold no stem of any rule are done at once.  For the others a
rule is tried only if one of its stems and its keyword occur (the prefilter,
also on the collapsed words); a rule that matches marks
its places in the word sequence, which gives intervals of words.  Resolution
is linear: of the intervals that start at a word the longest stays, of equal
ones the rule that stands first (its priority); then every interval that
lies within an earlier-starting one is suppressed.  No rule spans more than
``MAX_WORDS`` words, so only that many starts have to be looked back at.

Everything happens within a row: no shuffle, no join, no limit on the
number of detections.

Edge cases: null and empty texts have no words and no labels; repeated rows
are judged alike; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import functools
import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import let, text_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Separators and word characters of a lower-cased text.
GAP = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# FIXED VALUES: stems of the rules of names, of grants and of Creative Commons.
NAMED, GRANTED = ("licen",), ("ed under ", "available under ")
COMMONS = (" cc by ", " cc attribution ", " creative commons by ", " creative commons attribution ")
#: The contract's base phrases and their labels.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))
#: Words that the longest rule can span.
MAX_WORDS = 40

# FIXED VALUES: licence id, names as they are written (after lower-casing and
# word splitting), versions; the ids follow the public SPDX list.
FAMILIES = (
    ("mit", ("mit", "expat", "x11"), ()),
    ("apache", ("apache", "apache software"), ("1 0", "1 1", "2 0")),
    ("gpl", ("gnu general public", "general public", "gnu gpl", "gpl"), ("1 0", "2 0", "3 0", "1", "2", "3")),
    ("lgpl", ("gnu lesser general public", "lesser general public", "gnu library general public", "gnu lgpl", "lgpl"),
     ("2 0", "2 1", "3 0", "2", "3")),
    ("agpl", ("gnu affero general public", "affero general public", "gnu agpl", "agpl"), ("1 0", "3 0", "3")),
    ("bsd-2-clause", ("bsd 2 clause", "2 clause bsd", "two clause bsd", "simplified bsd", "freebsd"), ()),
    ("bsd-3-clause", ("bsd 3 clause", "3 clause bsd", "three clause bsd", "new bsd", "modified bsd", "revised bsd"), ()),
    ("bsd", ("bsd",), ()),
    ("isc", ("isc",), ()),
    ("mpl", ("mozilla public", "mpl"), ("1 0", "1 1", "2 0")),
    ("epl", ("eclipse public", "epl"), ("1 0", "2 0")),
    ("cddl", ("common development and distribution", "cddl"), ("1 0", "1 1")),
    ("cpl", ("common public",), ("1 0",)),
    ("artistic", ("artistic",), ("1 0", "2 0")),
    ("zlib", ("zlib", "zlib libpng"), ()),
    ("bsl", ("boost software", "bsl"), ("1 0",)),
    ("wtfpl", ("do what the fuck you want to public", "wtfpl"), ("2",)),
    ("unlicense", ("unlicense",), ()),
    ("python", ("python software foundation", "psf"), ("2",)),
    ("ofl", ("sil open font", "open font", "ofl"), ("1 0", "1 1")),
    ("ms-pl", ("microsoft public", "ms pl"), ()),
    ("ms-rl", ("microsoft reciprocal", "ms rl"), ()),
    ("eupl", ("european union public", "eupl"), ("1 0", "1 1", "1 2")),
    ("openssl", ("openssl",), ()),
    ("postgresql", ("postgresql",), ()),
    ("ncsa", ("university of illinois ncsa open source", "ncsa"), ()),
    ("afl", ("academic free", "afl"), ("2 1", "3 0")),
    ("osl", ("open software", "osl"), ("2 1", "3 0")),
    ("ruby", ("ruby",), ()),
    ("php", ("php",), ("3 0", "3 01")),
    ("vim", ("vim",), ()),
    ("odbl", ("open database", "odbl"), ("1 0",)),
    ("gfdl", ("gnu free documentation", "free documentation", "gfdl"), ("1 1", "1 2", "1 3")),
    ("sspl", ("server side public", "sspl"), ("1",)),
    ("busl", ("business source", "busl"), ("1 1",)),
    ("elastic", ("elastic",), ("2 0",)),
)
# FIXED VALUES: Creative Commons elements, with the words that name them.
CC_ELEMENTS = (
    ("by-nc-nd", ("by nc nd", "attribution noncommercial noderivatives", "attribution non commercial no derivatives")),
    ("by-nc-sa", ("by nc sa", "attribution noncommercial sharealike", "attribution non commercial share alike")),
    ("by-nc", ("by nc", "attribution noncommercial", "attribution non commercial")),
    ("by-nd", ("by nd", "attribution noderivatives", "attribution no derivatives")),
    ("by-sa", ("by sa", "attribution sharealike", "attribution share alike")),
    ("by", ("by", "attribution")),
)
CC_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")
# FIXED VALUES: opening words of well-known licence texts, their label, keyword, weight and (if the keyword is none) stems.
TEXTS = (
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", "permission is hereby", 1.0),
    ("permission to use copy modify and or distribute this software for any purpose", "isc", "permission to use", 1.0),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd",
     "redistribution and use", 1.0),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu", "gpl", "program is free software", 0.9),
    ("either version 2 of the license or (?:at your option|\\(at your option\\)) any later version", "gpl-2.0-or-later", "either version 2", 0.9),
    ("either version 3 of the license or (?:at your option|\\(at your option\\)) any later version", "gpl-3.0-or-later", "either version 3", 0.9),
    ("this software is provided as is without any express or implied warranty", "zlib", "software is provided as is", 0.7),
    ("this is free and unencumbered software released into the public domain", "unlicense", "unencumbered", 1.0),
    ("(?:dedicated|released|placed) (?:to|into|in) the public domain", "public-domain", "the public domain", 0.8),
    ("all rights reserved", "proprietary", "all rights reserved", 0.4),
    ("(?:proprietary|confidential) and (?:proprietary|confidential)", "proprietary", " and ", 0.6,
     ("proprietary and ", "confidential and ")),
    ("cc0(?: 1 0)?(?: universal)?", "cc0-1.0", "cc0", 1.0),
)


@dataclass(frozen=True)
class Rule:
    """A signature: a pattern over words, its keyword, label and weight, and
    the stems of which each match holds one (none: the keyword alone)."""
    pattern: str
    keyword: str
    label: str
    weight: float
    stems: tuple[str, ...] = ()


def signature_rules() -> list[Rule]:
    """All rules in order of priority (first wins between equal intervals)."""
    out: list[Rule] = []
    grant = r"(?:licensed|released|distributed|available|provided|published|covered|made available) under (?:the )?(?:terms (?:and conditions )?of )?(?:the )?"
    for ident, names, versions in FAMILIES:
        key = lambda name: name.split()[-1] if name.split()[-1] not in ("public", "software") else name.split()[0]
        spdx = ident.replace("-", " ")
        for v in versions:
            label = f"{ident}-{v.replace(' ', '.') if ' ' in v else v + '.0'}"
            loose = v + ("(?: 0)?" if " " not in v else "")
            out.append(Rule(rf"spdx license identifier {spdx} {loose}(?: only| or later)?", spdx.split()[0], label, 1.0, NAMED))
            for name in names:
                out.append(Rule(rf"{grant}{name} (?:licen[cs]e )?(?:version |v )?{loose}(?: or (?:any )?later(?: version)?)?", key(name), label, 1.0, GRANTED))
                out.append(Rule(rf"{name} licen[cs]e (?:version |v )?{loose}(?: or (?:any )?later(?: version)?)?", key(name), label, 0.9, NAMED))
        out.append(Rule(rf"spdx license identifier {spdx}", spdx.split()[0], ident, 1.0, NAMED))
        for name in names:
            out.append(Rule(rf"{grant}{name}(?: style)? licen[cs]es?", key(name), ident, 0.9, NAMED))
            out.append(Rule(rf"licen[cs]e {name}", key(name), ident, 0.6, NAMED))
            out.append(Rule(rf"{name}(?: style)? licen[cs]es?", key(name), ident, 0.7, NAMED))
    for element, names in CC_ELEMENTS:
        for name in names:
            for v in CC_VERSIONS:
                label = f"cc-{element}-{v.replace(' ', '.')}"
                out.append(Rule(rf"(?:{grant})?(?:a )?(?:cc|creative commons) {name} (?:licen[cs]e )?(?:v |version )?{v}(?: international| unported| generic)?(?: licen[cs]e)?", name, label, 1.0, COMMONS))
            out.append(Rule(rf"(?:{grant})?(?:a )?(?:cc|creative commons) {name}(?: licen[cs]e)?", name, f"cc-{element}", 0.8, COMMONS))
        for v in CC_VERSIONS:
            out.append(Rule(rf"creativecommons org licenses {element.replace('-', ' ')} {v}", "creativecommons", f"cc-{element}-{v.replace(' ', '.')}", 1.0, NAMED))
    out += [Rule(pattern, keyword, label, weight, *stems) for pattern, label, keyword, weight, *stems in TEXTS]
    return out


def _stems(rules: list[Rule]) -> list[tuple[str, ...]]:
    """The distinct stems of the rules."""
    return sorted({r.stems or (r.keyword,) for r in rules})


def _literal(rules: list[Rule]) -> Column:
    """The rules as one constant (Catalyst folds the parsing of it)."""
    number = {stems: i for i, stems in enumerate(_stems(rules))}
    rows = [{"p": rf"(?<= )(?:{r.pattern})(?= )", "k": r.keyword, "g": number[r.stems or (r.keyword,)], "l": r.label, "w": r.weight, "o": i}
            for i, r in enumerate(rules)]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<p:string,k:string,g:int,l:string,w:double,o:int>>")


def _places(padded: Column, rule: Column) -> Column:
    """Intervals [s, e] of words that a rule's matches cover (none: empty)."""
    def marks(words):
        return F.zip_with(
            F.filter(F.transform(words, lambda w, i: F.when(F.startswith(w, F.lit("\x01")), i)), lambda i: i.isNotNull()),
            F.filter(F.transform(words, lambda w, i: F.when(F.endswith(w, F.lit("\x02")), i)), lambda i: i.isNotNull()),
            lambda s, e: F.struct(s.alias("s"), e.alias("e"), rule["o"].alias("o"), rule["l"].alias("l"), rule["w"].alias("w")))
    marked = F.regexp_replace(padded, rule["p"], F.lit("\x01$0\x02"))
    return let(marked, lambda m: F.when(F.instr(m, "\x01") > 0, marks(F.split(F.trim(m), " "))))


def _resolve(found: Column) -> Column:
    """Intervals that no other one contains, in order of their start."""
    ordered = F.sort_array(F.transform(found, lambda x: F.struct(
        x["s"].alias("s"), (-x["e"]).alias("ne"), x["o"].alias("o"), x["e"].alias("e"), x["l"].alias("l"), x["w"].alias("w"))))
    longest = let(ordered, lambda a: F.filter(a, lambda x, i: (i == 0) | (F.get(a, i - 1)["s"] != x["s"])))
    back = F.sequence(F.lit(1), F.lit(MAX_WORDS))
    return let(longest, lambda a: F.filter(a, lambda x, i: ~F.exists(
        back, lambda j: F.coalesce(F.get(a, i - j)["e"] >= x["e"], F.lit(False)))))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_words``, ``base`` (array of label, s) and
    ``detections`` (array of s, e, label, weight; words from 0)."""
    rules, base = signature_rules(), [Rule(p, p.split()[0], label, 0.7, NAMED) for p, label in BASE]
    raw = text_of(text)
    lowered = F.translate(raw, UPPER, LOWER)
    padded = F.concat(F.lit(" "), F.trim(F.regexp_replace(lowered, GAP, " ")), F.lit(" "))

    def hits(p, some):
        present = F.array(*[functools.reduce(Column.__or__, [F.contains(p, F.lit(x)) for x in stems]) for stems in _stems(some)])
        return let(present, lambda there: F.when(F.array_contains(there, F.lit(True)), F.flatten(F.filter(F.transform(
            F.filter(_literal(some), lambda r: F.get(there, r["g"]) & F.contains(p, r["k"])), lambda r: _places(p, r)),
            lambda x: x.isNotNull()))))

    return docs.withColumns({
        "n_words": F.regexp_count(raw, F.lit(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")).cast("long"),
        "_padded": padded,
    }).withColumns({
        "base": F.sort_array(let(F.col("_padded"), lambda p: hits(p, base))),
        "detections": _resolve(let(F.col("_padded"), lambda p: hits(p, rules))),
    }).drop("_padded")


def digest(docs: DataFrame) -> DataFrame:
    """The contract's columns, then the number of resolved detections."""
    found = scan(docs.select("doc_id", "text"))
    base, more = F.col("base"), F.col("detections")
    none = F.array().cast("array<string>")

    def labels(column):
        return F.coalesce(F.transform(column, lambda x: x["l"]), none)

    return found.select(
        "doc_id", "n_words", F.coalesce(F.size(F.when(base.isNotNull(), base)), F.lit(0)).cast("long").alias("n_base"),
        F.get(base, F.lit(0))["s"].cast("long").alias("first_word"),
        F.array_max(F.transform(base, lambda x: x["s"])).cast("long").alias("last_word"),
        F.array_join(F.sort_array(F.array_distinct(labels(base))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_distinct(F.concat(labels(base), labels(more)))), ",").alias("labels"),
        F.greatest(F.coalesce(F.array_max(F.transform(more, lambda x: x["w"])), F.lit(0.0)),
                   F.when(F.size(base) > 0, F.lit(0.7)).otherwise(F.lit(0.0))).alias("score"),
        F.greatest(F.coalesce(F.size(more), F.lit(0)), F.lit(0)).cast("long").alias("n_detections"))
