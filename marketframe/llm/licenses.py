"""License scan: ordered signature rules behind a keyword prefilter.

Native: DataFrame expressions only. Texts without any keyword are done after one pass. Elsewhere a rule runs only if
its keyword occurs; each match is a span of words with a priority, and a span inside another one is
suppressed by it if the other has a better priority, or the same one and more words.

Texts are scanned in blocks of 512 words with 64 more on both sides, more than any rule spans: a
block owns the spans that start in it, so work grows with the text and not with the square of its matches.
"""

from __future__ import annotations

import string
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import own_columns


class Rule(NamedTuple):
    priority: int
    label: str
    pattern: str  # over lower-case words with one space before each
    keyword: str  # occurs in every match
    weight: float


#: Phrases that always count, with their labels (fixed values).
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

_V1, _V2, _V3 = "(?: version)?(?: v?1)(?: 0)?", "(?: version)?(?: v?2)(?: 0)?", "(?: version)?(?: v?3)(?: 0)?"

#: label, name as a pattern, keyword, identifier as a pattern.
FAMILIES = (
    ("agpl-3.0", f"(?:gnu )?affero general public license{_V3}", "affero", "agpl 3 0(?: only| or later)?"),
    ("agpl-1.0", f"affero general public license{_V1}", "affero", "agpl 1 0(?: only| or later)?"),
    ("gpl-3.0", f"(?:gnu )?general public license{_V3}", "general public", "gpl 3 0(?: only| or later)?"),
    ("gpl-2.0", f"(?:gnu )?general public license{_V2}", "general public", "gpl 2 0(?: only| or later)?"),
    ("gpl-1.0", f"(?:gnu )?general public license{_V1}", "general public", "gpl 1 0(?: only| or later)?"),
    ("lgpl-3.0", f"(?:gnu )?(?:lesser|library) general public license{_V3}", "general public", "lgpl 3 0(?: only| or later)?"),
    ("lgpl-2.1", "(?:gnu )?(?:lesser|library) general public license(?: version)? v?2 1", "general public", "lgpl 2 1(?: only| or later)?"),
    ("lgpl-2.0", f"(?:gnu )?(?:lesser|library) general public license{_V2}", "general public", "lgpl 2 0(?: only| or later)?"),
    ("gfdl-1.3", "(?:gnu )?free documentation license(?: version)? v?1 3", "free documentation", "gfdl 1 3(?: only| or later)?"),
    ("gfdl-1.2", "(?:gnu )?free documentation license(?: version)? v?1 2", "free documentation", "gfdl 1 2(?: only| or later)?"),
    ("apache-2.0", f"apache (?:software )?license{_V2}", "apache", "apache 2 0"),
    ("apache-1.1", "apache (?:software )?license(?: version)? v?1 1", "apache", "apache 1 1"),
    ("apache-1.0", "apache (?:software )?license(?: version)? v?1 0", "apache", "apache 1 0"),
    ("bsd-2-clause", "(?:simplified bsd|bsd 2 clause|2 clause bsd|freebsd|two clause bsd)(?: license)?", "bsd", "bsd 2 clause"),
    ("bsd-3-clause", "(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)(?: license)?", "bsd", "bsd 3 clause"),
    ("bsd-4-clause", "(?:original bsd|bsd 4 clause|4 clause bsd|old bsd)(?: license)?", "bsd", "bsd 4 clause"),
    ("0bsd", "(?:zero clause bsd|bsd zero clause)(?: license)?", "bsd", "0bsd"),
    ("mit-0", "mit no attribution(?: license)?", "mit no attribution", "mit 0"),
    ("mit", "(?:mit|expat|x11) license", "licen", "mit"),
    ("isc", "isc license", "isc", "isc"),
    ("mpl-2.0", f"mozilla public license{_V2}", "mozilla public", "mpl 2 0"),
    ("mpl-1.1", "mozilla public license(?: version)? v?1 1", "mozilla public", "mpl 1 1"),
    ("mpl-1.0", "mozilla public license(?: version)? v?1 0", "mozilla public", "mpl 1 0"),
    ("epl-2.0", f"eclipse public license{_V2}", "eclipse public", "epl 2 0"),
    ("epl-1.0", f"eclipse public license{_V1}", "eclipse public", "epl 1 0"),
    ("edl-1.0", f"eclipse distribution license{_V1}", "eclipse distribution", "edl 1 0"),
    ("cddl-1.1", "common development and distribution license(?: version)? v?1 1", "common development", "cddl 1 1"),
    ("cddl-1.0", f"common development and distribution license{_V1}", "common development", "cddl 1 0"),
    ("cpl-1.0", f"common public license{_V1}", "common public", "cpl 1 0"),
    ("eupl-1.2", "european union public licen[cs]e(?: version)? v?1 2", "european union", "eupl 1 2"),
    ("eupl-1.1", "european union public licen[cs]e(?: version)? v?1 1", "european union", "eupl 1 1"),
    ("osl-3.0", f"open software license{_V3}", "open software", "osl 3 0"),
    ("afl-3.0", f"academic free license{_V3}", "academic free", "afl 3 0"),
    ("afl-2.1", "academic free license(?: version)? v?2 1", "academic free", "afl 2 1"),
    ("artistic-2.0", f"artistic license{_V2}", "artistic", "artistic 2 0"),
    ("artistic-1.0", f"artistic license{_V1}", "artistic", "artistic 1 0"),
    ("bsl-1.0", f"boost software license{_V1}", "boost software", "bsl 1 0"),
    ("busl-1.1", "business source license(?: version)? v?1 1", "business source", "busl 1 1"),
    ("zlib", "zlib(?: libpng)? license", "zlib", "zlib"),
    ("libpng", "libpng license", "libpng", "libpng(?: 2 0)?"),
    ("unlicense", "(?:the unlicense|unlicense org)", "unlicen", "unlicense"),
    ("wtfpl", "do what the fuck you want to public license", "want to public", "wtfpl"),
    ("cc0-1.0", "(?:cc0|cc zero)(?: 1 0)?(?: universal)?(?: license| public domain dedication)?", "cc", "cc0 1 0"),
    ("psf-2.0", f"python software foundation license{_V2}", "python software", "(?:psf|python) 2 0"),
    ("php-3.01", "php license(?: version)? v?3 01", "php", "php 3 01"),
    ("php-3.0", "php license(?: version)? v?3 0", "php", "php 3 0"),
    ("ruby", "ruby license", "ruby", "ruby"),
    ("ofl-1.1", "(?:sil )?open font license(?: version)? v?1 1", "open font", "ofl 1 1"),
    ("ofl-1.0", f"(?:sil )?open font license{_V1}", "open font", "ofl 1 0"),
    ("ms-pl", "microsoft public license", "microsoft public", "ms pl"),
    ("ms-rl", "microsoft reciprocal license", "microsoft reciprocal", "ms rl"),
    ("odbl-1.0", f"open (?:data commons open )?database license{_V1}", "database", "odbl 1 0"),
    ("odc-by-1.0", f"open data commons attribution license{_V1}", "data commons", "odc by 1 0"),
    ("pddl-1.0", f"public domain dedication and license{_V1}", "dedication and", "pddl 1 0"),
    ("postgresql", "postgresql licen[cs]e", "postgresql", "postgresql"),
    ("openssl", "openssl license", "openssl", "openssl"),
    ("ssleay", "ssleay license", "ssleay", "ssleay"),
    ("ncsa", "university of illinois (?:ncsa )?open source license", "illinois", "ncsa"),
    ("upl-1.0", f"universal permissive license{_V1}", "universal permissive", "upl 1 0"),
    ("vim", "vim license", "vim", "vim"),
    ("w3c", "w3c software (?:notice and )?license", "w3c", "w3c"),
    ("sspl-1.0", f"server side public license{_V1}", "server side", "sspl 1 0"),
    ("elastic-2.0", f"elastic license{_V2}", "elastic", "elastic 2 0"),
    ("blueoak-1.0.0", "blue oak model license(?: 1 0 0)?", "blue oak", "blueoak 1 0 0"),
)

#: Names without a version: label, name as a pattern, keyword. A name with one is longer and suppresses it.
UNVERSIONED = (
    ("agpl", "(?:gnu )?affero general public license", "affero"),
    ("gpl", "(?:gnu )?general public license", "general public"),
    ("lgpl", "(?:gnu )?(?:lesser|library) general public license", "general public"),
    ("gfdl", "(?:gnu )?free documentation license", "free documentation"),
    ("apache", "apache (?:software )?license", "apache"),
    ("bsd", "bsd(?: style)? license", "bsd"),
    ("mpl", "mozilla public license", "mozilla public"),
    ("epl", "eclipse public license", "eclipse public"),
    ("edl", "eclipse distribution license", "eclipse distribution"),
    ("cddl", "common development and distribution license", "common development"),
    ("cpl", "common public license", "common public"),
    ("eupl", "european union public license", "european union"),
    ("osl", "open software license", "open software"),
    ("afl", "academic free license", "academic free"),
    ("artistic", "artistic license", "artistic"),
    ("bsl", "boost software license", "boost software"),
    ("busl", "business source license", "business source"),
    ("psf", "python software foundation license", "python software"),
    ("php", "php license", "php"),
    ("ofl", "(?:sil )?open font license", "open font"),
    ("odbl", "open (?:data commons open )?database license", "database"),
    ("upl", "universal permissive license", "universal permissive"),
    ("sspl", "server side public license", "server side"),
    ("elastic", "elastic license", "elastic"),
)

#: Short forms with a version: label, form as a pattern, keyword.
SHORT = (
    ("agpl-3.0", "(?:gnu )?agpl ?v?3(?: 0)?(?: only| or later)?", "agpl"),
    ("gpl-3.0", "(?:gnu )?gpl ?v?3(?: 0)?(?: only| or later)?", "gpl"),
    ("gpl-2.0", "(?:gnu )?gpl ?v?2(?: 0)?(?: only| or later)?", "gpl"),
    ("gpl-1.0", "(?:gnu )?gpl ?v?1(?: 0)?(?: only| or later)?", "gpl"),
    ("lgpl-3.0", "(?:gnu )?lgpl ?v?3(?: 0)?(?: only| or later)?", "lgpl"),
    ("lgpl-2.1", "(?:gnu )?lgpl ?v?2 1(?: only| or later)?", "lgpl"),
    ("lgpl-2.0", "(?:gnu )?lgpl ?v?2(?: 0)?(?: only| or later)?", "lgpl"),
    ("mpl-2.0", "mpl ?v?2(?: 0)?", "mpl"),
    ("mpl-1.1", "mpl ?v?1 1", "mpl"),
    ("epl-2.0", "epl ?v?2(?: 0)?", "epl"),
    ("epl-1.0", "epl ?v?1(?: 0)?", "epl"),
)

#: Sentences that stand for a license: label, pattern, keyword.
SENTENCES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby granted"),
    ("mit", "the software is provided as is without warranty of any kind express or implied", "without warranty"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose", "permission to use"),
    ("bsd", "redistributions? (?:and use )?in source and binary forms with or without modification", "redistribution"),
    ("bsd", "redistributions of source code must retain the above copyright notice", "redistribution"),
    ("bsd-3-clause", "neither the name of (?:[^ ]+ ){1,12}nor the names of its contributors", "neither the name"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software", "advertising materials"),
    ("gpl", "this program is free software you can redistribute it and or modify it", "free software"),
    ("gpl", "you should have received a copy of the gnu general public license", "general public"),
    ("lgpl", "you should have received a copy of the gnu lesser general public license", "lesser general"),
    ("agpl", "you should have received a copy of the gnu affero general public license", "affero"),
    ("gpl", "either version [0-9]+ of the license or at your option any later version", "later version"),
    ("apache", "you may not use this file except in compliance with the license", "in compliance"),
    ("apache", "distributed on an as is basis without warranties or conditions of any kind", "as is basis"),
    ("apache-2.0", "www apache org licenses license 2 0", "apache org"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license", "mozilla public"),
    ("mpl-1.1", "the contents of this file are subject to the mozilla public license", "mozilla public"),
    ("epl-1.0", "this program and the accompanying materials are made available under the terms", "accompanying materials"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("public-domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain", "public domain"),
    ("public-domain", "this (?:work|file|software|code) is in the public domain", "public domain"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event", "in no event"),
    ("bsl-1.0", "boost org license 1 0", "boost org"),
    ("wtfpl", "you just do what the fuck you want to", "you just do"),
    ("proprietary", "all rights reserved", "all rights reserved"),
    ("proprietary", "proprietary and confidential", "proprietary"),
    ("proprietary", "may not be (?:copied|reproduced|redistributed)(?: [^ ]+){0,8} without (?:the )?(?:prior |express )?(?:written )?permission", "may not be"),
    ("notice", "this (?:work|project|file|software) is licensed under", "licensed under"),
    ("notice", "see the license file", "license file"),
    ("notice", "copyright (?:c )?(?:19|20)[0-9][0-9]", "copyright"),
)

_CC = ("by", "by sa", "by nd", "by nc", "by nc sa", "by nc nd")
_CC_WORDS = {"by": "attribution", "sa": "share ?alike", "nd": "no ?deriv(?:ative|ative work)s", "nc": "non ?commercial"}


def _spelled(name: str) -> str:
    return name.replace("licen[cs]e", "license").replace("license", "licen[cs]e")


def rules() -> list[Rule]:
    """All rules in order: identifiers, sentences, license notices, then plain names, each in both spellings of license."""
    under = "(?:licen[cs]ed|released|distributed|available) under (?:the )?(?:terms of (?:the )?)?"
    out = []
    for label, name, keyword in UNVERSIONED + SHORT:
        name = _spelled(name)
        out.append(Rule(2, label, f" {under}{name}", keyword, 0.95))
        out.append(Rule(3, label, f" {name}", keyword, 0.8))
    for label, name, keyword, spdx in FAMILIES:
        name = _spelled(name)
        out.append(Rule(3, label, f" licen[cs]es? {spdx}", "licen", 0.8))
        out.append(Rule(0, label, f" spdx license identifiers? {spdx}", "spdx", 1.0))
        out.append(Rule(2, label, f" {under}{name}", "under", 0.95))
        out.append(Rule(3, label, f" {name}", keyword, 0.8))
    for label, sentence, keyword in SENTENCES:
        weak = label == "notice"
        out.append(Rule(4 if weak else 1, label, f" {sentence}", keyword, 0.5 if weak else 0.95))
    for kind in _CC:
        parts = kind.split(" ")
        words = " ".join(_CC_WORDS[p] for p in parts)
        for version in ("4", "3", "2 5", "2", "1"):
            label = f"cc-{kind.replace(' ', '-')}-{version.replace(' ', '.') if ' ' in version else version + '.0'}"
            number = version if " " in version else f"{version}(?: 0)?"
            out.append(Rule(2, label, f" cc {kind} v?{number}", "cc by", 0.95))
            out.append(Rule(2, label, f" creative commons {words}(?: license)?(?: version)? v?{number}", "creative commons", 0.95))
        out.append(Rule(3, f"cc-{kind.replace(' ', '-')}", f" cc {kind}", "cc by", 0.8))
    return out


#: Word beginnings of which every match of a rule has one, so a text without them matches no rule.
PREFILTER = ("licen", "unlicen", "copyright", "public domain", "bsd", "freebsd", "cc by", "cc0", "cc zero", "creative commons", "redistribut",
             "warrant", "hereby granted", "permission", "all rights reserved", "proprietary", "advertising materials", "neither the name",
             "free software", "later version", "mit no attribution", "in compliance", "as is basis", "accompanying materials", "this is free", "unencumbered",
             "source code form", "apache org", "boost org", "in no event", "you just do",
             "gnu gpl", "gnu lgpl", "gnu agpl", "gpl", "lgpl", "agpl", "mpl", "epl")
_GATE = f" (?:{'|'.join(x.replace(' ', ' +') for x in PREFILTER)})"

_SEPARATORS = "".join(map(chr, range(128))).translate({ord(c): None for c in string.ascii_letters + string.digits})


def worded(text: Column) -> Column:
    """Lower-case words with spaces before each: A-Z become a-z, other ASCII signs become spaces."""
    return F.concat(F.lit(" "), F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase + _SEPARATORS, string.ascii_lowercase + " " * len(_SEPARATORS)))


def _spaces(x: Column) -> Column:
    return F.length(x) - F.length(F.replace(x, F.lit(" "), F.lit("")))


def _starts(words: Column, pattern: Column) -> Column:
    """(start, end) in words of each match; words and matches have one space before each word."""
    steps = F.arrays_zip(F.split(words, pattern, -1).alias("gap"), F.regexp_extract_all(words, pattern, F.lit(0)).alias("hit"))
    kind = "array<struct<start:int,end:int>>"

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + _spaces(x["gap"])
        end = start + F.coalesce(_spaces(x["hit"]), F.lit(0))
        found = F.array(F.struct(start.alias("start"), end.alias("end"))).cast(kind)
        return F.struct(end.alias("at"), F.when(x["hit"].isNull(), acc["found"]).otherwise(F.concat(acc["found"], found)).alias("found"))

    return F.aggregate(steps, F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("found")), step, lambda acc: acc["found"])


#: Words of a block, and words around it that its matches may reach into; every rule spans fewer.
BLOCK, MARGIN = 512, 64


def _blocks(words: Column, n_words: Column) -> Column:
    """Blocks of a text of single-spaced words: its first word, the first and the end of the words it owns, and its words."""
    def block(split: Column):
        def made(i: Column) -> Column:
            first = F.greatest(i * BLOCK - MARGIN, F.lit(0))
            text = F.concat(F.lit(" "), F.array_join(F.slice(split, first + 1, F.lit(BLOCK + 2 * MARGIN)), " "), F.lit(" "))
            return F.struct(first.alias("first"), (i * BLOCK).alias("low"), ((i + 1) * BLOCK).alias("high"),
                            F.when(n_words <= BLOCK, words).otherwise(text).alias("words"))
        return made

    last = F.floor(F.greatest(n_words - 1, F.lit(0)) / BLOCK).cast("int")
    split = F.when(n_words > BLOCK, F.split(F.trim(words), " "))
    return F.flatten(F.transform(F.array(split), lambda all_: F.transform(F.sequence(F.lit(0), last), block(all_))))


def _literal_rules() -> Column:
    return F.array(*[F.struct(
        F.lit(r.priority).alias("priority"), F.lit(r.label).alias("label"), F.lit(f"{r.pattern}(?= )").alias("pattern"),
        F.lit(r.keyword).alias("keyword"), F.lit(r.weight).alias("weight")) for r in rules()])


def _detections(words: Column) -> Column:
    """Spans of all rules whose keyword occurs in a block, less the suppressed ones."""
    due = F.filter(_literal_rules(), lambda r: F.contains(words, r["keyword"]) & F.regexp(words, r["pattern"]))
    spans = F.flatten(F.transform(due, lambda r: F.transform(_starts(words, r["pattern"]), lambda s: F.struct(
        s["start"].alias("start"), s["end"].alias("end"), r["priority"].alias("priority"), r["label"].alias("label"), r["weight"].alias("weight")))))

    def suppressed(s: Column, t: Column) -> Column:
        inside = (t["start"] <= s["start"]) & (s["end"] <= t["end"])
        longer = t["end"] - t["start"] > s["end"] - s["start"]
        return inside & ((t["priority"] < s["priority"]) | ((t["priority"] == s["priority"]) & longer))

    return F.transform(F.array(spans), lambda all_: F.filter(all_, lambda s: ~F.exists(all_, lambda t: suppressed(s, t))))[0]


def scan_licenses(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with n_words, base (start, end, label of each base phrase) and found (spans of the rules).

    Words are runs of letters, digits and non-ASCII characters, numbered from 0; ends are exclusive.
    A null or empty text has no words and empty arrays. Rows stay as they come, with all their
    columns; new columns whose name is taken get a trailing underscore.
    """
    norm, n_words, base, found = own_columns(docs, "norm", "n_words", "base", "found")
    single = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.col(norm), " +", " ")), F.lit(" "))
    gate = F.col(norm).rlike(_GATE)

    def labelled(label: str):
        return lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.lit(label).alias("label"))

    def placed(block: Column, spans: Column) -> Column:
        """The spans that the block owns, numbered by the words of the text."""
        own = F.filter(spans, lambda s: (s["start"] + block["first"] >= block["low"]) & (s["start"] + block["first"] < block["high"]))
        return F.transform(own, lambda s: s.withField("start", s["start"] + block["first"]).withField("end", s["end"] + block["first"]))

    def detect(block: Column) -> Column:
        words = block["words"]
        parts = [F.transform(_starts(words, F.lit(f" {phrase}(?= )")), labelled(label)) for phrase, label in BASE]
        return F.struct(placed(block, F.concat(*parts)).alias("base"), placed(block, _detections(words)).alias("found"))

    name, = own_columns(docs, "detected")
    out = docs.withColumn(norm, worded(F.col(text))).withColumn(n_words, F.regexp_count(F.col(norm), F.lit("[^ ]+")).cast("long"))
    out = out.withColumn(name, F.when(gate, F.flatten(F.transform(F.array(single), lambda words: F.transform(_blocks(words, F.col(n_words)), detect))))).drop(norm)
    empty = (F.array().cast("array<struct<start:int,end:int,label:string>>"),
             F.array().cast("array<struct<start:int,end:int,priority:int,label:string,weight:double>>"))
    return out.withColumns({base: F.coalesce(F.flatten(F.col(name)["base"]), empty[0]), found: F.coalesce(F.flatten(F.col(name)["found"]), empty[1])}).drop(name)


def license_table(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score of every row."""
    rows = scan_licenses(docs.select("doc_id", "text"))

    def labels(*arrays: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.concat(*[F.transform(a, lambda s: s["label"]) for a in arrays]))), ",")

    starts = F.transform("base", lambda s: s["start"].cast("long"))
    weights = F.concat(F.transform("found", lambda s: s["weight"]), F.transform("base", lambda s: F.lit(0.8)), F.array(F.lit(0.0)))
    return rows.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        labels(F.col("base")).alias("base_labels"), labels(F.col("base"), F.col("found")).alias("labels"), F.array_max(weights).alias("score"))
