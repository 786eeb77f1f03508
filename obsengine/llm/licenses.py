"""License scans by ordered signature rules, in DataFrame operations.

A text becomes its words (A-Z in lower case) between single spaces.  Rules are regular
expressions over that form, each with a keyword, a priority, a label and a confidence.  Only
texts with some keyword are looked at, and only by the rules of keywords they contain.  Every
match is an interval of words.  A match is suppressed when an interval of the same or a higher
priority contains it; between equal intervals of one priority the first rule stays.

Plain phrases with labels of their own are always reported: every place where their words
stand one after the other.

Defined results: null and empty texts have no words, no places, no labels and score 0; rows
that repeat are each reported; labels come sorted, once each, joined by commas; the score is
the largest confidence of the matches that stay, phrases included.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from obsengine.llm.columns import row_digest

#: Phrases and their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
PHRASE_CONFIDENCE = 0.6

#: License families as label, keyword, and the wording of the name in words.  The
#: keyword is a word that every such name has.
FAMILIES = (
    ("gpl", "gnu", "gnu (?:general public license|gpl)"),
    ("gpl", "gpl", "gpl"),
    ("lgpl", "lesser", "(?:gnu )?lesser general public license"),
    ("lgpl", "lgpl", "(?:gnu )?lgpl"),
    ("agpl", "affero", "(?:gnu )?affero general public license"),
    ("agpl", "agpl", "(?:gnu )?agpl"),
    ("gfdl", "gnu", "gnu free documentation license"),
    ("apache", "apache", "apache(?: software)?(?: public)? license"),
    ("mit", "mit", "mit(?: x11)? license"),
    ("mit", "expat", "expat license"),
    ("bsd-2-clause", "bsd", "(?:simplified bsd|bsd 2 clause|2 clause bsd)(?: license)?"),
    ("bsd-3-clause", "bsd", "(?:new bsd|modified bsd|bsd 3 clause|3 clause bsd)(?: license)?"),
    ("bsd", "bsd", "bsd(?: style)? license"),
    ("cc-by", "cc", "cc by"),
    ("cc-by", "creative", "creative commons attribution"),
    ("cc-by-sa", "cc", "cc by sa"),
    ("cc-by-sa", "creative", "creative commons attribution share ?alike"),
    ("cc-by-nc", "cc", "cc by nc"),
    ("cc-by-nc", "creative", "creative commons attribution non ?commercial"),
    ("cc-by-nd", "cc", "cc by nd"),
    ("cc-by-nd", "creative", "creative commons attribution no derivatives"),
    ("cc-by-nc-sa", "cc", "cc by nc sa"),
    ("cc-by-nc-nd", "cc", "cc by nc nd"),
    ("cc0", "cc0", "cc0"),
    ("cc0", "creative", "creative commons zero"),
    ("bsd-3-clause", "bsd", "bsd 3"),
    ("bsd-2-clause", "bsd", "bsd 2"),
    ("mpl", "mozilla", "mozilla public license"),
    ("epl", "eclipse", "eclipse public license"),
    ("cddl", "cddl", "(?:common development and distribution license )?cddl"),
    ("isc", "isc", "isc license"),
    ("zlib", "zlib", "zlib(?: libpng)? license"),
    ("bsl", "boost", "boost software license"),
    ("artistic", "artistic", "artistic license"),
    ("unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl"),
    ("odbl", "odbl", "odbl"),
    ("odbl", "database", "open database license"),
    ("eupl", "eupl", "eupl"),
    ("psf", "python", "python software foundation license"),
    ("public-domain", "domain", "public domain"),
)

#: A version after a name, such as "version 2 0" or "v3".
_VERSION = "(?: (?:version|ver|v) ?([0-9]+)(?: ([0-9]+))?| ([0-9]+) ([0-9]+))"

#: Names that need words around them, as label, keyword and name.
SHORT_NAMES = (
    ("mit", "mit", "mit"),
    ("apache", "apache", "apache"),
    ("bsd", "bsd", "bsd"),
    ("isc", "isc", "isc"),
    ("mpl", "mpl", "mpl"),
    ("epl", "epl", "epl"),
)
#: Keywords that are common words, for which another word of the rule stands in.
COMMON = ("mit", "isc", "python", "database", "domain", "artistic", "lesser")

#: Names with their version in one word, or short names with a bare version, as
#: label, keyword and wording.
JOINED = (
    *(("gpl", f"gplv{v}", f"(?:gnu )?gplv{v}(?: [0-9])?") for v in (1, 2, 3)),
    *(("gpl", f"gpl{v}", f"(?:gnu )?gpl{v}(?: [0-9])?") for v in (1, 2, 3)),
    *(("lgpl", f"lgplv{v}", f"(?:gnu )?lgplv{v}(?: [0-9])?") for v in (2, 3)),
    *(("lgpl", f"lgpl{v}", f"(?:gnu )?lgpl{v}(?: [0-9])?") for v in (2, 3)),
    *(("agpl", f"agplv{v}", f"(?:gnu )?agplv{v}(?: [0-9])?") for v in (1, 3)),
    *(("agpl", f"agpl{v}", f"(?:gnu )?agpl{v}(?: [0-9])?") for v in (1, 3)),
    ("gpl", "gpl", "gpl [123](?: [0-9])?"),
    ("lgpl", "lgpl", "lgpl [23](?: [0-9])?"),
    ("agpl", "agpl", "agpl [13](?: [0-9])?"),
    ("apache", "apache", "apache (?:v(?:ersion)? ?)?[12] [01]"),
    ("apache", "apache", "apache 2 license"),
    ("apache", "apache2", "apache2"),
    ("apache", "asl", "asl (?:v(?:ersion)? ?)?[12] [01]"),
    ("apache", "apachev2", "apachev2(?: 0)?"),
    ("mpl", "mpl", "mpl (?:v(?:ersion)? ?)?[12] [01]"),
    ("mpl", "mplv2", "mplv2(?: 0)?"),
    ("mpl", "mpl2", "mpl2(?: 0)?"),
    ("epl", "epl", "epl (?:v(?:ersion)? ?)?[12] 0"),
    ("epl", "eplv2", "eplv2(?: 0)?"),
    ("epl", "eplv1", "eplv1(?: 0)?"),
    ("bsl", "bsl", "bsl 1 0"),
    ("artistic", "artistic", "artistic [12] 0"),
    ("bsd-2-clause", "bsd2", "bsd2(?: clause)?"),
    ("bsd-3-clause", "bsd3", "bsd3(?: clause)?"),
    ("zlib", "zlib", "zlib acknowledgement"),
    ("cc0", "cc0", "cc0 1 0"),
)

#: Sentences of license texts and of the notices put into files, written by hand
#: from those texts, as label, keyword and wording.  They need not name the license.
TEXTS = (
    # MIT, X11 and their relatives
    ("mit", "hereby", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", "sublicense", "to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    ("mit", "substantial", "permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "noninfringement", "merchantability fitness for a particular purpose and noninfringement in no event shall the (?:authors or copyright holders|x consortium) be liable"),
    ("mit-0", "sublicense", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided"),
    ("ncsa", "sublicense", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software"),
    # ISC and the notices it comes from
    ("isc", "hereby", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", "hereby", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above"),
    ("0bsd", "disclaims", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is and the author disclaims all warranties with regard to this software"),
    ("isc", "disclaims", "the software is provided as is and (?:the author|isc|internet systems consortium) disclaims all warranties with regard to this software"),
    ("hpnd", "permission", "permission to use copy modify and distribute this software and its documentation for any purpose"),
    # BSD
    ("bsd", "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", "redistributions", "redistributions of source code must retain the above copyright notice"),
    ("bsd", "redistributions", "redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", "endorse", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd-4-clause", "acknowledgement", "all advertising materials mentioning features or use of this software must display the following acknowledgement"),
    ("bsd", "disclaimed", "the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("bsd", "bsd", "(?:use of this source code is )?governed by a bsd style license"),
    # GPL family
    ("gpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("agpl", "redistribute", "you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("gpl", "gnu", "you should have received a copy of the gnu general public license"),
    ("lgpl", "gnu", "you should have received a copy of the gnu (?:lesser|library) general public license"),
    ("agpl", "affero", "you should have received a copy of the gnu affero general public license"),
    ("lgpl", "gnu", "gnu library general public license"),
    ("gpl", "copyleft", "the gnu general public license is a free copyleft license"),
    ("gpl", "freedom", "the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl", "verbatim", "you may copy and distribute verbatim copies of the program s source code as you receive it"),
    ("gpl", "verbatim", "you may convey verbatim copies of the program s source code as you receive it"),
    ("lgpl", "verbatim", "you may copy and distribute verbatim copies of the library s complete source code as you receive it"),
    ("agpl", "interacting", "your modified version must prominently offer all users interacting with it remotely through a computer network"),
    ("gfdl", "invariant", "with no invariant sections no front cover texts and no back cover texts"),
    ("gfdl", "gnu", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    # Apache
    ("apache", "apache", "licensed to the apache software foundation asf under one or more contributor license agreements"),
    ("apache", "compliance", "you may not use this file except in compliance with the license you may obtain a copy of the license at(?: https?)? www apache org"),
    ("apache", "apache", "www apache org licenses license 2 0"),
    ("apache", "irrevocable", "hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license to reproduce prepare derivative works"),
    # Mozilla, Eclipse, Sun
    ("mpl", "mozilla", "this source code form is subject to the terms of the mozilla public license"),
    ("mpl", "mpl", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl", "mozilla", "the contents of this file are subject to the mozilla public license"),
    ("epl", "eclipse", "this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("epl", "agreement", "the accompanying program is provided under the terms of this eclipse public license agreement"),
    ("cddl", "distribution", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("cpl", "accompanying", "the accompanying program is provided under the terms of this common public license"),
    # Others
    ("zlib", "implied", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("zlib", "altered", "altered source versions must be plainly marked as such and must not be misrepresented"),
    ("zlib", "misrepresented", "the origin of this software must not be misrepresented"),
    ("bsl", "boost", "distributed under the boost software license"),
    ("bsl", "organization", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "fuck", "do what the fuck you want to public license"),
    ("wtfpl", "fuck", "you just do what the fuck you want to"),
    ("cc0", "waived", "has waived all copyright and related or neighboring rights to this work"),
    ("cc-by", "creativecommons", "creativecommons org licenses by [1-4] [0-9]"),
    ("cc-by-sa", "creativecommons", "creativecommons org licenses by sa [1-4] [0-9]"),
    ("cc-by-nc", "creativecommons", "creativecommons org licenses by nc [1-4] [0-9]"),
    ("cc-by-nd", "creativecommons", "creativecommons org licenses by nd [1-4] [0-9]"),
    ("cc-by-nc-sa", "creativecommons", "creativecommons org licenses by nc sa [1-4] [0-9]"),
    ("cc-by-nc-nd", "creativecommons", "creativecommons org licenses by nc nd [1-4] [0-9]"),
    ("cc0", "creativecommons", "creativecommons org publicdomain zero 1 0"),
    ("artistic", "package", "the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic", "perl", "(?:free software )?you can redistribute it and or modify it under the same terms as perl itself"),
    ("psf", "python", "psf is making python available to licensee on an as is basis"),
    ("ofl", "font", "sil open font license"),
    ("ofl", "font", "this font software is licensed under the sil open font license"),
    ("eupl", "eupl", "licensed under the eupl"),
    ("beerware", "beer", "the beer ware license"),
    ("beerware", "beerware", "beerware license"),
    ("openssl", "openssl", "this product includes software developed by the openssl project"),
    ("public-domain", "domain", "(?:has been|is hereby|is) (?:placed|released|dedicated) (?:in|into|to) the public domain"),
    ("proprietary", "prohibited", "unauthorized (?:copying|use|reproduction)(?: or distribution)? of this (?:file|software|program)(?: via any medium)? is strictly prohibited"),
)

#: Wordings before a name: priority, confidence, their keyword, their words.
WORDINGS = (
    (1, 0.98, "spdx", "spdx license identifier "),
    (2, 0.95, "licensed", "licensed under(?: the)?(?: terms of the)? "),
    (2, 0.95, "released", "released under(?: the)?(?: terms of the)? "),
    (2, 0.95, "distributed", "distributed under(?: the)?(?: terms of the)? "),
    (2, 0.90, "available", "available under(?: the)?(?: terms of the)? "),
    (2, 0.90, "published", "published under(?: the)?(?: terms of the)? "),
    (2, 0.85, "governed", "governed by(?: the)?(?: terms of the)? "),
)


@dataclass(frozen=True)
class Rule:
    """One signature; ``pattern`` starts with a space and looks ahead for the last one."""

    number: int
    priority: int
    keyword: str
    label: str
    confidence: float
    pattern: str


def rules() -> list[Rule]:
    """Every wording before every name, full names alone, joined forms and sentences, in order."""
    found: list[Rule] = []

    def add(priority: int, keyword: str, label: str, confidence: float, words: str) -> None:
        found.append(Rule(len(found), priority, keyword, label, confidence, f" {words}(?= )"))

    for label, keyword, name in FAMILIES + SHORT_NAMES:
        for priority, confidence, verb, before in WORDINGS:
            word = verb if keyword in COMMON else keyword
            add(priority, word, label, confidence, f"{before}{name}(?: license)?{_VERSION}?")
    for label, keyword, name in FAMILIES:
        word = "license" if keyword in COMMON and "license" in name else keyword
        add(3, word, label, 0.8, f"{name}{_VERSION}")
        add(4, word, label, PHRASE_CONFIDENCE, name)
    for label, keyword, words in JOINED:
        add(3, keyword, label, 0.8, words)
    for label, keyword, words in TEXTS:
        add(2, keyword, label, 0.9, words)
    for keyword, words in (("rights", "all rights reserved"), ("proprietary", "proprietary license")):
        add(4, keyword, "proprietary", 0.5, words)
    return found


#: A run of characters that are no word; words are the rest once A-Z is in lower case.
_WORD = "[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
_ANY_CASE_WORD = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _gate(text: Column, words: list[str]) -> Column:
    """Whether a text has one of the words, in any case of A-Z."""
    inside = "[0-9A-Za-z\\x{80}-\\x{10FFFF}]"
    return text.rlike(f"(?i)(?<!{inside})(?:{'|'.join(sorted(words))})(?!{inside})")


def _phrase_keyword(phrase: str) -> str:
    words = phrase.split()
    return words[-1] if words[0] in COMMON else words[0]


def scan(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    ruleset: list[Rule] | None = None,
    phrases: dict[str, str] | None = None,
) -> DataFrame:
    """Places in the texts of ``docs`` that have a keyword: one row a match that stays.

    Columns: ``row`` (a digest of key and text; rows that are equal are scanned once), ``kind``
    (``phrase`` or ``rule``), ``label``, ``first`` and ``last`` (words from 0), ``confidence``.
    """
    spark = docs.sparkSession
    ruleset = rules() if ruleset is None else ruleset
    phrases = PHRASES if phrases is None else phrases
    keywords = sorted({r.keyword for r in ruleset} | {_phrase_keyword(p) for p in phrases})
    seen = docs.where(_gate(F.col(text), keywords)).select(
        row_digest(key, text).alias("row"), F.col(text).alias("text")
    )
    words = F.regexp_extract_all(
        F.translate("text", _UPPER, _LOWER), F.lit(_WORD), F.lit(0)
    )
    seen = (
        seen.select("row", words.alias("words"))
        .dropDuplicates(["row"])
        .select("row", "words", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")).alias("line"))
    )
    phrase_rows = [
        (-1 - i, 9, _phrase_keyword(p), label, PHRASE_CONFIDENCE, f" {p}(?= )")
        for i, (p, label) in enumerate(phrases.items())
    ]
    rule_rows = [(r.number, r.priority, r.keyword, r.label, r.confidence, r.pattern) for r in ruleset]
    table = spark.createDataFrame(
        phrase_rows + rule_rows,
        "number int, priority int, keyword string, label string, confidence double, pattern string",
    )
    hits = seen.select(
        "row",
        "line",
        F.explode(
            F.array_intersect("words", F.array(*(F.lit(k) for k in keywords)))
        ).alias("keyword"),
    ).join(F.broadcast(table), "keyword")  # a fixed number of rules
    parts = F.split(F.col("line"), F.col("pattern"))
    found = F.regexp_extract_all(F.col("line"), F.col("pattern"), F.lit(0))
    pieces = (
        hits.where(F.expr("line rlike pattern"))
        .select(
            "row", "number", "priority", "label", "confidence",
            F.transform(parts, _spaces).alias("gaps"), F.transform(found, _spaces).alias("sizes"),
        )
        .select(
            "row", "number", "priority", "label", "confidence",
            F.posexplode(F.arrays_zip("gaps", "sizes")).alias("at", "piece"),
        )
        .select("row", "number", "priority", "label", "confidence", "at", "piece.gaps", "piece.sizes")
    )
    upto = Window.partitionBy("row", "number").orderBy("at")
    # What lies before a match: all gaps up to it and all matches before it.
    before = F.sum("gaps").over(upto) + F.coalesce(
        F.sum("sizes").over(upto.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    places = pieces.withColumn("first", before).where("sizes is not null")
    places = places.select(
        "row", "number", "priority", "label", "confidence", "first",
        (F.col("first") + F.col("sizes") - 1).alias("last"),
    )
    levels = sorted({r.priority for r in ruleset})
    order = Window.partitionBy("row").orderBy("first", F.desc("last"), "priority", "number")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    covered = F.lit(None).cast("long")
    for level in levels:
        reach = F.max(F.when(F.col("priority") <= level, F.col("last"))).over(earlier)
        covered = F.when(F.col("priority") == level, reach).otherwise(covered)
    kept = (
        places.where("number >= 0")
        .withColumn("covered", covered)
        .where("covered is null or covered < last")
        .select("row", F.lit("rule").alias("kind"), "label", "first", "last", "confidence")
    )
    plain = places.where("number < 0").select(
        "row", F.lit("phrase").alias("kind"), "label", "first", "last", "confidence"
    )
    return kept.union(plain)


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(_ANY_CASE_WORD)), F.lit(0)).cast("long")


def summarise(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: words, phrase places, labels and score."""
    phrase = F.col("kind") == "phrase"
    per_row = scan(docs, key, text).groupBy("row").agg(
        F.count(F.when(phrase, 1)).alias("n_base"),
        F.min(F.when(phrase, F.col("first"))).cast("long").alias("first_word"),
        F.max(F.when(phrase, F.col("first"))).cast("long").alias("last_word"),
        _joined(F.collect_set(F.when(phrase, F.col("label")))).alias("base_labels"),
        _joined(F.collect_set("label")).alias("labels"),
        F.max("confidence").alias("score"),
    )
    rows = docs.select(key, word_count(F.col(text)).alias("n_words"), row_digest(key, text).alias("row"))
    return rows.join(per_row, "row", "left").select(
        key,
        "n_words",
        F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"),
        F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(labels), ",")
