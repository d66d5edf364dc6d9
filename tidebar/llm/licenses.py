"""License scans: ordered signature rules over whole texts, in native expressions only.

Texts without any of the gate's keywords are counted and left alone. The others become
lower-case words between single spaces, on which each rule whose own keyword occurs is run.
A rule's hits are intervals; a hit that lies within one of a rule of higher priority, or of a
longer hit of equal priority, is suppressed, and the labels of the rest are reported.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Phrases that are looked for word by word, and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: Families: label, keyword that all hits of the name hold, expression for the name.
FAMILIES = [
    ("agpl-3", "affero", r"gnu affero general public licen[cs]e(?: v(?:ersion )?3)?"),
    ("agpl-3", "agpl", r"agpl(?: ?v?3)?(?: 0)?(?: only| or later)?"),
    ("apache-1", "apache", r"apache(?: software)? licen[cs]e v(?:ersion )?1(?: [01])?|apache 1(?: [01])?"),
    ("apache-2", "apache", r"apache(?: software)?(?: licen[cs]e)?(?: v(?:ersion)?)? ?2(?: 0)?"),
    ("artistic-2", "artistic", r"artistic licen[cs]e(?: v(?:ersion)?)? ?2(?: 0)?|artistic 2(?: 0)?"),
    ("bsd-2", "bsd", r"(?:simplified|freebsd|2 clause|two clause) bsd|bsd 2 clause"),
    ("bsd-3", "bsd", r"(?:new|modified|revised|3 clause|three clause) bsd|bsd 3 clause"),
    ("bsd", "bsd", r"bsd(?: style)?"),
    ("bsl-1", "boost", r"boost software licen[cs]e(?: (?:version )?1(?: 0)?)?"),
    ("cc0-1", "cc0", r"cc0(?: 1(?: 0)?)?(?: universal)?"),
    ("cc-by-nc-nd", "cc", r"cc by nc nd(?: [1-4] [05])?"),
    ("cc-by-nc-sa", "cc", r"cc by nc sa(?: [1-4] [05])?"),
    ("cc-by-nc", "cc", r"cc by nc(?: [1-4] [05])?"),
    ("cc-by-nd", "cc", r"cc by nd(?: [1-4] [05])?"),
    ("cc-by-sa", "cc", r"cc by sa(?: [1-4] [05])?"),
    ("cc-by", "cc", r"cc by(?: [1-4] [05])?"),
    ("cc-by-nc-nd", "noncommercial", r"creative commons attribution noncommercial noderiv\w*"),
    ("cc-by-nc-sa", "noncommercial", r"creative commons attribution noncommercial sharealike"),
    ("cc-by-nc", "noncommercial", r"creative commons attribution noncommercial"),
    ("cc-by-sa", "sharealike", r"creative commons attribution sharealike"),
    ("cc-by", "commons", r"creative commons attribution"),
    ("cddl-1", "cddl", r"cddl(?: ?v?1)?(?: 0)?"),
    ("cddl-1", "distribution", r"common development and distribution licen[cs]e"),
    ("cecill-2", "cecill", r"cecill(?: ?v?2)?(?: 1)?"),
    ("epl-1", "eclipse", r"eclipse public licen[cs]e(?: v(?:ersion)?)? ?1(?: 0)?"),
    ("epl-2", "eclipse", r"eclipse public licen[cs]e(?: v(?:ersion)?)? ?2(?: 0)?"),
    ("epl-2", "epl", r"epl ?v?2(?: 0)?"),
    ("eupl-1.2", "eupl", r"eupl(?: ?v?1(?: 2)?)?"),
    ("gfdl", "documentation", r"gnu free documentation licen[cs]e"),
    ("gpl-2", "general", r"gnu general public licen[cs]e(?: v(?:ersion)?)? ?2"),
    ("gpl-3", "general", r"gnu general public licen[cs]e(?: v(?:ersion)?)? ?3"),
    ("gpl", "general", r"gnu general public licen[cs]e"),
    ("gpl-2", "gpl", r"(?:gnu )?gpl ?v?(?:ersion )?2(?: 0)?(?: only| or later)?"),
    ("gpl-3", "gpl", r"(?:gnu )?gpl ?v?(?:ersion )?3(?: 0)?(?: only| or later)?"),
    ("isc", "isc", r"isc"),
    ("lgpl", "lesser", r"gnu lesser general public licen[cs]e"),
    ("lgpl", "library", r"gnu library general public licen[cs]e"),
    ("lgpl-2.1", "lgpl", r"(?:gnu )?lgpl ?v?(?:ersion )?2(?: [01])?(?: only| or later)?"),
    ("lgpl-3", "lgpl", r"(?:gnu )?lgpl ?v?(?:ersion )?3(?: 0)?(?: only| or later)?"),
    ("mit", "mit", r"mit"),
    ("mit", "expat", r"expat"),
    ("mit-0", "mit", r"mit 0|mit no attribution"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[cs]e(?: v(?:ersion)?)? ?1(?: 1)?"),
    ("mpl-2", "mozilla", r"mozilla public licen[cs]e(?: v(?:ersion)?)? ?2(?: 0)?"),
    ("mpl-2", "mpl", r"mpl ?v?2(?: 0)?"),
    ("ms-pl", "microsoft", r"microsoft public licen[cs]e"),
    ("odbl-1", "database", r"open database licen[cs]e"),
    ("ofl-1.1", "sil", r"sil open font licen[cs]e(?: v(?:ersion)?)? ?(?:1 1)?"),
    ("openssl", "openssl", r"openssl"),
    ("postgresql", "postgresql", r"postgresql"),
    ("psf-2", "python", r"python(?: software foundation)?"),
    ("unlicense", "unlicense", r"unlicense"),
    ("wtfpl", "wtfpl", r"wtfpl"),
    ("zlib", "zlib", r"zlib(?: libpng)?"),
    ("zpl-2.1", "zope", r"zope public"),
]

#: Forms in which a name counts, from the surest: expression around it, score, what starts a word
#: of every hit besides the name's keyword.
FORMS = [
    (r"spdx licen[cs]e identifier (?:NAME)", 1.0, "spdx"),
    (r"(?:dual |multi )?licen[cs]ed under (?:the )?(?:terms of )?(?:the )?(?:NAME)(?: licen[cs]e)?", 0.95, "licen"),
    (r"(?:released|distributed|published|available|provided|made available) under (?:the )?(?:terms of )?(?:the )?(?:NAME)(?: licen[cs]e)?", 0.9, "under"),
    (r"(?:terms of|subject to|governed by|covered by|accordance with) (?:the )?(?:NAME)(?: licen[cs]e)?", 0.85, ""),
    (r"licen[cs]e (?:is |type )?(?:the )?(?:NAME)", 0.75, "licen"),
    (r"(?:NAME) licen[cs]e[ds]?", 0.7, "licen"),
]

#: Rules without a family: label, keyword that all hits hold, expression, score; they rank below all forms.
OTHERS = [
    ("mit", "permission", r"permission is hereby granted free of charge to any person obtaining a copy", 0.9),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms", 0.9),
    ("isc", "permission", r"permission to use copy modify and or distribute this software", 0.9),
    ("gpl", "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general", 0.9),
    ("public-domain", "domain", r"(?:in|into|to) the public domain", 0.6),
    ("all-rights-reserved", "reserved", r"all rights reserved", 0.5),
    ("proprietary", "proprietary", r"proprietary (?:and confidential|licen[cs]e)", 0.6),
    ("copyleft", "copyleft", r"copyleft", 0.4),
    ("other", "licen", r"licen[cs]ed under", 0.2),
]

#: Sentences of the licenses themselves, of the notices that grant them, of exceptions and of
#: choices between licenses, as the others: they rank with the surest form.
TEXTS = [
    ("mit", "hereby", r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", 1.0),
    ("mit", "notice", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", 0.95),
    ("mit-0", "hereby", r"hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so the software is provided", 1.0),
    ("x11", "advertising", r"except as contained in this notice the name of [^ ]+(?: [^ ]+){0,6} shall not be used in advertising", 0.95),
    ("bsd-2", "redistributions", r"redistributions in binary form must reproduce the above copyright notice", 0.85),
    ("bsd-3", "endorse", r"(?:may|must|shall) not be used to endorse or promote products derived from this software", 0.95),
    ("bsd-3", "endorse", r"may be used to endorse or promote products derived from this software without specific prior written permission", 0.95),
    ("bsd-4", "advertising", r"all advertising materials mentioning features or use of this software must display", 0.95),
    ("0bsd", "fee", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided", 1.0),
    ("isc", "fee", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided that", 1.0),
    ("ntp", "fee", r"permission to use copy modify and distribute this software and its documentation for any purpose (?:with or )?without fee", 0.95),
    ("apache-2", "apache", r"you may not use this file except in compliance with the license you may obtain a copy of the license at(?: https?)? www apache org", 1.0),
    ("apache-2", "apache", r"www apache org licenses license 2 0", 1.0),
    ("apache-2", "contributor", r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|patent|except)", 0.95),
    ("apache-1", "apache", r"this product includes software developed by the apache (?:group|software foundation)", 0.85),
    ("gpl-2-or-later", "foundation", r"published by the free software foundation either version 2 of the license or at your option any later version", 0.95),
    ("gpl-3-or-later", "foundation", r"published by the free software foundation either version 3 of the license or at your option any later version", 0.95),
    ("lgpl-2.1-or-later", "foundation", r"published by the free software foundation either version 2 1 of the license or at your option any later version", 0.95),
    ("gpl-2-or-later", "gpl", r"gpl ?v?2(?: 0)?(?: or later| plus)|gpl 2 0 or newer", 0.9),
    ("gpl-3-or-later", "gpl", r"gpl ?v?3(?: 0)?(?: or later| plus)|gpl 3 0 or newer", 0.9),
    ("agpl-3-or-later", "agpl", r"agpl ?v?3(?: 0)?(?: or later| plus)", 0.9),
    ("lgpl-2.1-or-later", "lgpl", r"lgpl ?v?2(?: 1)?(?: or later| plus)", 0.9),
    ("lgpl-3-or-later", "lgpl", r"lgpl ?v?3(?: 0)?(?: or later| plus)", 0.9),
    ("gpl", "warranty", r"without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license", 0.95),
    ("lgpl", "warranty", r"without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu (?:lesser|library) general public license", 0.95),
    ("agpl-3", "warranty", r"without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu affero general public license", 0.95),
    ("gpl", "freedom", r"the licenses for most software are designed to take away your freedom to share and change it", 0.95),
    ("gpl-3", "copyleft", r"the gnu general public license is a free copyleft license for software and other kinds of works", 1.0),
    ("agpl-3", "interacting", r"your modified version must prominently offer all users interacting with it remotely through a computer network", 1.0),
    ("classpath-exception", "classpath", r"classpath exception(?: 2 0)?", 0.9),
    ("linking-exception", "special", r"as a special exception (?:[^ ]+ ){0,12}permission to link", 0.9),
    ("linking-exception", "linking", r"linking exception", 0.9),
    ("linking-exception", "independent", r"link this library with independent modules to produce an executable", 0.95),
    ("openssl-exception", "openssl", r"permission to link (?:[^ ]+ ){0,10}with the openssl library|openssl (?:linking )?exception", 0.9),
    ("gcc-exception", "runtime", r"gcc runtime library exception(?: 3 1)?", 0.95),
    ("font-exception", "font", r"font embedding exception|gpl font exception", 0.9),
    ("llvm-exception", "llvm", r"(?:with )?llvm exceptions?", 0.9),
    ("mpl-2", "mozilla", r"this source code form is subject to the terms of the mozilla public license v 2 0", 1.0),
    ("mpl-1.1", "mozilla", r"the contents of this file are subject to the mozilla public license version 1 1", 1.0),
    ("epl-2", "eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public license(?: v)? 2 0", 1.0),
    ("epl-1", "eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public license v1 0", 1.0),
    ("cddl-1", "distribution", r"the contents of this file are subject to the terms of the common development and distribution license", 1.0),
    ("bsl-1", "boost", r"distributed under the boost software license version 1 0", 1.0),
    ("zlib", "origin", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software", 1.0),
    ("zlib", "altered", r"altered source versions must be plainly marked as such", 0.9),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain", 1.0),
    ("wtfpl", "fuck", r"do what the fuck you want to public license", 1.0),
    ("cc0-1", "waived", r"waived all copyright and related or neighboring rights", 0.95),
    ("cc-by", "creativecommons", r"creativecommons org licenses by [1-4] [05]", 1.0),
    ("cc-by-sa", "creativecommons", r"creativecommons org licenses by sa [1-4] [05]", 1.0),
    ("cc-by-nd", "creativecommons", r"creativecommons org licenses by nd [1-4] [05]", 1.0),
    ("cc-by-nc", "creativecommons", r"creativecommons org licenses by nc [1-4] [05]", 1.0),
    ("cc-by-nc-sa", "creativecommons", r"creativecommons org licenses by nc sa [1-4] [05]", 1.0),
    ("cc-by-nc-nd", "creativecommons", r"creativecommons org licenses by nc nd [1-4] [05]", 1.0),
    ("cc0-1", "creativecommons", r"creativecommons org publicdomain zero 1 0", 1.0),
    ("ofl-1.1", "reserved", r"no modified version of the font software may use the reserved font name", 0.95),
    ("postgresql", "documentation", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement", 1.0),
    ("openssl", "openssl", r"this product includes software developed by the openssl project", 0.95),
    ("gfdl", "documentation", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", 1.0),
    ("busl-1.1", "business", r"business source license(?: 1 1)?", 0.9),
    ("sspl-1", "server", r"server side public license(?: v(?:ersion)? ?1)?", 0.9),
    ("elastic-2", "elastic", r"elastic license(?: v?2(?: 0)?)?", 0.85),
    ("commons-clause", "commons", r"commons clause(?: license condition)?", 0.85),
    ("dual", "dual", r"dual licen[cs]ed", 0.8),
    ("dual", "option", r"at your option under (?:the terms of )?either", 0.8),
    ("dual", "either", r"either the (?:[^ ]+ ){1,6}or the (?:[^ ]+ ){1,6}licen[cs]e", 0.7),
    ("dual", "apache", r"(?:mit or apache 2 0|apache 2 0 or mit)", 0.9),
]

#: What a text may say that it is not; a refusal ranks above all, so the grant that it holds is none.
REFUSED = ["licensed", "licenced", "released", "distributed", "published", "available", "provided"]
REFUSAL = ("not-licensed", 0.3)

#: Without a word that starts with one of these no rule and no phrase can hit.
GATE = (
    r"(?i)(?:^| )(?:licen[cs]|cc by|spdx|copyleft|proprietary|unlicense|reserved|(?:public)?domain|"
    r"hereby|redistribut|permission|under|terms|subject|governed|covered|accordance|copyright|"
    r"advertising|endorse|exception|freedom|interacting|independent|apache|altered|origin|waived|"
    r"clause|openssl|[al]?gpl)"
)

#: All of ASCII but digits and letters. The complement takes Java's expressions 30 times as long.
_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Rule:
    priority: int
    label: str
    keyword: str
    pattern: str
    score: float
    also: str = ""


def _whole_words(pattern: str) -> str:
    return rf"(?<= )(?:{pattern})(?= )"


def rules() -> list[Rule]:
    """Refusals, then every family in every form, texts with the first, then the others; a smaller
    number is a higher priority. A keyword starts a word of every hit, and so does `also`."""
    out = []
    names = "|".join(sorted((name for _, _, name in FAMILIES), key=lambda n: (-len(n), n)))
    label, score = REFUSAL
    for verb in REFUSED:
        grant = rf"not {verb} under (?:the )?(?:terms of )?(?:the )?(?:{names})(?: licen[cs]e)?"
        out.append(Rule(-1, label, f"not {verb} under", _whole_words(grant), score))
    for label, keyword, pattern, score in TEXTS:
        out.append(Rule(0, label, keyword, _whole_words(pattern), score))
    for rank, (form, score, also) in enumerate(FORMS):
        for label, keyword, name in FAMILIES:
            out.append(Rule(rank, label, keyword, _whole_words(form.replace("NAME", name)), score, also))
    for label, keyword, pattern, score in OTHERS:
        out.append(Rule(len(FORMS), label, keyword, _whole_words(pattern), score))
    return out


def _keywords(every: list[Rule]) -> str:
    """Expression whose group is the longest keyword that starts a word; none is skipped by a match."""
    names = sorted({r.keyword for r in every}, key=lambda k: (-len(k), k))
    by_letter = {k[0]: [x[1:] for x in names if x[0] == k[0]] for k in names}
    return f" (?=({'|'.join(f'{a}(?:{"|".join(rest)})' for a, rest in by_letter.items())}))"


def _rule_table(every: list[Rule]) -> Column:
    """The rules as a literal map from a found keyword to those that it admits.

    A keyword admits its own rules and those of keywords that it starts with.
    """

    def entry(r: Rule) -> Column:
        return F.struct(
            F.lit(r.priority).alias("priority"),
            F.lit(r.label).alias("label"),
            # a space in front is found faster than each place is looked back from
            F.lit(r.pattern.replace("(?<= )", " ", 1)).alias("pattern"),
            F.lit(r.score).alias("score"),
            F.lit(f" {r.also}").alias("also"),
        )

    pairs = []
    for keyword in dict.fromkeys(r.keyword for r in every):
        own = [r for r in every if keyword.startswith(r.keyword)]
        pairs += [F.lit(keyword), F.array(*map(entry, own))]
    return F.create_map(*pairs)


def _hits(words: str, keywords: str) -> str:
    """SQL for the intervals of all rules in a column of words, as (a, b, priority, ...) structs.

    A pattern's matches, each with the space before it, and the stretches between them alternate,
    so their lengths give the places.
    """
    return f"""
        flatten(transform(filter(
            flatten(transform(array_distinct(regexp_extract_all({words}, r'{keywords}', 1)), k -> rules[k])),
            r -> contains({words}, r.also) AND {words} rlike r.pattern), r ->
            aggregate(
                zip_with(split({words}, r.pattern, -1), regexp_extract_all({words}, r.pattern, 0),
                    (g, h) -> named_struct('gap', g, 'hit', h)),
                named_struct('at', 0, 'all', cast(array() AS array<struct<a: int, b: int>>)),
                (s, x) -> named_struct(
                    'at', s.at + length(x.gap) + coalesce(length(x.hit), 0),
                    'all', if(x.hit IS NULL, s.all, array_append(s.all, named_struct(
                        'a', s.at + length(x.gap) + 1, 'b', s.at + length(x.gap) + length(x.hit))))),
                s -> transform(s.all, i -> named_struct(
                    'a', i.a, 'b', i.b, 'priority', r.priority, 'label', r.label, 'score', r.score)))))
    """


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _phrase(words: Column, phrase: str) -> tuple[Column, Column, Column]:
    """(number of places, first word, last word) of a phrase in a column of words."""
    within = F.lit(f" {phrase} ")
    n = F.regexp_count(words, F.lit(f" {phrase}(?= )"))
    before = _spaces(F.substring_index(words, f" {phrase} ", 1))
    after = F.length(F.substring_index(words, f" {phrase} ", -1))
    till = F.substring(words, F.lit(1), F.length(words) - after - F.length(within))
    return n, F.when(n > 0, before), F.when(n > 0, _spaces(till))


def scan(docs: DataFrame) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score.

    Words are runs of digits, letters a-z after lower-casing A-Z, and characters beyond
    ASCII, of the whole text; a null text counts as empty. n_base counts all places of the
    `BASE` phrases, first_word and last_word are the least and greatest word number at which
    one starts (null without one). Label columns are distinct, sorted and joined by commas,
    empty if there are none; score is the best of the rules that remain, 1 with a phrase, 0
    without any. Repeated rows are kept, other columns ignored. No shuffle, no Python.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    out = docs.select("doc_id", text.alias("text"))
    line = F.col("line")
    low = F.translate(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    gated = out.select("doc_id", F.trim(F.regexp_replace("text", _SEPARATORS, " ")).alias("line")).select(
        "doc_id",
        F.when(line == "", 0).otherwise(_spaces(line) + 1).cast("long").alias("n_words"),
        F.when(line.rlike(GATE), F.concat(F.lit(" "), low, F.lit(" "))).alias("words"),
    )
    every = rules()
    hits = F.expr(_hits("words", _keywords(every)))
    found = gated.withColumn("rules", _rule_table(every))
    found = found.withColumn("hits", F.when(F.col("words").isNotNull(), hits))
    kept = F.expr(
        """filter(hits, x -> NOT exists(hits, y -> y.a <= x.a AND x.b <= y.b AND (
            y.priority < x.priority OR y.priority = x.priority AND y.b - y.a > x.b - x.a)))"""
    )
    phrases = [_phrase(F.col("words"), p) for p in BASE]
    base = F.array(*(F.when(n > 0, F.lit(label)) for (n, _, _), label in zip(phrases, BASE.values(), strict=True)))
    found = found.select(
        "doc_id",
        "n_words",
        sum((F.coalesce(n, F.lit(0)) for n, _, _ in phrases), F.lit(0)).cast("long").alias("n_base"),
        F.least(*(first for _, first, _ in phrases)).cast("long").alias("first_word"),
        F.greatest(*(last for _, _, last in phrases)).cast("long").alias("last_word"),
        F.array_compact(base).alias("base"),
        kept.alias("kept"),
    )
    own = F.coalesce(F.col("kept")["label"], F.array().cast("array<string>"))

    def joined(labels: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return found.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        joined(F.col("base")).alias("base_labels"),
        joined(F.concat("base", own)).alias("labels"),
        F.when(F.col("n_base") > 0, 1.0)
        .otherwise(F.coalesce(F.array_max(F.col("kept")["score"]), F.lit(0.0)))
        .alias("score"),
    )
