"""License detection by ordered signature rules, in DataFrame expressions only.

A text becomes lower-cased words between single spaces. A rule is a regular expression over
such words, looked at only where one of its keywords occurs. Detections are intervals of words; one
that lies inside the interval of a rule of higher priority, or of a longer or earlier rule of
the same priority, is suppressed.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tierforge.llm.common import bind, located, require, running, table, text_or_empty

NO_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    label: str
    keyword: str  # one or more joined by |; every text the pattern matches must contain one of them
    pattern: str
    priority: int
    weight: float
    base: bool = False


# Rules by priority: 1 identifier tag, 2 grant, 3 name, 4 characteristic sentence or address.
# Label, keyword, pattern of the name, words of the identifier.
NAMES = [
    ("mit", "mit|expat", r"(?:mit|expat) licen[sc]e", "mit"),
    ("mit-0", "attribution", r"mit no attribution(?: licen[sc]e)?", "mit 0"),
    ("x11", "x11", r"x11 licen[sc]e", "x11"),
    ("isc", "isc", r"isc licen[sc]e", "isc"),
    ("apache-1.0", "apache", r"apache (?:software )?licen[sc]e (?:version |v)?1 0", "apache 1 0"),
    ("apache-1.1", "apache", r"apache (?:software )?licen[sc]e (?:version |v)?1 1", "apache 1 1"),
    ("apache-2.0", "apache", r"apache (?:software )?licen[sc]e (?:version |v)?2(?: 0)?", "apache 2 0"),
    ("bsd-0-clause", "bsd", r"(?:zero clause|0 clause|0) bsd(?: licen[sc]e)?", "0bsd"),
    ("bsd-1-clause", "bsd", r"(?:bsd 1 clause|1 clause bsd)(?: licen[sc]e)?", "bsd 1 clause"),
    ("bsd-2-clause", "bsd", r"(?:bsd 2 clause|(?:2|two) clause bsd|simplified bsd|freebsd)(?: licen[sc]e)?", "bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"(?:bsd 3 clause|(?:3|three) clause bsd|(?:new|modified|revised) bsd)(?: licen[sc]e)?", "bsd 3 clause"),
    ("bsd-4-clause", "bsd", r"(?:bsd 4 clause|(?:4|four) clause bsd|(?:original|old) bsd)(?: licen[sc]e)?", "bsd 4 clause"),
    ("bsd", "bsd", r"bsd(?: style)? licen[sc]e", "bsd"),
    ("gpl-1.0", "general", r"gnu general public licen[sc]e (?:version |v)?1(?: 0)?", "gpl 1 0"),
    ("gpl-2.0", "general", r"gnu general public licen[sc]e (?:version |v)?2(?: 0)?", "gpl 2 0"),
    ("gpl-3.0", "general", r"gnu general public licen[sc]e (?:version |v)?3(?: 0)?", "gpl 3 0"),
    ("gpl-2.0-short", "gpl", r"gpl ?v?2(?: 0)?", "gpl 2 0 only"),
    ("gpl-3.0-short", "gpl", r"gpl ?v?3(?: 0)?", "gpl 3 0 only"),
    ("gpl-2.0-plus", "later", r"general public licen[sc]e (?:version )?2 or (?:any )?later", "gpl 2 0 or later"),
    ("gpl-3.0-plus", "later", r"general public licen[sc]e (?:version )?3 or (?:any )?later", "gpl 3 0 or later"),
    ("lgpl-2.0", "library", r"gnu library general public licen[sc]e", "lgpl 2 0"),
    ("lgpl-2.1", "lesser", r"gnu lesser general public licen[sc]e (?:version |v)?2 1", "lgpl 2 1"),
    ("lgpl-3.0", "lesser", r"gnu lesser general public licen[sc]e (?:version |v)?3(?: 0)?", "lgpl 3 0"),
    ("lgpl", "lesser", r"gnu lesser general public licen[sc]e", "lgpl"),
    ("agpl-1.0", "affero", r"affero general public licen[sc]e (?:version |v)?1(?: 0)?", "agpl 1 0"),
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public licen[sc]e (?:version |v)?3(?: 0)?", "agpl 3 0"),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[sc]e", "agpl"),
    ("gfdl", "documentation", r"gnu free documentation licen[sc]e(?: (?:version |v)?1 \d)?", "gfdl 1 3"),
    ("mpl-1.0", "mozilla", r"mozilla public licen[sc]e (?:version |v)?1 0", "mpl 1 0"),
    ("mpl-1.1", "mozilla", r"mozilla public licen[sc]e (?:version |v)?1 1", "mpl 1 1"),
    ("mpl-2.0", "mozilla", r"mozilla public licen[sc]e (?:version |v)?2(?: 0)?", "mpl 2 0"),
    ("mpl", "mozilla", r"mozilla public licen[sc]e", "mpl"),
    ("epl-1.0", "eclipse", r"eclipse public licen[sc]e (?:version |v)?1(?: 0)?", "epl 1 0"),
    ("epl-2.0", "eclipse", r"eclipse public licen[sc]e (?:version |v)?2(?: 0)?", "epl 2 0"),
    ("epl", "eclipse", r"eclipse public licen[sc]e", "epl"),
    ("cpl-1.0", "common", r"common public licen[sc]e(?: (?:version |v)?1 0)?", "cpl 1 0"),
    ("cddl-1.0", "common", r"common development and distribution licen[sc]e(?: (?:version |v)?1 0)?", "cddl 1 0"),
    ("cddl-1.1", "common", r"common development and distribution licen[sc]e (?:version |v)?1 1", "cddl 1 1"),
    ("cpal-1.0", "common", r"common public attribution licen[sc]e", "cpal 1 0"),
    ("eupl-1.1", "european", r"european union public licen[sc]e (?:version |v)?1 1", "eupl 1 1"),
    ("eupl-1.2", "european", r"european union public licen[sc]e (?:version |v)?1 2", "eupl 1 2"),
    ("eupl", "european", r"european union public licen[sc]e", "eupl"),
    ("artistic-1.0", "artistic", r"artistic licen[sc]e (?:version |v)?1(?: 0)?", "artistic 1 0"),
    ("artistic-2.0", "artistic", r"artistic licen[sc]e (?:version |v)?2(?: 0)?", "artistic 2 0"),
    ("artistic", "artistic", r"artistic licen[sc]e", "artistic"),
    ("bsl-1.0", "boost", r"boost software licen[sc]e(?: (?:version |v)?1 0)?", "bsl 1 0"),
    ("busl-1.1", "business", r"business source licen[sc]e(?: (?:version |v)?1 1)?", "busl 1 1"),
    ("sspl-1.0", "server", r"server side public licen[sc]e", "sspl 1 0"),
    ("elastic-2.0", "elastic", r"elastic licen[sc]e(?: (?:version |v)?2(?: 0)?)?", "elastic 2 0"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[sc]e", "zlib"),
    ("libpng", "libpng", r"libpng licen[sc]e", "libpng"),
    ("unlicense", "unlicen", r"the unlicen[sc]e", "unlicense"),
    ("wtfpl", "want", r"do what the fuck you want to public licen[sc]e", "wtfpl"),
    ("cc0-1.0", "cc0", r"cc0(?: 1 0)?(?: universal)?", "cc0 1 0"),
    ("cc-by-2.0", "cc", r"cc by 2 0", "cc by 2 0"),
    ("cc-by-3.0", "cc", r"cc by 3 0", "cc by 3 0"),
    ("cc-by-4.0", "cc", r"cc by 4 0", "cc by 4 0"),
    ("cc-by-sa-2.0", "cc", r"cc by sa 2 0", "cc by sa 2 0"),
    ("cc-by-sa-3.0", "cc", r"cc by sa 3 0", "cc by sa 3 0"),
    ("cc-by-sa-4.0", "cc", r"cc by sa 4 0", "cc by sa 4 0"),
    ("cc-by-nd-4.0", "cc", r"cc by nd(?: 4 0)?", "cc by nd 4 0"),
    ("cc-by-nc-4.0", "cc", r"cc by nc(?: 4 0)?", "cc by nc 4 0"),
    ("cc-by-nc-sa-4.0", "cc", r"cc by nc sa(?: 4 0)?", "cc by nc sa 4 0"),
    ("cc-by-nc-nd-4.0", "cc", r"cc by nc nd(?: 4 0)?", "cc by nc nd 4 0"),
    ("cc-by", "creative", r"creative commons attribution(?: \d \d)?(?: international| unported)?(?: licen[sc]e)?", "cc by"),
    ("cc-by-sa", "creative", r"creative commons attribution share ?alike(?: \d \d)?(?: international| unported)?(?: licen[sc]e)?", "cc by sa"),
    ("cc-by-nc", "creative", r"creative commons attribution non ?commercial(?: \d \d)?(?: international| unported)?(?: licen[sc]e)?", "cc by nc"),
    ("cc-by-nd", "creative", r"creative commons attribution no ?deriv(?:ative)?s?(?: \d \d)?(?: international| unported)?(?: licen[sc]e)?", "cc by nd"),
    ("ofl-1.1", "font", r"sil open font licen[sc]e(?: (?:version |v)?1 1)?", "ofl 1 1"),
    ("odbl-1.0", "database", r"open database licen[sc]e", "odbl 1 0"),
    ("odc-by-1.0", "attribution", r"open data commons attribution licen[sc]e", "odc by 1 0"),
    ("pddl-1.0", "domain", r"public domain dedication and licen[sc]e", "pddl 1 0"),
    ("psf-2.0", "python", r"python software foundation licen[sc]e(?: (?:version |v)?2)?", "psf 2 0"),
    ("php-3.0", "php", r"php licen[sc]e(?: (?:version |v)?3 0\d?)?", "php 3 01"),
    ("ruby", "ruby", r"ruby licen[sc]e", "ruby"),
    ("postgresql", "postgresql", r"postgresql licen[sc]e", "postgresql"),
    ("ncsa", "ncsa", r"(?:university of illinois )?ncsa open source licen[sc]e", "ncsa"),
    ("ms-pl", "microsoft", r"microsoft public licen[sc]e", "ms pl"),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[sc]e", "ms rl"),
    ("osl-3.0", "open", r"open software licen[sc]e(?: (?:version |v)?3 0)?", "osl 3 0"),
    ("afl-3.0", "academic", r"academic free licen[sc]e(?: (?:version |v)?3 0)?", "afl 3 0"),
    ("upl-1.0", "universal", r"universal permissive licen[sc]e", "upl 1 0"),
    ("blueoak-1.0.0", "oak", r"blue oak model licen[sc]e(?: 1 0 0)?", "blueoak 1 0 0"),
    ("openrail", "rail|responsible", r"(?:open ?rail(?: m| s)?|responsible ai) licen[sc]e", "openrail"),
    ("llama-community", "community", r"llama(?: \d)*(?: \d)? community licen[sc]e(?: agreement)?", "llama community"),
]

# Sentences and addresses, most of them from the texts of the licenses: label, keyword, pattern.
SENTENCES = [
    ("mit", "permission", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "notice", r"the above copyright notice and this permission notice shall be included in all copies"),
    ("mit", "opensource", r"opensource org licen[sc]es mit"),
    ("isc", "permission", r"permission to use copy modify and or distribute this software for any purpose"),
    ("apache-2.0", "apache", r"(?:www )?apache org licen[sc]es licen[sc]e 2 0"),
    ("apache-2.0", "compliance", r"you may not use this file except in compliance with the licen[sc]e"),
    ("apache-2.0", "opensource", r"opensource org licen[sc]es apache 2 0"),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification"),
    ("bsd", "redistributions", r"redistributions of source code must retain the above copyright notice"),
    ("bsd", "redistributions", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", "endorse", r"may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising", r"all advertising materials mentioning features or use of this software"),
    ("bsd-2-clause", "opensource", r"opensource org licen[sc]es bsd 2 clause"),
    ("bsd-3-clause", "opensource", r"opensource org licen[sc]es bsd 3 clause"),
    ("gpl", "free", r"this program is free software you can redistribute it and or modify it"),
    ("gpl", "gnu", r"(?:www )?gnu org licen[sc]es gpl(?: \d \d)?(?: html| txt)?"),
    ("gpl", "received", r"you should have received a copy of the gnu general public licen[sc]e"),
    ("lgpl", "gnu", r"(?:www )?gnu org licen[sc]es lgpl(?: \d \d)?(?: html| txt)?"),
    ("lgpl", "received", r"you should have received a copy of the gnu lesser general public licen[sc]e"),
    ("agpl", "gnu", r"(?:www )?gnu org licen[sc]es agpl(?: \d \d)?(?: html| txt)?"),
    ("agpl", "affero", r"you should have received a copy of the gnu affero general public licen[sc]e"),
    ("gfdl", "document", r"permission is granted to copy distribute and or modify this document"),
    ("mpl-2.0", "mozilla", r"(?:www )?mozilla org (?:en us )?mpl 2 0"),
    ("mpl-2.0", "source", r"this source code form is subject to the terms of the mozilla public licen[sc]e"),
    ("epl-2.0", "eclipse", r"(?:www )?eclipse org legal epl (?:v20|2 0)(?: html)?"),
    ("epl-1.0", "eclipse", r"(?:www )?eclipse org legal epl v10(?: html)?"),
    ("bsl-1.0", "boost", r"(?:www )?boost org licen[sc]e 1 0(?: txt)?"),
    ("zlib", "altered", r"altered source versions must be plainly marked as such"),
    ("zlib", "misrepresented", r"the origin of this software must not be misrepresented"),
    ("unlicense", "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", "unlicense", r"(?:www )?unlicense org"),
    ("cc0-1.0", "creativecommons", r"creativecommons org publicdomain zero 1 0"),
    ("cc-by", "creativecommons", r"creativecommons org licen[sc]es by(?: \d \d)?"),
    ("cc-by-sa", "creativecommons", r"creativecommons org licen[sc]es by sa(?: \d \d)?"),
    ("cc-by-nc", "creativecommons", r"creativecommons org licen[sc]es by nc(?: \d \d)?"),
    ("cc-by-nd", "creativecommons", r"creativecommons org licen[sc]es by nd(?: \d \d)?"),
    ("cc-by-nc-sa", "creativecommons", r"creativecommons org licen[sc]es by nc sa(?: \d \d)?"),
    ("cc-by-nc-nd", "creativecommons", r"creativecommons org licen[sc]es by nc nd(?: \d \d)?"),
    ("ofl-1.1", "sil", r"scripts sil org ofl"),
    ("public-domain", "public", r"(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("public-domain", "public", r"this (?:work|file|code) is in the public domain"),
    ("proprietary", "rights", r"all rights reserved"),
    ("proprietary", "proprietary", r"(?:proprietary and confidential|confidential and proprietary)"),
    ("proprietary", "unauthorized", r"unauthorized copying of this file"),
    ("warranty-disclaimer", "warrant", r"without (?:any )?warrant(?:y|ies)(?: or conditions)? of any kind"),
    ("warranty-disclaimer", "warranty", r"provided as is without (?:any )?(?:express or implied )?warranty"),
    ("copyright-notice", "copyright", r"copyright (?:c )?(?:19|20)\d\d"),
    ("see-license", "licen", r"see (?:the )?(?:accompanying )?licen[sc]e(?: txt| md)?(?: file)? for"),
    ("eula", "agreement", r"end user licen[sc]e agreement"),
    ("research-only", "academic|research|commercial", r"(?:for )?(?:academic|research|non ?commercial)(?: research)? (?:use|purposes) only"),
]

# The base phrases and their labels.
BASE_PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

GRANT = (
    r"(?:dual )?(?:licen[sc]ed|released|distributed|published|provided|available|covered|redistributed)"
    r" (?:under|by|with) (?:the )?(?:terms of )?(?:the )?"
)


def signature_rules() -> list[Rule]:
    rules = [Rule(label, phrase.split()[0], phrase, 3, 0.8, True) for phrase, label in BASE_PHRASES]
    for label, keyword, name, tag in NAMES:
        rules.append(Rule(label, "spdx", rf"spdx licen[sc]e identifier {tag}", 1, 1.0))
        rules.append(Rule(label, keyword, GRANT + f"(?:{name})", 2, 0.95))
        rules.append(Rule(label, keyword, name, 3, 0.8))
    rules += [Rule(label, keyword, sentence, 4, 0.7) for label, keyword, sentence in SENTENCES]
    return rules


# The words that every rule needs at least one of; short names alone are common in prose.
_GATE = (
    r"(?i) (?:[a-z]*licen[sc]e[a-z]*|spdx|gpl(?:v?\d)?|[a-z0-9]*bsd|cc|cc0|copyright|warrant(?:y|ies)|creative|commons|"
    r"creativecommons|permission|public|publicdomain|redistributions?|rights|proprietary|unauthorized|only|mpl|epl|sil|"
    r"endorse|advertising|misrepresented|altered|compliance|free|notice|attribution) "
)

_RULE = "label string, keyword array<string>, pattern string, priority int, weight double, base boolean"
_SPAN = "array<struct<start:bigint,neg_end:bigint,priority:int,rule:int,label:string,weight:double,base:boolean>>"


def _count(text: Column) -> Column:
    """Words of a text in which each follows a space."""
    return (F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))).cast("bigint")


def _places(words: Column, rule: Column) -> Column:
    """Intervals of words in which ``rule`` matches."""
    here = F.concat(F.lit(" (?:"), rule.pattern, F.lit(")(?= )"))
    return F.transform(
        located(words, here, _count),
        lambda m: F.struct(
            m.start.alias("start"), (-m.end).alias("neg_end"), rule.priority.alias("priority"),
            rule.no.alias("rule"), rule.label.alias("label"), rule.weight.alias("weight"), rule.base.alias("base"),
        ),
    )


def _unsuppressed(spans: Column) -> Column:
    """Without intervals inside one of higher priority, or of the same and sorted before; base spans stay."""
    levels = ("m1", "m2", "m3", "m4")
    reach = ",".join(f"{name}:bigint" for name in levels)

    # How far the intervals of each priority reach.
    def ends(span: Column) -> Column:
        here = [F.when(span.priority == level, -span.neg_end).otherwise(F.lit(-1)) for level in range(1, 5)]
        return F.struct(*[end.cast("bigint").alias(name) for name, end in zip(levels, here, strict=True)])

    def furthest(a: Column, b: Column) -> Column:
        return F.struct(*[F.greatest(a[name], b[name]).alias(name) for name in levels])

    none = F.struct(*[F.lit(-1).cast("bigint").alias(name) for name in levels])

    def outside(pair: Column) -> Column:
        inside = F.lit(False)
        for level, name in enumerate(levels, 1):
            inside = inside | ((pair.span.priority >= level) & (pair.before[name] >= -pair.span.neg_end))
        return ~inside | pair.span.base

    def kept(s: Column) -> Column:
        before = running(s, ends, furthest, none, f"struct<{reach}>")
        pairs = F.zip_with(s, before, lambda span, b: F.struct(span.alias("span"), b.alias("before")))
        return F.transform(F.filter(pairs, outside), lambda pair: pair.span)

    return bind(F.array_sort(spans), kept)


def scan_licenses(docs: DataFrame, rules: Sequence[Rule] | None = None, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``n_words`` and ``detections`` added (columns of those names are replaced).

    ``detections``: array of ``start``, ``end`` (words, end exclusive), ``label``, ``priority``,
    ``weight``, ``base`` that no other interval suppresses, by start. Null and empty
    texts have no words and no detections. Nothing is shuffled and rows stay rows, so repeated rows,
    hot keys and null ids need no care; a text's cost grows with its length and its detections.
    """
    require(docs, [text_col])
    rules = signature_rules() if rules is None else rules
    listed = [{"no": no, **rule._asdict(), "keyword": rule.keyword.split("|")} for no, rule in enumerate(rules)]
    all_rules = F.from_json(F.lit(json.dumps(listed)), f"array<struct<no:int,{_RULE.replace(' ', ':').replace(',:', ',')}>>")

    plain = F.trim(F.regexp_replace(text_or_empty(text_col), NO_WORD, " "))

    def scan(words: Column) -> Column:
        framed = F.concat(F.lit(" "), F.translate(words, UPPER, LOWER), F.lit(" "))
        found = bind(
            framed,
            lambda x: F.flatten(
                F.transform(F.filter(all_rules, lambda r: F.exists(r.keyword, lambda k: F.contains(x, k))), lambda r: _places(x, r))
            ),
        )
        gated = F.concat(F.lit(" "), words, F.lit(" ")).rlike(_GATE)
        return F.struct(
            F.when(words == "", F.lit(0)).otherwise(_count(words) + 1).cast("bigint").alias("n_words"),
            F.when(gated, found).otherwise(F.array().cast(_SPAN)).alias("spans"),
        )

    scanned = docs.drop("n_words", "detections").withColumn("__scan", bind(plain, scan))
    scanned = scanned.withColumn("__kept", _unsuppressed(F.col("__scan.spans")))
    as_detection = lambda s: F.struct(
        s.start.alias("start"), (-s.neg_end).alias("end"), s.label.alias("label"), s.priority.alias("priority"),
        s.weight.alias("weight"), s.base.alias("base"),
    )
    return scanned.withColumns(
        {"n_words": F.col("__scan.n_words"), "detections": F.transform("__kept", as_detection)}
    ).drop("__scan", "__kept")


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("detections", lambda d: d.base)
    starts = F.transform(base, lambda d: d.start)
    label = lambda d: d.label
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        _joined(F.transform(base, label)).alias("base_labels"),
        _joined(F.transform("detections", label)).alias("labels"),
        F.coalesce(F.array_max(F.transform("detections", lambda d: d.weight)), F.lit(0.0)).alias("score"),
        "detections",
    )
