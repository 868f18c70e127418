"""License scans: ordered signature rules behind a keyword prefilter, with DataFrame functions only.

The text is reduced to its words in lower case, joined by one space, so a rule is a regular expression over words. Rules come from a table of
license families and of the ways in which a license is named, the most specific first, from characteristic sentences of the licenses' own
texts and notices, and from the addresses at which licenses are found. A text without any of the rules' keywords is not
looked at; of the rules, only those whose keyword the text has are matched. Where detections overlap, the one inside another is
suppressed, and of two that cross the one of lower priority, whichever begins first; one that only a suppressed one held is left.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The phrases and labels that count in any case (fixed values).
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

@dataclass(frozen=True)
class Family:
    label: str
    names: tuple[str, ...]  # expressions over words in lower case
    versions: tuple[str, ...] = ()
    short: str = ""  # how identifiers begin
    keywords: tuple[str, ...] = ()  # a text that matches any of the names, or identifiers, has one of these after a space


FAMILIES = (
    Family("gpl", ("gnu general public licen[cs]e", "general public licen[cs]e", "gnu gpl", "gpl"), ("1", "2", "3"), "gpl", ("general public licen", "gpl")),
    Family("lgpl", ("gnu (?:lesser|library) general public licen[cs]e", "(?:lesser|library) general public licen[cs]e", "gnu lgpl", "lgpl"), ("2", "2 1", "3"), "lgpl", ("lesser general public", "library general public", "lgpl")),
    Family("agpl", ("gnu affero general public licen[cs]e", "affero general public licen[cs]e", "gnu agpl", "agpl"), ("1", "3"), "agpl", ("affero", "agpl")),
    Family("gfdl", ("gnu free documentation licen[cs]e", "free documentation licen[cs]e", "gfdl"), ("1 1", "1 2", "1 3"), "gfdl", ("free documentation", "gfdl")),
    Family("apache", ("apache software licen[cs]e", "apache licen[cs]e", "apache"), ("1", "1 1", "2", "2 0"), "apache", ("apache",)),
    Family("mit", ("mit x11 licen[cs]e", "mit licen[cs]e", "expat licen[cs]e"), (), "mit", ("mit licen", "mit x11 licen", "identifier mit", "expat licen")),
    Family("bsd", ("(?:new |modified |simplified |revised )?bsd licen[cs]e", "bsd (?:2|3|4|two|three|four) clause(?: licen[cs]e)?", "(?:2|3|4|two|three|four) clause bsd(?: licen[cs]e)?"), ("2", "3", "4"), "bsd", ("bsd",)),
    Family("mpl", ("mozilla public licen[cs]e", "mpl"), ("1 0", "1 1", "2 0"), "mpl", ("mozilla", "mpl")),
    Family("epl", ("eclipse public licen[cs]e", "epl"), ("1 0", "2 0"), "epl", ("eclipse", "epl")),
    Family("cddl", ("common development and distribution licen[cs]e", "cddl"), ("1 0", "1 1"), "cddl", ("common development", "cddl")),
    Family("isc", ("isc licen[cs]e",), (), "isc", ("isc licen", "identifier isc")),
    Family("zlib", ("zlib licen[cs]e", "zlib libpng licen[cs]e"), (), "zlib", ("zlib",)),
    Family("boost", ("boost software licen[cs]e",), ("1 0",), "bsl", ("boost", "bsl")),
    Family("artistic", ("perl artistic licen[cs]e", "artistic licen[cs]e"), ("1 0", "2 0"), "artistic", ("artistic",)),
    Family("unlicense", ("unlicen[cs]e",), (), "unlicense", ("unlicen",)),
    Family("wtfpl", ("do what the fuck you want to public licen[cs]e", "wtfpl"), ("1", "2"), "wtfpl", ("what the fuck", "wtfpl")),
    Family("cc0", ("creative commons zero", "cc0"), ("1 0",), "cc0", ("commons zero", "cc0")),
    Family("cc-by-nc-sa", ("creative commons attribution non ?commercial share ?alike", "cc by nc sa"), ("2 0", "2 5", "3 0", "4 0"), "cc by nc sa", ("creative commons", "cc by nc")),
    Family("cc-by-nc-nd", ("creative commons attribution non ?commercial no ?deriv(?:atives|s)", "cc by nc nd"), ("2 0", "2 5", "3 0", "4 0"), "cc by nc nd", ("creative commons", "cc by nc")),
    Family("cc-by-nc", ("creative commons attribution non ?commercial", "cc by nc"), ("2 0", "2 5", "3 0", "4 0"), "cc by nc", ("creative commons", "cc by nc")),
    Family("cc-by-sa", ("creative commons attribution share ?alike", "cc by sa"), ("2 0", "2 5", "3 0", "4 0"), "cc by sa", ("creative commons", "cc by sa")),
    Family("cc-by-nd", ("creative commons attribution no ?deriv(?:atives|s)", "cc by nd"), ("2 0", "2 5", "3 0", "4 0"), "cc by nd", ("creative commons", "cc by nd")),
    Family("cc-by", ("creative commons attribution", "cc by"), ("2 0", "2 5", "3 0", "4 0"), "cc by", ("creative commons", "cc by")),
    Family("ofl", ("sil open font licen[cs]e", "open font licen[cs]e"), ("1 0", "1 1"), "ofl", ("open font", "ofl")),
    Family("eupl", ("european union public licen[cs]e", "eupl"), ("1 0", "1 1", "1 2"), "eupl", ("european union public", "eupl")),
    Family("odbl", ("open database licen[cs]e", "odbl"), ("1 0",), "odbl", ("open database", "odbl")),
    Family("python", ("python software foundation licen[cs]e", "psf licen[cs]e"), ("2",), "psf", ("python software", "psf")),
    Family("php", ("php licen[cs]e",), ("3 0", "3 01"), "php", ("php",)),
    Family("openssl", ("openssl licen[cs]e",), (), "openssl", ("openssl",)),
    Family("public-domain", ("(?:placed|released|dedicated) (?:in|into|to) the public domain", "public domain"), (), "public domain", ("public domain",)),
)


# Characteristic sentences: label, keyword that every match begins with or holds, expression over words. The bodies of BSD variants have one label, as their names do.
BODIES = (
    ("mit", "permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("boost", "permission is hereby granted", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation"),
    ("isc", "permission to use copy modify", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("0bsd", "permission to use copy modify", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted(?! provided)"),
    ("hpnd", "permission to use copy modify", "permission to use copy modify and(?: or)? distribute this software and its documentation for any purpose"),
    ("bsd", "redistribution and use in source", "redistribution and use in source and binary forms with or without modification are permitted(?: provided that the following conditions are met)?"),
    ("bsd", "neither the name", "neither the names? of (?:[^ ]+ ){1,20}?may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd", "all advertising materials", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("apache", "you may obtain a copy of the license at", "you may obtain a copy of the license at (?:https? )?(?:www )?apache org licenses(?: license 2 0)?"),
    ("apache", "each contributor hereby grants", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright license to reproduce prepare derivative works of|except as stated in this section patent license)"),
    ("apache", "unless required by applicable law", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("gpl", "this program is free software", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("gpl", "you should have received a copy", "you should have received a copy of the gnu general public license(?: along with (?:this program|[^ ]+))?"),
    ("gpl", "by contrast the gnu general public", "by contrast the gnu general public license is intended to guarantee your freedom to share and change"),
    ("gpl", "is a free copyleft license", "(?:the )?gnu general public license is a free copyleft license for software and other kinds of works"),
    ("lgpl", "is free software you can redistribute", "(?:this library|this program|[^ ]+) is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("lgpl", "you should have received a copy", "you should have received a copy of the gnu (?:lesser|library) general public license(?: along with (?:this library|this program|[^ ]+))?"),
    ("lgpl", "applies to some specially designated", "this license the (?:lesser|library) general public license applies to some specially designated"),
    ("lgpl", "incorporates the terms and conditions", "this version of the gnu lesser general public license incorporates the terms and conditions of version 3"),
    ("agpl", "is free software you can redistribute", "(?:this program|[^ ]+) is free software you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("agpl", "you should have received a copy", "you should have received a copy of the gnu affero general public license(?: along with (?:this program|[^ ]+))?"),
    ("agpl", "is a free copyleft license", "(?:the )?gnu affero general public license is a free copyleft license for software and other kinds of works"),
    ("gfdl", "permission is granted to copy distribute", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("gfdl", "the purpose of this license", "the purpose of this license is to make a manual textbook or other functional and useful document free"),
    ("mpl", "this source code form is subject", "this source code form is subject to the terms of the mozilla public license"),
    ("mpl", "copy of the mpl was not distributed", "if a copy of the mpl was not distributed with this file"),
    ("mpl", "the contents of this file are subject", "the contents of this file are subject to the mozilla public license"),
    ("cddl", "the contents of this file are subject", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("epl", "the accompanying program is provided", "the accompanying program is provided under the terms of this eclipse public license"),
    ("zlib", "altered source versions must be", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("zlib", "the origin of this software", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("unlicense", "this is free and unencumbered", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "anyone is free to copy modify", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("wtfpl", "everyone is permitted to copy", "everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed as long as the name is changed"),
    ("ofl", "the goals of the open font", "the goals of the open font license ofl are to stimulate worldwide development of collaborative font projects"),
    ("cc0", "the person who associated a work", "the person who associated a work with this deed has dedicated the work to the public domain"),
)
# The deeds begin with the attribution; what else they ask for follows, with a heading between.
_CREDIT, _HEADING = "you must give appropriate credit provide a link to the licen[cs]e and indicate if changes were made", "(?: [^ ]+){0,40}?"
_NC = f"{_HEADING} you may not use (?:the material|this work) for commercial purposes"
_SA = f"{_HEADING} if you remix transform or build upon the material you must distribute your contributions under the same licen[cs]e as the original"
_ND = f"{_HEADING} if you remix transform or build upon the material you may not distribute the modified material"
BODIES += tuple((f"cc-by{name}", "you must give appropriate credit", _CREDIT + rest) for name, rest in (("", ""), ("-nc", _NC), ("-sa", _SA), ("-nd", _ND), ("-nc-sa", _NC + _SA), ("-nc-nd", _NC + _ND)))

# Addresses, as words: label, keyword, expression. Besides, lists of licenses name each family by its identifier.
ADDRESSES = (
    *[(f"cc-{kind.replace(' ', '-')}", "creativecommons org licen", f"creativecommons org licen[cs]es? {kind}(?: [1-4] [05])?") for kind in ("by", "by nc", "by sa", "by nd", "by nc sa", "by nc nd")],
    ("cc0", "creativecommons org publicdomain", "creativecommons org publicdomain zero(?: 1 0)?"),
    ("public-domain", "creativecommons org publicdomain", "creativecommons org publicdomain mark(?: 1 0)?"),
    ("apache", "apache org licenses", "apache org licenses(?: license(?: [12] [01])?)?"),
    *[(label, "gnu org", f"gnu org (?:licenses|copyleft) (?:old licenses )?{short}(?: v?[1-3](?: [0-3])?)?") for label, short in (("gpl", "gpl"), ("lgpl", "lgpl"), ("agpl", "agpl"), ("gfdl", "fdl"))],
    ("mpl", "mozilla org", "mozilla org (?:en us )?(?:foundation licensing )?mpl(?: [12] [01])?"),
    ("epl", "eclipse org", "eclipse org (?:org )?(?:legal )?(?:documents )?epl(?: ?v?[12] ?0)?"),
    ("boost", "boost org", "boost org (?:users )?license(?: 1 0)?"),
    ("unlicense", "unlicense org", "unlicense org"),
    ("wtfpl", "wtfpl net", "wtfpl net"),
    ("zlib", "zlib net", "zlib net zlib license"),
    ("isc", "isc org", "isc org (?:downloads )?(?:software support policy )?(?:isc )?licen[cs]es?"),
    ("ofl", "sil org", "(?:scripts|openfontlicense) sil org ofl"),
    ("ofl", "openfontlicense org", "openfontlicense org"),
    ("php", "php net", "php net license(?: 3 01| 3 0)?"),
    ("openssl", "openssl org", "openssl org source license"),
    ("python", "python org", "python org (?:[a-z0-9]+ ){0,3}license"),
    ("artistic", "perl org", "perl org licenses artistic"),
    ("odbl", "opendatacommons org", "opendatacommons org licenses odbl(?: 1 0| summary)?"),
)
LISTS = ("opensource org licens", "spdx org licens", "choosealicense com licens")


@dataclass(frozen=True)
class Signature:
    priority: int  # lower wins
    label: str
    keywords: tuple[str, ...]
    pattern: str
    confidence: float


def signatures() -> list[Signature]:
    """The rules: every family in every way of naming it, most specific first. Each pattern begins and ends between words."""
    out = []
    for f in FAMILIES:
        name = f"(?:the )?(?:{'|'.join(f.names)})"
        grant = "(?:licensed|released|distributed|available|published|provided) (?:under|with|by)(?: the terms(?: and conditions)? of)?"
        either = "(?:(?: as published by [a-z ]{1,60}?)?(?: either)? (?:version|v) ?{v}(?: 0)?(?: of the licen[cs]e)?(?: or (?:any |at your option any )?later(?: version)?)?| {v})"
        ways = []
        for v in sorted(f.versions, key=len, reverse=True):
            said = either.replace("{v}", v)
            ways += [
                (0, f"spdx licen[cs]e identifier {f.short} {v}(?: 0)?(?: only| or later)?", 1.0),
                (1, f"{grant} {name}{said}", 1.0),
                (3, f"{name}{said}", 0.95),
                (4, f"{f.short} ?v?{v}(?: 0)?(?: only| or later)?", 0.9),
            ]
        ways += [
            (0, f"spdx licen[cs]e identifier {f.short}", 1.0),
            (2, f"{grant} {name}", 0.95),
            (5, f"(?:see|read|under) {name} for (?:more )?details", 0.9),
            (6, name, 0.75),
        ]
        out += [Signature(p, f.label, f.keywords, f"(?<= )(?:{pattern})(?= )", c) for p, pattern, c in ways]
        version = f"(?: v?(?:{'|'.join(sorted(f.versions, key=len, reverse=True))})(?: 0)?)?" if f.versions else ""
        clause = "(?: (?:clause|license))?"  # bsd-3-clause, mit-license.php
        out.append(Signature(2, f.label, LISTS, f"(?<= )(?:(?:opensource org|spdx org|choosealicense com) licenses? {f.short}{version}{clause})(?= )", 0.95))
    out += [Signature(1, label, (keyword,), f"(?<= )(?:{pattern})(?= )", 1.0) for label, keyword, pattern in BODIES]
    out += [Signature(2, label, (keyword,), f"(?<= )(?:{pattern})(?= )", 0.95) for label, keyword, pattern in ADDRESSES]
    return out


def gate() -> str:
    """An expression that every text matches in which some rule or base phrase does: any keyword, or base phrase, at the beginning of a word."""
    return f" (?:{'|'.join(sorted({k for s in signatures() for k in s.keywords} | {phrase for phrase, _ in BASE}))})"


def words_of(text: Column) -> Column:
    """The words in lower case between single spaces, with one before and one after; one space if there are none."""
    return F.regexp_replace(F.concat(F.lit(" "), F.lower(F.coalesce(text, F.lit(""))), F.lit(" ")), BETWEEN_WORDS, " ")


def _spaces(text: Column) -> Column:
    return (F.char_length(text) - F.char_length(F.replace(text, F.lit(" ")))).cast("bigint")


PLACE = "struct<start:bigint,end:bigint>"


def places(plain: Column, pattern: Column) -> Column:
    """Words covered by the matches of a pattern, leftmost first: number of the first word, and of the one after the last."""
    parts = F.arrays_zip(F.split(plain, pattern, -1).alias("gap"), F.regexp_extract_all(plain, pattern, F.lit(0)).alias("match"))
    nothing = F.struct(F.lit(-1).cast("bigint").alias("at"), F.expr(f"cast(array() as array<{PLACE}>)").alias("found"))

    def step(so_far: Column, part: Column) -> Column:
        start = so_far["at"] + _spaces(part["gap"])  # each word has a space before it
        last = start + _spaces(part["match"])
        found = F.when(part["match"].isNotNull(), F.concat(so_far["found"], F.array(F.struct(start.alias("start"), (last + 1).alias("end"))))).otherwise(so_far["found"])
        return F.struct(F.coalesce(last, start).alias("at"), found.alias("found"))

    return F.aggregate(parts, nothing, step, lambda done: done["found"])


def _rules() -> Column:
    """The rules as one constant array, those of the same keywords together."""
    groups: dict[tuple[str, ...], list[dict]] = {}
    for s in signatures():
        rule = asdict(s)
        groups.setdefault(rule.pop("keywords"), []).append(rule)
    listed = [{"keywords": [f" {k}" for k in keywords], "rules": rules} for keywords, rules in groups.items()]
    return F.from_json(F.lit(json.dumps(listed)), "array<struct<keywords:array<string>,rules:array<struct<priority:int,label:string,pattern:string,confidence:double>>>>")


_KIND = "struct<start:bigint,back:bigint,priority:int,label:string,confidence:double>"


def _settled(run: Column) -> Column:
    """What is left of detections, by start: by priority, each that neither crosses one already left nor lies in one; then none that lies in another."""
    ranked = F.array_sort(F.transform(run, lambda d: F.struct(d["priority"].alias("rank"), d.alias("d"))))

    def step(kept: Column, r: Column) -> Column:
        d = r["d"]
        # They overlap, and the one already left does not lie in the new one.
        beaten = F.exists(kept, lambda k: (d["start"] < -k["back"]) & (k["start"] < -d["back"]) & ~((d["start"] <= k["start"]) & (d["back"] <= k["back"]) & ((d["start"] < k["start"]) | (d["back"] < k["back"]))))
        return F.when(beaten, kept).otherwise(F.concat(kept, F.array(d)))

    kept = F.aggregate(ranked, F.expr(f"cast(array() as array<{_KIND}>)"), step)
    # By start, longest first, so that what holds another one comes before it; nothing crosses.
    nothing = F.struct(F.lit(-1).cast("bigint").alias("reach"), F.expr(f"cast(array() as array<{_KIND}>)").alias("outer"))
    return F.aggregate(
        F.array_sort(kept),
        nothing,
        lambda so_far, d: F.when(d["start"] < so_far["reach"], so_far).otherwise(F.struct((-d["back"]).alias("reach"), F.concat(so_far["outer"], F.array(d)).alias("outer"))),
        lambda done: done["outer"],
    )


def _resolved(found: Column) -> Column:
    """Detections by start, without those inside another one or crossing one of higher priority; runs of overlapping ones are settled one by one."""
    none = F.expr(f"cast(array() as array<{_KIND}>)")
    nothing = F.struct(F.lit(-1).cast("bigint").alias("reach"), none.alias("run"), none.alias("kept"))

    def step(so_far: Column, d: Column) -> Column:
        fresh = d["start"] >= so_far["reach"]
        return F.struct(
            F.greatest(so_far["reach"], -d["back"]).alias("reach"),
            F.when(fresh, F.array(d)).otherwise(F.concat(so_far["run"], F.array(d))).alias("run"),
            F.when(fresh, F.concat(so_far["kept"], _settled(so_far["run"]))).otherwise(so_far["kept"]).alias("kept"),
        )

    return F.aggregate(F.array_sort(found), nothing, step, lambda done: F.concat(done["kept"], _settled(done["run"])))


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns, with ``n_words``, ``base`` and ``licenses``; columns of these names are replaced.

    ``base`` lists every place (start, end, label) where the words of a base phrase stand one after the other. ``licenses`` lists the detections
    that are left (start, end, label, confidence), by start. Words are numbered from 0. A NULL or empty text has no words and no
    detections. No row depends on another one.
    """
    added = ("n_words", "base", "licenses")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c not in added]).alias("row"), words_of(F.col(text)).alias("plain"))
    gated = rows.select("row", (_spaces(F.col("plain")) - 1).alias("n_words"), F.when(F.col("plain").rlike(gate()), F.col("plain")).alias("plain"))
    base = []
    for phrase, label in BASE:
        here = places(F.col("plain"), F.lit(f"(?<= ){phrase}(?= )"))
        base.append(F.when(F.contains("plain", F.lit(phrase)), F.transform(here, _labelled(label))).otherwise(F.expr("cast(array() as array<struct<start:bigint,end:bigint,label:string>>)")))
    likely = F.filter(_rules(), lambda g: F.exists(g["keywords"], lambda k: F.contains(F.col("plain"), k)))
    matching = F.filter(F.flatten(F.transform(likely, lambda g: g["rules"])), lambda r: F.rlike(F.col("plain"), r["pattern"]))
    found = F.flatten(
        F.transform(
            matching,
            lambda r: F.transform(
                places(F.col("plain"), r["pattern"]),
                lambda p: F.struct(p["start"].alias("start"), (-p["end"]).alias("back"), r["priority"].alias("priority"), r["label"].alias("label"), r["confidence"].alias("confidence")),
            ),
        )
    )
    none = F.expr("cast(array() as array<struct<start:bigint,end:bigint,label:string,confidence:double>>)")
    kept = F.transform(_resolved(found), lambda d: F.struct(d["start"].alias("start"), (-d["back"]).alias("end"), d["label"].alias("label"), d["confidence"].alias("confidence")))
    ordered_base = F.array_sort(F.concat(*base))
    looked = F.col("plain").isNotNull()
    no_base = F.expr("cast(array() as array<struct<start:bigint,end:bigint,label:string>>)")
    return gated.select("row.*", "n_words", F.when(looked, ordered_base).otherwise(no_base).alias("base"), F.when(looked, kept).otherwise(none).alias("licenses"))


def _labelled(label: str):
    return lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), F.lit(label).alias("label"))
