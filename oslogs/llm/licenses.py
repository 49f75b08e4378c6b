"""License scans by ordered signature rules.

Every rule is a regular expression with a label, a priority and a keyword. One pass of a keyword automaton over a text tells
which rules can match at all; only those are tried. Detections are then taken in the order of priority (then length, then
place), and one that lies within an accepted detection is suppressed: the version inside a full statement, the general
name inside a more special one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oslogs.llm.common import map_batches

# Phrases that always count, with their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Signatures by family: label, name as written (pattern), short forms (pattern), versions, keywords (name, short form). Keywords
# parted by | stand for alternatives, one of which is in every text that matches.
FAMILIES = [
    ("gpl", r"gnu general public licen[cs]e", r"gpl|gnu gpl", ("1", "2", "3"), ("general public", "gpl")),
    ("lgpl", r"(?:gnu )?(?:lesser|library) general public licen[cs]e", r"lgpl|gnu lgpl", ("2", "2.1", "3"), ("general public", "lgpl")),
    ("agpl", r"(?:gnu )?affero general public licen[cs]e", r"agpl|gnu agpl", ("1", "3"), ("affero", "agpl")),
    ("gfdl", r"(?:gnu )?free documentation licen[cs]e", r"gfdl|fdl", ("1.1", "1.2", "1.3"), ("free documentation", "fdl")),
    ("apache", r"apache (?:software )?licen[cs]e", r"apache|asl", ("1.0", "1.1", "2.0"), ("apache", "apache|asl")),
    ("mpl", r"mozilla public licen[cs]e", r"mpl", ("1.0", "1.1", "2.0"), ("mozilla", "mpl")),
    ("epl", r"eclipse public licen[cs]e", r"epl", ("1.0", "2.0"), ("eclipse public", "epl")),
    ("cpl", r"common public licen[cs]e", r"cpl", ("1.0",), ("common public", "cpl")),
    ("ipl", r"ibm public licen[cs]e", r"ipl", ("1.0",), ("ibm public", "ipl")),
    ("cddl", r"common development and distribution licen[cs]e", r"cddl", ("1.0", "1.1"), ("common development", "cddl")),
    ("cpal", r"common public attribution licen[cs]e", r"cpal", ("1.0",), ("public attribution", "cpal")),
    ("eupl", r"european union public licen[cs]e", r"eupl", ("1.0", "1.1", "1.2"), ("european union", "eupl")),
    ("afl", r"academic free licen[cs]e", r"afl", ("1.1", "1.2", "2.0", "2.1", "3.0"), ("academic free", "afl")),
    ("osl", r"open software licen[cs]e", r"osl", ("1.0", "1.1", "2.0", "2.1", "3.0"), ("open software", "osl")),
    ("artistic", r"(?:perl )?artistic licen[cs]e", r"artistic", ("1.0", "2.0"), ("artistic", "artistic")),
    ("bsl", r"boost software licen[cs]e", r"bsl", ("1.0",), ("boost software", "bsl")),
    ("ofl", r"(?:sil )?open font licen[cs]e", r"ofl", ("1.0", "1.1"), ("open font", "ofl")),
    ("zpl", r"zope public licen[cs]e", r"zpl", ("1.1", "2.0", "2.1"), ("zope", "zpl")),
    ("psf", r"python software foundation licen[cs]e", r"psf|psfl", ("2",), ("python software", "psf")),
    ("python", r"python licen[cs]e", r"cnri python", ("2.0",), ("python", "cnri")),
    ("php", r"php licen[cs]e", r"php licensed", ("3.0", "3.01"), ("php", "php")),
    ("ruby", r"ruby licen[cs]e", r"ruby licensed", (), ("ruby", "ruby")),
    ("lppl", r"latex project public licen[cs]e", r"lppl", ("1.0", "1.1", "1.2", "1.3a", "1.3c"), ("latex project", "lppl")),
    ("cecill", r"cecill(?: free software)? licen[cs]e", r"cecill", ("1.0", "1.1", "2.0", "2.1"), ("cecill", "cecill")),
    ("ms-pl", r"microsoft public licen[cs]e", r"ms pl", (), ("microsoft public", "pl")),
    ("ms-rl", r"microsoft reciprocal licen[cs]e", r"ms rl", (), ("microsoft reciprocal", "rl")),
    ("busl", r"business source licen[cs]e", r"busl", ("1.1",), ("business source", "busl")),
    ("sspl", r"server side public licen[cs]e", r"sspl", ("1",), ("server side", "sspl")),
    ("elastic", r"elastic licen[cs]e", r"elastic v", ("1.0", "2.0"), ("elastic", "elastic")),
    ("odbl", r"open database licen[cs]e", r"odbl", ("1.0",), ("open database", "odbl")),
    ("odc-by", r"open data commons attribution licen[cs]e", r"odc by", ("1.0",), ("open data commons", "odc")),
    ("pddl", r"public domain dedication and licen[cs]e", r"pddl", ("1.0",), ("public domain", "pddl")),
    ("qpl", r"q public licen[cs]e", r"qpl", ("1.0",), ("q public", "qpl")),
    ("apsl", r"apple public source licen[cs]e", r"apsl", ("1.0", "1.1", "1.2", "2.0"), ("apple public", "apsl")),
    ("nposl", r"non profit open software licen[cs]e", r"nposl", ("3.0",), ("non profit", "nposl")),
    ("rpl", r"reciprocal public licen[cs]e", r"rpl", ("1.1", "1.5"), ("reciprocal public", "rpl")),
    ("sissl", r"sun industry standards source licen[cs]e", r"sissl", ("1.1", "1.2"), ("sun industry", "sissl")),
    ("spl", r"sun public licen[cs]e", r"spl", ("1.0",), ("sun public", "spl")),
    ("ncsa", r"(?:university of illinois )?ncsa open source licen[cs]e", r"ncsa licensed", (), ("ncsa", "ncsa")),
    ("w3c", r"w3c software (?:notice and )?licen[cs]e", r"w3c licensed", (), ("w3c", "w3c")),
    ("upl", r"universal permissive licen[cs]e", r"upl", ("1.0",), ("universal permissive", "upl")),
    ("mulan", r"mulan permissive software licen[cs]e", r"mulanpsl", ("1.0", "2.0"), ("mulan", "mulan")),
    ("vim", r"vim licen[cs]e", r"vim licensed", (), ("vim", "vim")),
    ("openssl", r"openssl licen[cs]e", r"openssl licensed", (), ("openssl", "openssl")),
    ("mit", r"(?:mit|expat|x11) licen[cs]e", r"mit licensed", (), ("licen", "mit")),
    ("isc", r"isc licen[cs]e", r"isc licensed", (), ("isc", "isc")),
    ("zlib", r"zlib(?: libpng)? licen[cs]e", r"zlib licensed", (), ("zlib", "zlib")),
    ("bsd", r"bsd(?: style)? licen[cs]e", r"bsd licensed", (), ("bsd", "bsd")),
    ("unlicense", r"the unlicense", r"unlicense", (), ("unlicense", "unlicense")),
    ("wtfpl", r"do what the fuck you want to public licen[cs]e", r"wtfpl", ("1", "2"), ("do what the", "wtfpl")),
    ("beerware", r"beer ?ware licen[cs]e", r"beerware", (), ("ware", "beerware")),
]

# Short forms that are words or names as well: they count only as a license, or with one of its versions.
PLAIN = {"apache", "artistic", "elastic", "unlicense", "beerware", "psf", "mulan"}

# Sentences of license texts: label, pattern, keyword.
SENTENCES = [
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy", "hereby granted"),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "with or without fee"),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted", "binary forms"),
    ("bsd-3-clause", r"neither the names? of .{1,120}? may be used to endorse or promote products", "endorse or promote"),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display", "advertising materials"),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", "held liable"),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered"),
    ("bsl-1.0", r"permission is hereby granted free of charge to any person or organization obtaining a copy", "person or organization"),
    ("gpl", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e", "free software"),
    ("lgpl", r"this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[cs]e", "free software"),
    ("apache-2.0", r"licensed under the apache licen[cs]e version 2(?: 0)?", "apache"),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public licen[cs]e v(?:ersion)? ?2(?: 0)?", "source code form"),
    ("public-domain", r"(?:released|dedicated|placed) (?:in|in ?to|to) the public domain", "public domain"),
    ("proprietary", r"(?:proprietary and confidential|confidential and proprietary)", "proprietary"),
    ("all-rights-reserved", r"all rights reserved", "rights reserved"),
]

# Fixed values of Creative Commons: terms in short and in words, and versions.
CC_TERMS = {
    "by": "attribution", "by sa": "attribution share ?alike", "by nd": "attribution no ?deriv(?:ative)?s?", "by nc": "attribution non ?commercial",
    "by nc sa": "attribution non ?commercial share ?alike", "by nc nd": "attribution non ?commercial no ?deriv(?:ative)?s?",
}
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int  # the higher, the earlier
    keyword: str
    pattern: re.Pattern
    weight: float  # what a detection says for itself


def _rule(label: str, priority: int, keyword: str, pattern: str, weight: float) -> Rule:
    """Patterns are over words with one blank between; ends fall on words."""
    return Rule(label, priority, keyword, re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])"), weight)


def _version(text: str) -> str:
    """A version as words: 2.0 is also 2; 2.1 is two words."""
    major, _, minor = text.partition(".")
    return major + (rf"(?: {minor})?" if minor == "0" else rf" {minor}" if minor else r"(?: 0)?")


def rules() -> list[Rule]:
    """All rules, in the order of priority."""
    out = []
    lead = r"(?: (?:version|v|ver))? ?v?"
    for label, name, short, versions, (name_key, short_key) in FAMILIES:
        out.append(_rule(label, 10, name_key, name, 0.8))
        said = rf"(?:{short}) licen[cs]ed?|licen[cs]ed? (?:under |is )?(?:the )?(?:{short})"
        alone = label not in PLAIN and (len(short) > 3 or not versions)
        out.append(_rule(label, 10, short_key, rf"{said}|{short}" if alone else said, 0.5))
        for v in versions:
            full = f"{label}-{v if '.' in v or label not in ('gpl', 'lgpl', 'agpl') else v + '.0'}"
            numbered = rf"(?:{lead}{_version(v)}(?! [0-9]))"  # 2 4 is no version 2
            out.append(_rule(full, 30, name_key, name + numbered, 1.0))
            out.append(_rule(full, 25, short_key, rf"(?:{short})(?: licen[cs]e)?{numbered}", 0.9))
            if label in ("gpl", "lgpl", "agpl", "gfdl"):
                later = r"(?: (?:of the licen[cs]e )?(?:or at your option any later version|or any later version|or later)| plus)"
                out.append(_rule(full + "-or-later", 40, name_key, name + numbered + later, 1.0))
                out.append(_rule(full + "-or-later", 35, short_key, rf"(?:{short})(?: licen[cs]e)?{numbered}{later}", 0.9))
                out.append(_rule(full + "-only", 40, name_key, name + numbered + r" only", 1.0))
                out.append(_rule(full + "-only", 35, short_key, rf"(?:{short})(?: licen[cs]e)?{numbered} only", 0.9))
    for clauses, words in (("0", "zero|0"), ("1", "one|1"), ("2", "two|2|simplified|freebsd"), ("3", "three|3|new|modified|revised"), ("4", "four|4|original")):
        label = f"{clauses}bsd" if clauses == "0" else f"bsd-{clauses}-clause"
        out.append(_rule(label, 30, "bsd", rf"(?:{words})(?: clause)? bsd(?: licen[cs]e)?", 1.0))
        out.append(_rule(label, 30, "bsd", rf"bsd (?:licen[cs]e )?(?:{words}) clause(?: licen[cs]e)?", 1.0))
    for terms, words in CC_TERMS.items():
        label = "cc-" + terms.replace(" ", "-")
        more = 2 * len(terms.split())
        out.append(_rule(label, 10 + more, "cc", rf"cc {terms}(?: licen[cs]e)?", 0.8))
        out.append(_rule(label, 10 + more, "creative commons", rf"creative commons {words}(?: licen[cs]e)?", 0.9))
        for v in CC_VERSIONS:
            out.append(_rule(f"{label}-{v}", 30 + more, "cc", rf"cc {terms}{lead}{_version(v)}", 1.0))
            out.append(_rule(f"{label}-{v}", 30 + more, "creative commons", rf"creative commons {words}(?: licen[cs]e)?(?: international| unported| generic)?{lead}{_version(v)}", 1.0))
            out.append(_rule(f"{label}-{v}", 30 + more, "creativecommons", rf"creativecommons org licenses {terms} {_version(v)}", 1.0))
    out.append(_rule("cc0-1.0", 30, "cc0", r"cc0(?: 1 0)?(?: universal)?", 1.0))
    out.append(_rule("cc0-1.0", 30, "creativecommons", r"creativecommons org publicdomain zero 1 0", 1.0))
    out.append(_rule("cc", 5, "creative commons", r"creative commons(?: licen[cs]e)?", 0.6))
    out += [_rule(label, 50, keyword, pattern, 1.0) for label, pattern, keyword in SENTENCES]
    out.append(Rule("spdx", 60, "spdx", re.compile(r"(?<![^ ])spdx licen[cs]e identifier (?P<name>[0-9a-z]+(?: [0-9]+)*(?: (?:only|or later|clause))?)(?![^ ])"), 1.0))
    return sorted(out, key=lambda r: -r.priority)


# Bytes that belong to words: digits, small letters, and all of any sign beyond ASCII. Everything else parts them.
_TO_WORDS = bytes(b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


@dataclass(frozen=True)
class Detection:
    label: str
    priority: int
    weight: float
    first: int  # word numbers, both included
    last: int
    text: str


class Scanner:
    def __init__(self):
        self.rules = rules()
        self.automaton = ahocorasick.Automaton()
        by: dict[str, list[int]] = {}
        for i, rule in enumerate(self.rules):
            for keyword in rule.keyword.split("|"):
                by.setdefault(keyword, []).append(i)
        for phrase in BASE:
            by.setdefault(phrase, [])
        for keyword, numbers in by.items():
            self.automaton.add_word(keyword, (keyword, numbers))
        self.automaton.make_automaton()

    @staticmethod
    def words(text: str) -> bytes:
        """The words of a text between single blanks."""
        return b" ".join(text.encode().lower().translate(_TO_WORDS).split())

    @staticmethod
    def base(line: bytes) -> list[tuple[int, str]]:
        """Word number and label of every place of a base phrase."""
        padded, out = b" " + line + b" ", []
        for phrase, label in BASE.items():
            wanted, at, number, counted = b" " + phrase.encode() + b" ", -1, 0, 0
            while (at := padded.find(wanted, at + 1)) >= 0:
                number += padded.count(b" ", counted, at)  # words since the last place
                counted = at
                out.append((number, label))
        return out

    def detections(self, line: str) -> list[Detection]:
        """What stands after suppression, by place."""
        numbers: set[int] = set()
        for _, (_, found) in self.automaton.iter(line):
            numbers.update(found)
        hits = []
        for i in sorted(numbers):
            rule = self.rules[i]
            for m in rule.pattern.finditer(line):
                label = re.sub(r"(\d)-(?=\d)", r"\1.", m["name"].replace(" ", "-")) if rule.label == "spdx" else rule.label
                hits.append((-rule.priority, -(m.end() - m.start()), m.start(), i, m.end(), label))
        starts = {start: k for k, start in enumerate(sorted({h[2] for h in hits}), 1)}
        reach = [0] * (len(starts) + 1)  # a Fenwick tree: how far what is accepted reaches, by where it starts
        kept: list[tuple[int, int, int, str]] = []
        for _, _, start, i, end, label in sorted(hits):
            k, furthest = starts[start], 0
            while k:
                furthest = max(furthest, reach[k])
                k -= k & -k
            if furthest < end:
                kept.append((start, end, i, label))
                k = starts[start]
                while k < len(reach):
                    reach[k] = max(reach[k], end)
                    k += k & -k
        kept.sort()
        out, number, counted = [], 0, 0
        for a, b, i, label in kept:
            number += line.count(" ", counted, a)
            counted = a
            out.append(Detection(label, self.rules[i].priority, self.rules[i].weight, number, number + line.count(" ", a, b), line[a:b]))
        return out

    def scan(self, text: str | None) -> tuple[int, list[tuple[int, str]], list[Detection]]:
        line = self.words(text or "")
        n = line.count(b" ") + 1 if line else 0
        return (n, self.base(line), self.detections(line.decode())) if n else (0, [], [])


_SCANNER: list[Scanner] = []


def scanner() -> Scanner:
    if not _SCANNER:
        _SCANNER.append(Scanner())
    return _SCANNER[0]


def _scanned(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))


def detections(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each detection left after suppression: id_col, label, priority, first_word, last_word and matched words.

    Words are runs of letters, digits and signs beyond ASCII, A-Z in lower case. A text that is null, empty or without a
    license has no row; repeated rows are scanned each; other columns are not read.
    """

    def rows(batches) -> Iterator[dict]:
        scan = scanner().scan
        for batch in batches:
            found = [(key, d) for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for d in scan(text)[2]]
            yield {
                "id": [k for k, _ in found], "label": [d.label for _, d in found], "priority": [d.priority for _, d in found],
                "first_word": [d.first for _, d in found], "last_word": [d.last for _, d in found], "matched": [d.text for _, d in found],
            }

    schema = "id bigint, label string, priority int, first_word bigint, last_word bigint, matched string"
    return map_batches(_scanned(df, id_col, text_col), rows, schema).withColumnRenamed("id", id_col)


def license_summary(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each row of df: id_col, n_words, n_base, first_word, last_word, base_labels, labels and score.

    n_base, first_word and last_word are of the base phrases' places; labels holds base labels and those of the rules;
    score is the weight of the strongest detection (a base phrase alone: 0.8; none: 0). A null text counts as empty.
    """

    def rows(batches) -> Iterator[dict]:
        scan = scanner().scan
        for batch in batches:
            out: dict[str, list] = {k: [] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")}
            for text in batch.column(1).to_pylist():
                n, base, found = scan(text)
                names = {label for _, label in base}
                out["n_words"].append(n)
                out["n_base"].append(len(base))
                out["first_word"].append(min((i for i, _ in base), default=None))
                out["last_word"].append(max((i for i, _ in base), default=None))
                out["base_labels"].append(",".join(sorted(names)))
                out["labels"].append(",".join(sorted(names | {d.label for d in found})))
                out["score"].append(max([0.8 * bool(base), *(d.weight for d in found)]))
            yield {"id": batch.column(0)} | out

    schema = "id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, labels string, score double"
    return map_batches(_scanned(df, id_col, text_col), rows, schema).withColumnRenamed("id", id_col)
