"""License scan by ordered signature rules, DataFrame functions only.

Texts become words (lower-cased runs of ASCII letters, digits and non-ASCII characters). Every rule
hangs on an anchor word and asks for a keyword near it; a regex over the words around the anchor then
decides. Texts are gated three times: by one regex over all anchors, by (anchor, keyword)
pairs joined to the rule table, and by the rule's regex, which sees REACH words on either side of the anchor.
So a text without anchors costs one scan and no rule.

Rules come from families (names of a license) times templates (ways to mention one), in order, and from
hand-written signatures of license texts, versions, notices and expressions, each with its own
keywords; a smaller priority is stronger. A detection is suppressed when its interval of words lies inside
that of a detection of the same or a stronger priority (equal intervals: the earlier rule
stays). Base phrases have the strongest priority, are counted at all places and never suppressed.

Cases: null and wordless texts have no detections (score 0, empty labels); rows that repeat
doc_id and text are the same document and give one output row each; other columns are ignored; an
empty table gives an empty result; whole texts are scanned, whatever their length.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from driftline.llm.text import ALNUM_SEP, ascii_lower, doc_key, split_words

REACH = 12

# Base phrases (last word is the anchor) and their labels.
BASE = [("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")]

# label, [(keywords, names as a regex over words)]: every match of the names holds one of the keywords as a word
FAMILIES = [
    ("mit", [("mit", "mit(?: x11)?"), ("expat", "expat"), ("x11", "x11")]),
    ("apache", [("apache", "apache(?: software)?")]),
    ("agpl", [("affero", "(?:gnu )?affero general public"), ("agpl agplv3", "(?:gnu )?agpl(?:v3)?")]),
    ("lgpl", [("lesser", "(?:gnu )?lesser general public"), ("library", "(?:gnu )?library general public"), ("lgpl lgplv2 lgplv3", "(?:gnu )?lgpl(?:v2|v3)?")]),
    ("gpl", [("general", "(?:gnu )?general public"), ("gpl gplv2 gplv3", "(?:gnu )?gpl(?:v2|v3)?")]),
    ("bsd", [("bsd", "(?:[0-4] clause |new |modified |simplified )?bsd(?: [0-4] clause)?")]),
    ("mpl", [("mozilla", "mozilla public"), ("mpl", "mpl")]),
    ("epl", [("eclipse", "eclipse public"), ("epl", "epl")]),
    ("cddl", [("cddl", "cddl"), ("common", "common development and distribution")]),
    ("cc-by-nc", [("cc", "cc by nc(?: (?:sa|nd))?"), ("noncommercial commercial", "creative commons attribution non ?commercial")]),
    ("cc-by-sa", [("cc", "cc by sa"), ("sharealike alike", "creative commons attribution share ?alike")]),
    ("cc-by", [("cc", "cc by"), ("attribution", "creative commons attribution")]),
    ("cc0", [("cc0", "cc0"), ("zero", "creative commons zero")]),
    ("isc", [("isc", "isc")]),
    ("zlib", [("zlib", "zlib(?: libpng)?")]),
    ("boost", [("boost", "boost software"), ("bsl", "bsl")]),
    ("artistic", [("artistic", "artistic")]),
    ("unlicense", [("unlicense", "unlicense")]),
    ("wtfpl", [("wtfpl", "wtfpl")]),
    ("ofl", [("ofl", "(?:sil )?ofl"), ("font", "(?:sil )?open font")]),
    ("eupl", [("eupl", "eupl"), ("european", "european union public")]),
    ("psf", [("psf", "psf"), ("python", "python(?: software foundation)?")]),
    ("postgresql", [("postgresql", "postgresql")]),
    ("openssl", [("openssl", "openssl")]),
    ("php", [("php", "php")]),
    ("ms-pl", [("microsoft", "microsoft (?:public|reciprocal)")]),
]
# anchor, regex (@ is the anchor, {n} the names), priority, weight
_VERSION = "(?: v(?:ersion)? ?[0-9]+(?: [0-9]+)*| [0-9]+(?: [0-9]+)*)?"
TEMPLATES = [
    ("spdx", "@ license identifier {n}" + _VERSION, 1, 1.0),
    ("licensed", "@ (?:to you )?under (?:the )?(?:terms of (?:the )?)?{n}(?: license)?(?: version)?" + _VERSION, 1, 0.95),
    ("released", "@ under (?:the )?(?:terms of (?:the )?)?{n}(?: license)?(?: version)?" + _VERSION, 1, 0.9),
    ("distributed", "@ under (?:the )?(?:terms of (?:the )?)?{n}(?: license)?(?: version)?" + _VERSION, 1, 0.9),
    ("available", "@ under (?:the )?(?:terms of (?:the )?)?{n}(?: license)?(?: version)?" + _VERSION, 1, 0.9),
    ("license", "{n} @(?: version)?" + _VERSION, 2, 0.8),
    ("licence", "{n} @(?: version)?" + _VERSION, 2, 0.8),
    ("license", "@ (?:type |name |id )?(?:is )?(?:the )?{n}", 3, 0.6),
    ("licenses", "(?:the )?{n}(?: and \\S+)? @", 3, 0.5),
    ("terms", "@ of (?:the )?{n}", 3, 0.5),
]
# rules that need no family: anchor, keyword, regex, label, priority, weight
SINGLE = [
    ("reserved", "rights", "all rights @", "all-rights-reserved", 1, 0.7),
    ("domain", "public", "(?:in(?:to)? the |dedicated to the )?public @", "public-domain", 1, 0.7),
    ("copyright", "c", "@ c(?: [0-9]{4}(?: [0-9]{4})?)", "copyright-notice", 3, 0.3),
    ("warranty", "without", "without (?:any )?@ of any kind", "no-warranty", 3, 0.3),
]


# Hand-written signatures: wordings of license texts, versions, notices and expressions, as they read once
# punctuation has become blanks. (anchor, keywords of which the wording holds one, regex with @ for the
# anchor, label, priority, weight)
SIGNATURES = [
    # permissive license bodies
    ("hereby", "granted", "permission is @ granted free of charge to any person obtaining a copy", "mit-text", 1, 0.95),
    ("deal", "restriction", "to @ in the software without restriction", "mit-text", 1, 0.9),
    ("substantial", "portions", "included in all copies or @ portions of the software", "mit-text", 1, 0.9),
    ("noninfringement", "merchantability", "merchantability fitness for a particular purpose and @", "mit-text", 1, 0.8),
    ("evil", "good", "(?:the software )?shall be used for good not @", "json", 1, 0.95),
    ("advertising", "authors", "shall not be used in @ or otherwise to promote the sale", "x11-text", 1, 0.9),
    ("fee", "granted", "modify and(?: or)? distribute this software for any purpose with or without @ is hereby granted", "isc-text", 1, 0.95),
    ("fee", "documentation", "distribute this software and its documentation for any purpose (?:and|with or) without @ is hereby granted", "hpnd", 1, 0.95),
    ("redistribution", "binary", "@ and use in source and binary forms with or without modification are permitted", "bsd-text", 1, 0.95),
    ("redistributions", "retain", "@ of source code must retain the above copyright notice", "bsd-text", 1, 0.9),
    ("redistributions", "reproduce", "@ in binary form must reproduce the above copyright notice", "bsd-text", 1, 0.9),
    ("endorse", "promote", "(?:may|must not) be used to @ or promote products derived from this software", "bsd-3-clause", 1, 0.95),
    ("endorse", "neither", "neither the names? of .{1,60} to @ or promote products", "bsd-3-clause", 1, 0.9),
    ("acknowledgement", "advertising", "all advertising materials mentioning features or use of this software must display the following @", "bsd-4-clause", 1, 0.95),
    ("clause", "bsd", "bsd 2 @(?: simplified)?(?: licen[sc]e)?", "bsd-2-clause", 1, 0.9),
    ("clause", "bsd", "bsd 3 @(?: new| revised)?(?: licen[sc]e)?", "bsd-3-clause", 1, 0.9),
    ("clause", "bsd", "bsd 4 @(?: original)?(?: licen[sc]e)?", "bsd-4-clause", 1, 0.9),
    ("clause", "bsd", "(?:2|two) @ bsd(?: licen[sc]e)?", "bsd-2-clause", 1, 0.9),
    ("clause", "bsd", "(?:3|three) @ bsd(?: licen[sc]e)?", "bsd-3-clause", 1, 0.9),
    ("clause", "bsd", "(?:4|four) @ bsd(?: licen[sc]e)?", "bsd-4-clause", 1, 0.9),
    ("0bsd", "license licence spdx under zero", "(?:spdx license identifier |under (?:the )?|zero clause bsd )?@(?: licen[sc]e)?", "0bsd", 1, 0.8),
    ("unaltered", "misrepresented", "must not be misrepresented .{0,60}@", "zlib-text", 1, 0.8),
    ("misrepresented", "origin", "the origin of this software must not be @", "zlib-text", 1, 0.95),
    ("implied", "arising", "provided as is without any express or @ warranty in no event will the authors be held liable", "zlib-text", 1, 0.8),
    ("obtaining", "organization", "any person or organization @ a copy of the software and accompanying documentation covered by this license", "boost-text", 1, 0.95),
    ("executable", "generated", "machine @ object code generated by a source language processor", "boost-text", 1, 0.9),
    ("unencumbered", "domain", "this is free and @ software released into the public domain", "unlicense-text", 1, 0.95),
    ("compile", "publish", "anyone is free to copy modify publish use @ sell or distribute this software", "unlicense-text", 1, 0.95),
    ("beer", "buy", "you can buy me a @ in return", "beerware", 1, 0.95),
    ("fuck", "want", "(?:you )?(?:just )?do what the @ you want to", "wtfpl-text", 1, 0.95),
    ("ncsa", "illinois university open license", "(?:university of illinois )?@(?: open source)? licen[sc]e", "ncsa", 1, 0.9),
    ("upl", "permissive universal", "universal permissive licen[sc]e(?: v(?:ersion)? ?1 0)? @", "upl", 1, 0.9),
    ("ecl", "educational community", "educational community licen[sc]e .{0,20}@", "ecl", 1, 0.8),
    ("mulan", "permissive psl", "@ (?:psl|permissive software licen[sc]e)(?: v(?:ersion)? ?[12])?", "mulan-psl", 1, 0.9),
    ("oak", "blue model", "blue @ model licen[sc]e(?: 1 0 0)?", "blueoak", 1, 0.9),
    ("curl", "copyright license", "@ licen[sc]e", "curl", 1, 0.7),
    ("vim", "license licence", "@ licen[sc]e", "vim", 1, 0.7),
    ("ruby", "license licence", "@ licen[sc]e", "ruby", 1, 0.7),
    ("w3c", "notice software", "@(?: r)? software(?: and document)? (?:notice and )?licen[sc]e", "w3c", 1, 0.9),
    ("zpl", "zope", "zope public licen[sc]e .{0,20}@", "zpl", 1, 0.9),
    ("afl", "academic", "academic free licen[sc]e .{0,20}@", "afl", 1, 0.9),
    # apache
    ("apache", "version", "@ (?:software )?licen[sc]e(?: version| v)? 2 0", "apache-2.0", 1, 0.95),
    ("apache", "license licence under spdx or", "@ 2 0", "apache-2.0", 2, 0.7),
    ("apache", "version", "@ (?:software )?licen[sc]e(?: version| v)? 1 1", "apache-1.1", 1, 0.95),
    ("compliance", "license", "you may not use this file except in @ with the license", "apache-2.0", 1, 0.9),
    ("conditions", "warranties", "basis without warranties or @ of any kind either express or implied", "apache-2.0", 1, 0.9),
    ("governing", "permissions", "see the license for the specific language @ permissions and limitations under the license", "apache-2.0", 1, 0.95),
    # gnu
    ("version", "general", "general public licen[sc]e(?: gpl)?(?: as published by the free software foundation)?(?: either)? @ 2(?: of the licen[sc]e)?", "gpl-2.0", 1, 0.95),
    ("version", "general", "general public licen[sc]e(?: gpl)?(?: as published by the free software foundation)?(?: either)? @ 3(?: of the licen[sc]e)?", "gpl-3.0", 1, 0.95),
    ("version", "lesser library", "(?:lesser|library) general public licen[sc]e(?: lgpl)?(?: as published by the free software foundation)?(?: either)? @ 2(?: 1)?(?: of the licen[sc]e)?", "lgpl-2.1", 1, 0.95),
    ("version", "lesser", "lesser general public licen[sc]e(?: lgpl)?(?: as published by the free software foundation)?(?: either)? @ 3(?: of the licen[sc]e)?", "lgpl-3.0", 1, 0.95),
    ("version", "affero", "affero general public licen[sc]e(?: agpl)?(?: as published by the free software foundation)?(?: either)? @ 3(?: of the licen[sc]e)?", "agpl-3.0", 1, 0.95),
    ("option", "later", "(?:or )?at your @ any later version", "or-later", 2, 0.6),
    ("redistribute", "modify", "you can @ it and or modify it under the terms of the gnu", "gpl-notice", 1, 0.9),
    ("merchantability", "implied", "without even the implied warranty of @ or fitness for a particular purpose", "gpl-notice", 1, 0.85),
    ("gnu", "received", "you should have received a copy of the @ (?:lesser |library |affero )?general public licen[sc]e", "gpl-notice", 1, 0.95),
    ("franklin", "foundation", "free software foundation inc .{0,20}@ street", "gpl-notice", 1, 0.8),
    ("gpl", "2", "@ 2 0(?: (?:only|or later))?", "gpl-2.0", 1, 0.85),
    ("gpl", "3", "@ 3 0(?: (?:only|or later))?", "gpl-3.0", 1, 0.85),
    ("lgpl", "2", "@ 2 [01](?: (?:only|or later))?", "lgpl-2.1", 1, 0.85),
    ("lgpl", "3", "@ 3 0(?: (?:only|or later))?", "lgpl-3.0", 1, 0.85),
    ("agpl", "3", "@ 3 0(?: (?:only|or later))?", "agpl-3.0", 1, 0.85),
    ("gfdl", "license licence documentation gnu", "@(?: 1 [123])?", "gfdl", 2, 0.7),
    ("documentation", "gnu free", "gnu free @ licen[sc]e(?: version 1 [123])?", "gfdl", 1, 0.95),
    ("invariant", "sections", "with no @ sections no front cover texts and no back cover texts", "gfdl", 1, 0.95),
    ("exception", "classpath", "with (?:the )?(?:gnu )?classpath @(?: 2 0)?", "classpath-exception", 1, 0.9),
    ("exception", "gcc runtime", "gcc runtime library @(?: version)?(?: 3 1)?", "gcc-exception", 1, 0.9),
    ("exception", "linking", "(?:as a special|with (?:a|the)) (?:linking )?@", "linking-exception", 2, 0.5),
    ("exception", "llvm", "(?:with )?llvm @s?", "llvm-exception", 1, 0.9),
    # weak copyleft
    ("mozilla", "version v", "@ public licen[sc]e(?: mpl)?(?: version| v) 2 0", "mpl-2.0", 1, 0.95),
    ("mozilla", "version v", "@ public licen[sc]e(?: mpl)?(?: version| v) 1 1", "mpl-1.1", 1, 0.95),
    ("subject", "mozilla", "source code form is @ to the terms of the mozilla public licen[sc]e", "mpl-2.0", 1, 0.95),
    ("mpl", "2", "@ 2 0", "mpl-2.0", 1, 0.85),
    ("eclipse", "v1 v2 version v", "@ public licen[sc]e(?: epl)?(?: version| v)? ?2 0", "epl-2.0", 1, 0.95),
    ("eclipse", "v1 v2 version v", "@ public licen[sc]e(?: epl)?(?: version| v)? ?1 0", "epl-1.0", 1, 0.95),
    ("accompanying", "eclipse", "this program and the @ materials are made available under the terms of the eclipse public licen[sc]e", "epl-notice", 1, 0.95),
    ("cpl", "common", "common public licen[sc]e .{0,20}@", "cpl", 1, 0.9),
    ("ibm", "public", "@ public licen[sc]e(?: version)?(?: 1 0)?", "ipl", 1, 0.9),
    ("cddl", "1", "@ 1 [01]", "cddl-1", 1, 0.85),
    ("artistic", "2", "@ licen[sc]e 2 0", "artistic-2.0", 1, 0.95),
    ("perl", "same", "(?:under )?the same terms as @(?: itself)?", "perl", 1, 0.9),
    ("lppl", "latex", "latex project public licen[sc]e .{0,20}@", "lppl", 1, 0.9),
    ("latex", "project", "@ project public licen[sc]e", "lppl", 1, 0.9),
    ("osl", "open", "open software licen[sc]e .{0,20}@", "osl", 1, 0.9),
    ("qpl", "public q", "q public licen[sc]e .{0,20}@", "qpl", 1, 0.9),
    ("sissl", "sun", "sun industry standards source licen[sc]e .{0,20}@", "sissl", 1, 0.9),
    ("apsl", "apple", "apple public source licen[sc]e .{0,20}@", "apsl", 1, 0.9),
    ("apple", "public", "@ public source licen[sc]e", "apsl", 1, 0.9),
    ("eupl", "1", "@(?: v)? 1 [012]", "eupl", 1, 0.9),
    ("cecill", "license licence free", "@(?: [bc])?(?: free software licen[sc]e)?", "cecill", 2, 0.8),
    ("reciprocal", "microsoft", "microsoft @ licen[sc]e", "ms-rl", 1, 0.95),
    # other families' bodies
    ("sil", "font", "@ open font licen[sc]e(?: ofl)?(?: version)? 1 1", "ofl-1.1", 1, 0.95),
    ("reserved", "font", "with (?:the )?@ font names?", "ofl-1.1", 1, 0.8),
    ("psf", "python", "python software foundation licen[sc]e .{0,30}@", "psf", 1, 0.9),
    ("cryptographic", "young", "this package is an? ssl implementation written by eric young|@ software written by eric young", "openssl-text", 1, 0.9),
    ("toolkit", "openssl", "developed by the openssl project for use in the openssl @", "openssl-text", 1, 0.95),
    ("postgresql", "database", "@ database management system", "postgresql-text", 2, 0.6),
    ("php", "3", "(?:the )?@ licen[sc]e(?: version)? 3 0[01]?", "php-3", 1, 0.95),
    # creative commons
    ("attribution", "4", "creative commons @ 4 0(?: international)?", "cc-by-4.0", 1, 0.95),
    ("attribution", "3", "creative commons @ 3 0(?: unported)?", "cc-by-3.0", 1, 0.95),
    ("sharealike", "4", "creative commons attribution @ 4 0(?: international)?", "cc-by-sa-4.0", 1, 0.95),
    ("sharealike", "3", "creative commons attribution @ 3 0(?: unported)?", "cc-by-sa-3.0", 1, 0.95),
    ("noncommercial", "4", "creative commons attribution @(?: sharealike| noderiv(?:ative)?s)? 4 0(?: international)?", "cc-by-nc-4.0", 1, 0.95),
    ("cc", "4", "@ by 4 0", "cc-by-4.0", 1, 0.9),
    ("cc", "4", "@ by sa 4 0", "cc-by-sa-4.0", 1, 0.9),
    ("cc", "4", "@ by nc(?: sa| nd)? 4 0", "cc-by-nc-4.0", 1, 0.9),
    ("cc", "4 nd", "@ by nd 4 0", "cc-by-nd-4.0", 1, 0.9),
    ("creativecommons", "licenses", "@ org licenses by(?: nc)?(?: sa| nd)? [1-4] [05]", "cc-link", 1, 0.95),
    ("creativecommons", "zero", "@ org publicdomain zero 1 0", "cc0", 1, 0.95),
    ("cc0", "1", "@ 1 0(?: universal)?", "cc0", 1, 0.95),
    ("waive", "rights", "(?:has|have|hereby|irrevocably)? ?@(?:d)? all (?:copyright|of (?:his|her|their) rights|rights)", "cc0", 2, 0.6),
    ("ogl", "government", "open government licen[sc]e .{0,20}@", "ogl-uk", 1, 0.9),
    ("government", "open", "open @ licen[sc]e(?: v(?:ersion)? ?[123](?: 0)?)?", "ogl-uk", 1, 0.9),
    ("odbl", "database open", "(?:open (?:data commons open )?database licen[sc]e )?@", "odbl", 2, 0.7),
    ("database", "open", "open (?:data commons open )?@ licen[sc]e", "odbl", 1, 0.9),
    # source available and proprietary
    ("sspl", "server side", "server side public licen[sc]e .{0,20}@", "sspl", 1, 0.95),
    ("server", "side", "@ side public licen[sc]e", "sspl", 1, 0.95),
    ("busl", "1", "@ 1 1", "busl-1.1", 1, 0.9),
    ("business", "source", "@ source licen[sc]e(?: 1 1)?", "busl-1.1", 1, 0.95),
    ("elastic", "2", "@ licen[sc]e 2 0", "elastic-2.0", 1, 0.95),
    ("commons", "clause", "@ clause(?: licen[sc]e condition)?", "commons-clause", 1, 0.9),
    ("polyform", "noncommercial shield perimeter business strict", "@ (?:noncommercial|shield|perimeter|strict|small business)(?: licen[sc]e)?", "polyform", 1, 0.9),
    ("confidential", "proprietary", "(?:proprietary and @|@ and proprietary)", "proprietary", 1, 0.8),
    ("prohibited", "unauthorized", "unauthori[sz]ed (?:copying|use|reproduction|distribution) .{0,60}@", "proprietary", 1, 0.8),
    ("personal", "commercial", "for @ (?:and )?non ?commercial use only", "non-commercial", 1, 0.8),
    ("noncommercial", "only", "for @ (?:use|purposes) only", "non-commercial", 1, 0.8),
    ("evaluation", "only", "for @ purposes only", "evaluation-only", 1, 0.7),
    ("eula", "agreement", "end user licen[sc]e agreement @|@", "eula", 2, 0.6),
    ("agreement", "user", "end user licen[sc]e @", "eula", 1, 0.9),
    # expressions
    ("apache", "mit", "(?:@ 2 0 or mit|mit or @ 2 0)", "expr-apache-or-mit", 1, 0.95),
    ("gpl", "or", "(?:mit|bsd|bsd [23] clause|apache 2 0) or @ [23] 0(?: (?:only|or later))?", "expr-or-gpl", 1, 0.9),
    ("gpl", "or", "@ [23] 0(?: (?:only|or later))? or (?:mit|bsd [23] clause|bsd|apache 2 0)", "expr-or-gpl", 1, 0.9),
    ("dual", "licensed", "@ licensed under", "dual-licensed", 1, 0.8),
    ("dually", "licensed", "@ licensed under", "dual-licensed", 1, 0.8),
    ("tri", "licensed license", "@ licen[sc]ed?", "tri-licensed", 2, 0.6),
    ("sublicense", "grant", "(?:right to )?(?:grant|use copy modify merge publish distribute) @", "sublicense-grant", 3, 0.4),
]


def signature_rules() -> list[tuple]:
    """(order, anchor, keyword, regex, label, priority, weight) of every rule, base rules first; a
    rule whose names can be spelt without a common word has one row per keyword."""
    found = [(p.split()[-1], p.split()[0], " ".join([*p.split()[:-1], "@"]), label, 0, 0.9) for p, label in BASE]
    found += [(anchor, keyword, regex.replace("{n}", f"(?:{names})"), label, priority, weight)
              for anchor, regex, priority, weight in TEMPLATES for label, family in FAMILIES for keyword, names in family]
    found += SINGLE + SIGNATURES
    return [(i, a, k, f"(?<![^ ])(?:{r.replace('@', f'<{a}>')})(?![^ ])", label, p, w)
            for i, (a, keywords, r, label, p, w) in enumerate(found) for k in keywords.split()]


def any_of(words: list[str]) -> str:
    """A regex for the beginning of any of the words, shared beginnings spelt once: a position is given up
    at its first wrong character, however many words there are."""
    heads: dict[str, list[str]] = {}
    for w in sorted(set(words)):
        heads.setdefault(w[:1], []).append(w[1:])
    if "" in heads:
        return ""
    parts = [head + (any_of(rest) if len(rest) > 1 else rest[0]) for head, rest in heads.items()]
    return f"(?:{'|'.join(parts)})"


def rule_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(signature_rules(), "rule int, anchor string, keyword string, regex string, label string, priority int, weight double")


def detections(docs: DataFrame) -> DataFrame:
    """(doc_id, _th, rule, label, priority, weight, first, last, kept): every place where a rule
    matches, as words [first, last), and whether it survives suppression."""
    rules = rule_table(docs.sparkSession)
    anchors = sorted({a for _, a, *_ in signature_rules()})
    text = ascii_lower(F.coalesce("text", F.lit("")))
    some = docs.select(*doc_key(), text.alias("t")).filter(F.regexp_like("t", F.lit(r"(?<![a-z0-9])" + any_of(anchors))))
    some = some.withColumn("w", split_words(F.col("t"), ALNUM_SEP))
    place = F.filter(F.transform("w", lambda w, i: F.struct(i.alias("at"), w.alias("anchor"))), lambda s: s.anchor.isin(anchors))
    near = some.select("doc_id", "_th", "w", F.explode(place).alias("p")).select("doc_id", "_th", "w", "p.*")
    lead = F.least("at", F.lit(REACH))
    before = F.slice("w", F.col("at") - lead + 1, lead)
    after = F.slice("w", F.col("at") + 2, F.lit(REACH))
    near = near.select("doc_id", "_th", "at", "anchor", lead.alias("lead"), F.concat(before, after).alias("around"),
                       F.array_join(F.concat(before, F.array(F.concat(F.lit("<"), "anchor", F.lit(">"))), after), " ").alias("ctx"))
    word = near.withColumn("keyword", F.explode(F.array_distinct("around"))).drop("around")
    hit = word.join(F.broadcast(rules), ["anchor", "keyword"]).withColumn("m", F.expr("regexp_extract(ctx, regex, 0)")).filter("m <> ''")
    skipped = F.expr("regexp_instr(ctx, regex)")
    blanks = lambda s: F.length(s) - F.length(F.replace(s, F.lit(" "), F.lit("")))
    first = F.col("at") - F.col("lead") + blanks(F.substring("ctx", F.lit(1), skipped - 1))
    hit = hit.withColumn("first", first).withColumn("last", F.col("first") + blanks(F.col("m")) + 1)
    hit = hit.select("doc_id", "_th", "rule", "label", "priority", "weight", "first", "last").distinct()
    # wider intervals first; what ends before the furthest end so far of a strong enough rule is inside it
    order = Window.partitionBy("doc_id", "_th").orderBy("first", F.col("last").desc(), "priority", "rule").rowsBetween(Window.unboundedPreceding, -1)
    levels = sorted({r[5] for r in signature_rules()})
    inside = F.lit(False)
    for level in levels:
        reach = F.max(F.when(F.col("priority") <= level, F.col("last"))).over(order)
        inside = F.when(F.col("priority") == level, F.coalesce(reach >= F.col("last"), F.lit(False))).otherwise(inside)
    return hit.withColumn("kept", (F.col("priority") == 0) | ~inside)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs`` (needs doc_id, text): doc_id, n_words, n_base, first_word,
    last_word, base_labels, labels and score (largest weight of a kept detection)."""
    base = F.col("priority") == 0
    text = lambda cond: F.array_join(F.sort_array(F.collect_set(F.when(cond, F.col("label")))), ",")
    per = detections(docs).groupBy("doc_id", "_th").agg(
        F.count(F.when(base, 1)).alias("n_base"), F.min(F.when(base, F.col("first"))).cast("bigint").alias("first_word"),
        F.max(F.when(base, F.col("first"))).cast("bigint").alias("last_word"), text(base).alias("base_labels"),
        text(F.col("kept")).alias("labels"), F.max(F.when(F.col("kept"), F.col("weight"))).alias("score"))
    words = F.size(split_words(ascii_lower(F.coalesce("text", F.lit(""))), ALNUM_SEP)).cast("bigint")
    every = docs.select(*doc_key(), words.alias("n_words"))
    same = F.col("d.doc_id").eqNullSafe(F.col("p.doc_id")) & (F.col("d._th") == F.col("p._th"))
    return every.alias("d").join(per.alias("p"), same, "left").select(
        "d.doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("bigint").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"))
