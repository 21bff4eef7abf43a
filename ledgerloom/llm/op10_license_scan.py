"""License scanning with ordered signature rules.

Rules are regular expressions over the lower-cased text, each with a label, a
priority and keywords: tags, expressions and identifiers, addresses, grants and
names of license families, and sentences of license texts and notices. An Aho-Corasick pass over the text finds the keywords
once; only rules whose keyword occurs are run. Detections that lie inside
another's span are suppressed when the outer one has the same or a higher
priority; of two equal spans the higher priority stays, then the earlier rule.
The surviving labels are the method's.

Three base phrases (cc by, general public license, all rights reserved) are
counted apart, as consecutive words; their labels always stay.

Words are maximal runs of digits, letters a-z (after lower-casing A-Z) and
code points from U+0080 on.

Defined results
  null or empty text     no words, no labels, score 0
  very long text         scanned whole
  overlapping phrases    every place counts
  tied detections        the earlier rule wins
  repeated rows          each row on its own
  empty table            no rows
  extra columns          ignored

score is 1 - prod(1 - weight) over the surviving detections' distinct labels,
weight 0.95 for a tag or URL, 0.8 for a grant or a license text's sentence, 0.5 for a bare name or
base phrase.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ledgerloom.llm.common import small_batches, table

# Base phrases and their labels.
BASE = {"cc-by": ("cc", "by"), "gpl": ("general", "public", "license"), "reserved": ("all", "rights", "reserved")}

# License families: label, name pattern (lower case; a space stands for any white
# space), and keywords, separated by |, one of which is in every match. A keyword
# holds no blank: a match may have any white space there.
FAMILIES = (
    ("mit", r"mit(?: /? ?expat)?", "mit"),
    ("mit-0", r"mit no attribution", "attribution"),
    ("x11", r"x11", "x11"),
    ("isc", r"isc", "isc"),
    ("apache-2.0", r"apache(?: software)? licen[cs]e,? ?(?:version |v\.? ?)?2(?:\.0)?", "apache"),
    ("apache-1.1", r"apache(?: software)? licen[cs]e,? ?(?:version |v\.? ?)?1\.1", "apache"),
    ("apache-1.0", r"apache(?: software)? licen[cs]e,? ?(?:version |v\.? ?)?1\.0", "apache"),
    ("bsd-0-clause", r"(?:(?:zero|0)[-\s]clause bsd|bsd[-\s](?:zero|0)[-\s]clause|0bsd)", "bsd"),
    ("bsd-2-clause", r"(?:(?:(?:two|2)[-\s]clause|simplified|freebsd) bsd|bsd[-\s](?:two|2)[-\s]clause)", "bsd"),
    ("bsd-3-clause", r"(?:(?:(?:three|3)[-\s]clause|new|revised|modified) bsd|bsd[-\s](?:three|3)[-\s]clause)", "bsd"),
    ("bsd-4-clause", r"(?:(?:(?:four|4)[-\s]clause|original) bsd|bsd[-\s](?:four|4)[-\s]clause)", "bsd"),
    ("agpl-3.0", r"(?:gnu )?(?:affero general public licen[cs]e|agpl),? ?(?:version |v\.? ?)?3(?:\.0)?", "affero|agpl"),
    ("lgpl-2.0", r"(?:gnu )?(?:library general public licen[cs]e|lgpl),? ?(?:version |v\.? ?)?2(?:\.0)?", "library|lgpl"),
    ("lgpl-2.1", r"(?:gnu )?(?:lesser general public licen[cs]e|lgpl),? ?(?:version |v\.? ?)?2\.1", "lesser|lgpl"),
    ("lgpl-3.0", r"(?:gnu )?(?:lesser general public licen[cs]e|lgpl),? ?(?:version |v\.? ?)?3(?:\.0)?", "lesser|lgpl"),
    ("gpl-1.0", r"(?:gnu )?(?:general public licen[cs]e|gpl),? ?(?:version |v\.? ?)?1(?:\.0)?", "general|gpl"),
    ("gpl-2.0", r"(?:gnu )?(?:general public licen[cs]e|gpl),? ?(?:version |v\.? ?)?2(?:\.0)?", "general|gpl"),
    ("gpl-3.0", r"(?:gnu )?(?:general public licen[cs]e|gpl),? ?(?:version |v\.? ?)?3(?:\.0)?", "general|gpl"),
    ("gfdl-1.3", r"(?:gnu )?(?:free documentation licen[cs]e|gfdl),? ?(?:version |v\.? ?)?1\.3", "documentation|gfdl"),
    ("mpl-1.1", r"(?:mozilla public licen[cs]e|mpl),? ?(?:version |v\.? ?)?1\.1", "mozilla|mpl"),
    ("mpl-2.0", r"(?:mozilla public licen[cs]e|mpl),? ?(?:version |v\.? ?)?2(?:\.0)?", "mozilla|mpl"),
    ("epl-1.0", r"(?:eclipse public licen[cs]e|epl),? ?(?:version |v\.? ?)?1\.0", "eclipse|epl"),
    ("epl-2.0", r"(?:eclipse public licen[cs]e|epl),? ?(?:version |v\.? ?)?2(?:\.0)?", "eclipse|epl"),
    ("cddl-1.0", r"(?:common development and distribution licen[cs]e|cddl)", "development|cddl"),
    ("cpl-1.0", r"common public licen[cs]e", "common"),
    ("eupl-1.2", r"(?:european union public licen[cs]e|eupl)", "european|eupl"),
    ("artistic-1.0", r"artistic licen[cs]e,? ?(?:version |v\.? ?)?1\.0", "artistic"),
    ("artistic-2.0", r"artistic licen[cs]e,? ?(?:version |v\.? ?)?2(?:\.0)?", "artistic"),
    ("bsl-1.0", r"boost software licen[cs]e", "boost"),
    ("busl-1.1", r"business source licen[cs]e", "business"),
    ("zlib", r"zlib(?:/libpng)?", "zlib"),
    ("openssl", r"openssl", "openssl"),
    ("unlicense", r"unlicen[cs]e", "unlicen"),
    ("wtfpl", r"(?:do what the f\w+ you want to public licen[cs]e|wtfpl)", "want|wtfpl"),
    ("postgresql", r"postgresql", "postgresql"),
    ("psf-2.0", r"(?:python software foundation|psf)", "python|psf"),
    ("ruby", r"ruby", "ruby"),
    ("php-3.01", r"php", "php"),
    ("ofl-1.1", r"(?:sil )?open font licen[cs]e", "font"),
    ("ms-pl", r"microsoft public licen[cs]e", "microsoft"),
    ("ms-rl", r"microsoft reciprocal licen[cs]e", "microsoft"),
    ("odbl-1.0", r"(?:open database licen[cs]e|odbl)", "database|odbl"),
    ("odc-by-1.0", r"open data commons attribution licen[cs]e", "commons"),
    ("pddl-1.0", r"(?:public domain dedication and licen[cs]e|pddl)", "dedication|pddl"),
    ("sspl-1.0", r"(?:server side public licen[cs]e|sspl)", "server|sspl"),
    ("afl-3.0", r"academic free licen[cs]e", "academic"),
    ("osl-3.0", r"open software licen[cs]e", "software"),
    ("ecl-2.0", r"educational community licen[cs]e", "educational"),
    ("ncsa", r"(?:university of illinois/ncsa|ncsa)", "ncsa"),
    ("upl-1.0", r"universal permissive licen[cs]e", "universal"),
)
# Sentences of license texts and notices: label and words. Between two words
# any run of other characters may stand (punctuation, line breaks, comment
# marks); <n> stands for at most n words, a|b for one of two.
SENTENCES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("mit", "permission is hereby granted without written agreement and without license or royalty fees to use copy modify"),
    ("mit-0", "to permit persons to whom the software is furnished to do so the software is provided as is"),
    ("x11", "except as contained in this notice the name <4> shall not be used in advertising or otherwise"),
    ("ncsa", "to deal with the software without restriction including without limitation the rights to use"),
    ("ncsa", "redistributions <6> must retain <8> this list of conditions and the following disclaimers"),
    ("json", "the software shall be used for good not evil"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-2-clause", "redistributions in binary form must reproduce the above copyright notice this list of conditions"),
    ("bsd-3-clause", "neither the name|names of <12> may be used to endorse or promote products derived from this software"),
    ("bsd-3-clause", "the name|names of <8> may not be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following"),
    ("bsd-3-clause-clear", "no express or implied licenses to any party's patent rights are granted by this license"),
    ("bsd-0-clause", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is"),
    ("isc", "permission to use copy modify and|or <1> distribute this software for any purpose with or without fee is hereby granted"),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement"),
    ("hpnd", "permission to use copy modify and distribute this software and its documentation for any purpose and without fee is hereby granted"),
    ("apache-2.0", "licensed under the apache license version 2 0 <4> you may not use this file except in compliance with the license"),
    ("apache-2.0", "you may not use this file except in compliance with the license <3> you may obtain a copy of the license at"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2.0", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"),
    ("apache-1.1", "this product includes software developed by the apache software foundation"),
    ("apache-1.0", "this product includes software developed by the apache group"),
    ("gpl-1.0", "under the terms of the gnu general public license as published by the free software foundation <3> version 1"),
    ("gpl-2.0", "under the terms of the gnu general public license as published by the free software foundation <3> version 2"),
    ("gpl-2.0", "under the terms of the gnu general public license version 2 as published by the free software foundation"),
    ("gpl-3.0", "under the terms of the gnu general public license as published by the free software foundation <3> version 3"),
    ("gpl-3.0", "the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("gpl-2.0", "the licenses for most software are designed to take away your freedom to share and change it"),
    ("lgpl-2.0", "under the terms of the gnu library general public license as published by the free software foundation <3> version 2"),
    ("lgpl-2.1", "under the terms of the gnu lesser general public license as published by the free software foundation <3> version 2 1"),
    ("lgpl-3.0", "under the terms of the gnu lesser general public license as published by the free software foundation <3> version 3"),
    ("lgpl-3.0", "this version of the gnu lesser general public license incorporates the terms and conditions of version 3"),
    ("agpl-3.0", "under the terms of the gnu affero general public license as published by the free software foundation <3> version 3"),
    ("agpl-3.0", "the gnu affero general public license is a free copyleft license for software and other kinds of works"),
    ("gfdl-1.1", "modify this document under the terms of the gnu free documentation license version 1 1"),
    ("gfdl-1.2", "modify this document under the terms of the gnu free documentation license version 1 2"),
    ("gfdl-1.3", "modify this document under the terms of the gnu free documentation license version 1 3"),
    ("classpath-exception", "linking this library statically or dynamically with other modules is making a combined work"),
    ("gcc-exception", "the gcc runtime library exception version 3 1"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-2.0", "if a copy of the mpl was not distributed with this file you can obtain one at"),
    ("mpl-1.1", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("mpl-1.0", "the contents of this file are subject to the mozilla public license version 1 0"),
    ("npl-1.1", "the contents of this file are subject to the netscape public license version 1 1"),
    ("epl-1.0", "accompanying materials are made available under the terms of the eclipse public license v1 0"),
    ("epl-2.0", "accompanying materials are made available under the terms of the eclipse public license 2 0"),
    ("edl-1.0", "accompanying materials are made available under the terms of the eclipse distribution license"),
    ("cddl-1.0", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("cpl-1.0", "accompanying materials are made available under the terms of the common public license"),
    ("ipl-1.0", "under the terms of the ibm public license"),
    ("eupl-1.2", "licensed under the eupl version 1 2 or as soon they will be approved by the european commission"),
    ("eupl-1.1", "licensed under the eupl version 1 1 or as soon they will be approved by the european commission"),
    ("artistic-1.0", "the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic-2.0", "this license establishes the terms under which a given free software package may be copied modified distributed"),
    ("perl", "you can redistribute it and or modify it under the same terms as perl itself"),
    ("ruby", "you can redistribute it and or modify it under either the terms of the 2 clause bsdl"),
    ("bsl-1.0", "to any person or organization obtaining a copy of the software and accompanying documentation covered by this license"),
    ("bsl-1.0", "distributed under the boost software license version 1 0"),
    ("busl-1.1", "the business source license <8> is not an open source license"),
    ("zlib", "the origin of this software must not be misrepresented"),
    ("zlib", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("libpng", "the png reference library is supplied as is"),
    ("openssl", "this product includes software developed by the openssl project"),
    ("ssleay", "this product includes cryptographic software written by eric young"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software"),
    ("wtfpl", "you just do what the fuck you want to"),
    ("beerware", "if we meet some day and you think this stuff is worth it you can buy me a beer in return"),
    ("psf-2.0", "psf hereby grants licensee a nonexclusive royalty free world wide license"),
    ("cnri-python", "cnri hereby grants licensee a nonexclusive royalty free world wide license"),
    ("php-3.01", "this product includes php software freely available from"),
    ("zend-2.0", "this product includes the zend engine"),
    ("ofl-1.1", "this font software is licensed under the sil open font license"),
    ("ofl-1.1", "the font software may not be sold by itself"),
    ("ubuntu-font-1.0", "licensed under the ubuntu font licence"),
    ("ms-pl", "this license governs use of the accompanying software if you use the software you accept this license"),
    ("ms-rl", "for any file you distribute that contains code from the software <4> you must provide recipients the source code to that file"),
    ("odbl-1.0", "made available under the open database license"),
    ("odc-by-1.0", "made available under the open data commons attribution license"),
    ("pddl-1.0", "made available under the public domain dedication and license"),
    ("sspl-1.0", "if you make the functionality of the program or a modified version available to third parties as a service"),
    ("elastic-2.0", "you may not provide the software to third parties as a hosted or managed service"),
    ("commons-clause", "the license does not grant to you the right to sell the software"),
    ("polyform-nc-1.0", "any noncommercial purpose is a permitted purpose"),
    ("afl-3.0", "licensed under the academic free license version 3 0"),
    ("osl-3.0", "licensed under the open software license version 3 0"),
    ("ecl-2.0", "licensed under the educational community license version 2 0"),
    ("upl-1.0", "subject to the condition set forth below permission is hereby granted to any person obtaining a copy of this software"),
    ("unicode", "obtaining a copy of the unicode data files and any associated documentation"),
    ("w3c", "by obtaining <6> this work you the licensee agree that you have read understood and will comply with the following terms"),
    ("curl", "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice"),
    ("ijg", "this software is based in part on the work of the independent jpeg group"),
    ("freetype", "portions of this software are copyright <6> the freetype project"),
    ("info-zip", "this is version <6> of the info zip license"),
    ("cc0-1.0", "the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc0-1.0", "to the extent possible under law <12> has waived all copyright and related or neighboring rights"),
    ("cc", "this work is licensed under a|the creative commons"),
    ("public-domain", "this work|file|software|code is in the public domain"),
    ("public-domain", "no copyright is claimed"),
    ("public-domain", "the author|authors disclaims|disclaim copyright to this source code"),
    ("us-government", "this work was prepared by an officer or employee of the united states government"),
    ("proprietary", "this software|file|code is proprietary and confidential"),
    ("proprietary", "unauthorized copying of this file via any medium is strictly prohibited"),
    ("proprietary", "no part of this publication may be reproduced"),
    ("proprietary", "confidential and proprietary information of"),
    ("non-commercial", "for non commercial use only"),
    ("non-commercial", "may not be used for commercial purposes"),
    ("research-only", "for research purposes only"),
    ("no-warranty", "provided as is without warranty of any kind"),
    ("no-warranty", "without any express or implied warranty"),
    ("no-warranty", "without even the implied warranty of merchantability or fitness for a particular purpose"),
)
# Addresses of license texts: label, pattern, and a keyword that each match holds.
ADDRESSES = (
    ("gpl-1.0", r"gnu\.org/licenses/(?:old-licenses/)?gpl-1\.0", "gnu.org"),
    ("gpl-2.0", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0", "gnu.org"),
    ("gpl-3.0", r"gnu\.org/licenses/gpl-3\.0", "gnu.org"),
    ("lgpl-2.0", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.0", "gnu.org"),
    ("lgpl-2.1", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1", "gnu.org"),
    ("lgpl-3.0", r"gnu\.org/licenses/lgpl-3\.0", "gnu.org"),
    ("agpl-3.0", r"gnu\.org/licenses/agpl-3\.0", "gnu.org"),
    ("gfdl-1.3", r"gnu\.org/licenses/fdl-1\.3", "gnu.org"),
    ("gpl", r"gnu\.org/(?:copyleft/gpl|licenses/gpl)(?!-)", "gnu.org"),
    ("lgpl", r"gnu\.org/(?:copyleft/lesser|licenses/lgpl)(?!-)", "gnu.org"),
    ("apache-2.0", r"apache\.org/licenses/license-2\.0", "apache.org"),
    ("apache-1.1", r"apache\.org/licenses/license-1\.1", "apache.org"),
    ("mpl-1.1", r"mozilla\.org/(?:[a-z-]+/)?mpl/(?:mpl-)?1\.1", "mozilla.org"),
    ("mpl-2.0", r"mozilla\.org/(?:[a-z-]+/)?mpl/2\.0", "mozilla.org"),
    ("epl-1.0", r"eclipse\.org/legal/epl-v10", "eclipse.org"),
    ("epl-2.0", r"eclipse\.org/(?:legal/epl-v20|legal/epl-2\.0)", "eclipse.org"),
    ("edl-1.0", r"eclipse\.org/org/documents/edl-v10", "eclipse.org"),
    ("bsl-1.0", r"boost\.org/license_1_0\.txt", "boost.org"),
    ("unlicense", r"unlicense\.org", "unlicense.org"),
    ("wtfpl", r"wtfpl\.net", "wtfpl.net"),
    ("ofl-1.1", r"scripts\.sil\.org/ofl", "sil.org"),
    ("postgresql", r"postgresql\.org/about/licen[cs]e", "postgresql.org"),
    ("zlib", r"zlib\.net/zlib_license", "zlib.net"),
    ("php-3.01", r"php\.net/license/3_01", "php.net"),
    ("artistic-2.0", r"perlfoundation\.org/artistic_license_2_0", "perlfoundation.org"),
    ("odbl-1.0", r"opendatacommons\.org/licenses/odbl", "opendatacommons.org"),
    ("odc-by-1.0", r"opendatacommons\.org/licenses/by", "opendatacommons.org"),
    ("pddl-1.0", r"opendatacommons\.org/licenses/pddl", "opendatacommons.org"),
    ("busl-1.1", r"mariadb\.com/bsl11", "mariadb.com"),
    ("sspl-1.0", r"mongodb\.com/licensing/server-side-public-license", "mongodb.com"),
    ("elastic-2.0", r"elastic\.co/licensing/elastic-license", "elastic.co"),
    ("w3c", r"w3\.org/consortium/legal/(?:copyright-software|\d{4}/copyright-software)", "w3.org"),
    ("unicode", r"unicode\.org/(?:copyright|license)\.(?:html|txt)", "unicode.org"),
    ("eupl-1.2", r"joinup\.ec\.europa\.eu/[^\s]{0,80}eupl", "joinup.ec"),
)
CC_PARTS = ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd")
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")
CC_NAMES = {"by": "attribution", "sa": "share ?-?alike", "nc": "non ?-?commercial", "nd": "no ?-?deriv(?:ative)?s?(?: works)?"}
WORD = r"[0-9a-z\x80-\xff]"         # the text's UTF-8 bytes, one character each
GAP = r"[^0-9a-z\x80-\xff]+"
START, END = rf"(?<!{WORD})", rf"(?!{WORD})"
ID_START, ID_END = r"(?<![0-9a-z\x80-\xff.+/_-])", r"(?:-only|-or-later|\+)?(?![0-9a-z\x80-\xff]|[-.+/_][0-9a-z])"
GRANT = (START + r"(?:licen[cs]ed|released|distributed|published|available|provided|redistributed)"
         r"(?: [0-9a-z]+){0,4} (?:under|by|with) (?:an? |the )?(?:terms of (?:an? |the )?)?")
WEIGHT = {3: 0.95, 2: 0.8, 1: 0.5}


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str
    keywords: tuple[str, ...]   # one of them is in every text the pattern matches
    priority: int               # 3 tag or URL, 2 grant sentence, 1 name


def sentence(words: str) -> tuple[str, str]:
    """The pattern of an entry of SENTENCES, and its longest plain word."""
    tokens, pattern = words.split(), ""
    for i, t in enumerate(tokens):
        if t[0] == "<":
            pattern += rf"(?:{WORD}+{GAP}){{0,{t[1:-1]}}}"
            continue
        t = t.replace("'", GAP)
        pattern += (f"(?:{t})" if "|" in t else t) + (GAP if i < len(tokens) - 1 else "")
    return START + pattern + END, max((t for t in tokens if t.isalpha()), key=len)


def build_rules() -> tuple[Rule, ...]:
    """The rules in order: for each family and variant its tag, URL, grant
    sentence and bare name."""
    out: list[Rule] = []

    def add(label: str, pattern: str, keywords: str, priority: int) -> None:
        pattern = re.sub(" ", r"\\s+", pattern.replace(" ?", r"\s*"))
        out.append(Rule(label, pattern, tuple(keywords.split("|")), priority))

    for label, name, keywords in FAMILIES:
        tag = re.escape(label)
        short = "0bsd" if label == "bsd-0-clause" else tag
        add(label, rf"spdx-license-identifier:\s*(?:[0-9a-z.+()\t\x20-]*[\t\x20(])?(?P<id>{short}{ID_END})", "spdx-license-identifier", 3)
        add(label, rf"{START}licen[cs]es?['\"]?\s*[:=]\s*['\"(\[]*(?:[0-9a-z.+-]+ (?:or|and) )?(?P<id>{short}{ID_END})", "licen", 3)
        if "." in label or label.startswith("bsd-"):        # an identifier that is no common word
            add(label, ID_START + short + ID_END, label.split("-")[0], 1)
        add(label, rf"(?:opensource\.org/licenses?|spdx\.org/licenses|choosealicense\.com/licenses)/{tag}"
                   rf"(?:\.html|\.php)?{END}", "opensource.org|spdx.org|choosealicense.com", 3)
        add(label, GRANT + name + END, keywords, 2)
        add(label, START + name + (r"(?:[-\s]style)? licen[cs]e" if "licen" not in name else "") + END, keywords, 1)
    for kind in CC_PARTS:
        full = r"[-\s]+".join(CC_NAMES[x] for x in kind.split("-"))
        for v in CC_VERSIONS:
            label, num = f"cc-{kind}-{v}", re.escape(v)
            short = r"cc[-\s]" + kind.replace("-", r"[-\s]") + r"[-\s]" + num + END
            add(label, rf"spdx-license-identifier:\s*cc-{kind}-{num}{END}", "spdx-license-identifier", 3)
            add(label, rf"creativecommons\.org/licenses/{kind}/{num}", "creativecommons.org", 3)
            add(label, GRANT + short, "cc", 2)
            add(label, START + short, "cc", 1)
            add(label, rf"creative commons {full}(?: licen[cs]e)?,? ?(?:version |v\.? ?)?{num}", "creative", 1)
    for label, pattern, keyword in ADDRESSES:
        add(label, pattern, keyword, 3)
    for label, words in SENTENCES:
        add(label, *sentence(words), 2)
    add("cc0-1.0", rf"spdx-license-identifier:\s*cc0-1\.0{END}", "spdx-license-identifier", 3)
    add("cc0-1.0", r"creativecommons\.org/publicdomain/zero/1\.0", "creativecommons.org", 3)
    add("cc0-1.0", rf"{START}cc0(?:[-\s]1\.0)?{END}", "cc0", 1)
    add("public-domain", rf"{START}(?:released|dedicated|placed) (?:in|to|into) the public domain{END}", "domain", 2)
    add("reserved", rf"{START}all rights reserved{END}", "reserved", 1)
    add("copyright", rf"{START}copyright\s*(?:\(c\)|\xc2\xa9)?\s*(?:19|20)\d\d", "copyright", 1)
    return tuple(out)


RULES = build_rules()


class Scanner:
    """Compiled rules and the keyword automaton (one in each Python process)."""

    _own: list["Scanner"] = []

    def __init__(self) -> None:
        by: dict[str, set[int]] = {}
        for i, r in enumerate(RULES):
            for k in r.keywords:
                by.setdefault(k, set()).add(i)
        for label, phrase in BASE.items():      # the phrase's first word gates it
            by.setdefault(phrase[0] if phrase[0] != "all" else phrase[-1], set())
        self.keywords = ahocorasick.Automaton()
        for k, rules in by.items():
            self.keywords.add_word(k, (k, frozenset(rules)))
        self.keywords.make_automaton()
        self.rules: dict[int, re.Pattern] = {}
        self.base = {label: (x[0] if x[0] != "all" else x[-1], re.compile(START + GAP.join(x) + END))
                     for label, x in BASE.items()}
        self.is_word = np.zeros(256, bool)
        self.is_word[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

    @classmethod
    def get(cls) -> "Scanner":
        if not cls._own:
            cls._own.append(cls())
        return cls._own[0]

    def detections(self, text: str, rules: set[int]) -> list[tuple[int, int, int, int]]:
        """Surviving (start, end, priority, rule), by start."""
        found = []
        for i in sorted(rules):
            if i not in self.rules:
                self.rules[i] = re.compile(RULES[i].pattern)
            rule = self.rules[i]
            group = "id" if "id" in rule.groupindex else 0
            found += [(*m.span(group), RULES[i].priority, i) for m in rule.finditer(text)]
        found.sort(key=lambda d: (d[0], -d[1], -d[2], d[3]))
        reach, out = [0, 0, 0, 0], []        # furthest end so far, by priority
        for d in found:                      # whatever contains d comes before it
            if max(reach[d[2]:]) < d[1]:
                out.append(d)
            reach[d[2]] = max(reach[d[2]], d[1])
        return out

    def scan(self, text: str | None) -> tuple:
        raw = (text or "").encode("utf-8", "surrogatepass").lower()     # bytes: only A-Z change
        word = self.is_word[np.frombuffer(raw, np.uint8)]
        starts = word.copy()
        starts[1:] &= ~word[:-1]
        n_words = int(np.count_nonzero(starts))
        low = raw.decode("latin-1")
        hit, rules = set(), set()
        for _, (k, own) in self.keywords.iter(low):
            if k not in hit:
                hit.add(k)
                rules |= own
        places, base = [], []
        for label, (gate, pattern) in self.base.items():
            at = [m.start() for m in pattern.finditer(low)] if gate in hit else []
            if at:
                base.append(label)
                places += at
        first = last = None
        if places:
            first, last = (int(np.count_nonzero(starts[:x])) for x in (min(places), max(places)))
        best: dict[str, float] = dict.fromkeys(base, WEIGHT[1])
        if rules:
            for _, _, priority, i in self.detections(low, rules):
                best[RULES[i].label] = max(best.get(RULES[i].label, 0), WEIGHT[priority])
        score = 1.0
        for label in sorted(best):
            score *= 1 - best[label]
        return n_words, len(places), first, last, ",".join(sorted(base)), ",".join(sorted(best)), 1 - score


def scan_licenses(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id and what ``Scanner.scan`` finds."""
    small_batches(docs.sparkSession)
    out = pa.schema([("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
                     ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = Scanner.get().scan
        for b in batches:
            rows = [scan(t) for t in b.column("text").to_pylist()]
            cols = [pa.array([r[j] for r in rows], f.type) for j, f in enumerate(out)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), *cols], ["doc_id", *out.names])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, "
             "base_labels string, labels string, score double")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))
