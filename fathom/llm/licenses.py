"""Operator 8: licences by recognised sentences and ordered rules (DataFrame functions only).

A text is cut into pieces (lines, and after sentence ends), each brought to
lower-case letters and digits with single blanks, so that comment marks vanish. A
piece, or pieces that follow each other without a blank line (one that holds
nothing but marks is blank too), which make up one of ``SENTENCES`` become its
identifier; of sentences that start at one piece the longest counts, and a piece
counts for one sentence. The document's identifiers in order are
matched against ``RULES``: a rule matches where its identifiers follow each
other in the sequence (sentences that are not known may lie between). A match
within the match of a longer rule at the same place counts for the longer one.

Both lists are constants of the plan, so documents are scanned once, without a
join or a shuffle.

Defined results: null and empty texts match nothing; repeated sentences are
counted; repeated rows give a row each; extra columns are not read.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import whole_text

#: Sentences of well-known public licences and their usual notices, by identifier.
SENTENCES: dict[str, str] = {
    "mit-released": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-grant": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
                 "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
                 "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
                 "is furnished to do so, subject to the following conditions:",
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "mit-asis": "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES "
                "OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    "apache-released": "Released under the Apache License, Version 2.0.",
    "apache-licensed": "Licensed under the Apache License, Version 2.0.",
    "apache-may-not": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "apache-copy": "You may obtain a copy of the License at",
    "apache-url": "http://www.apache.org/licenses/LICENSE-2.0",
    "apache-asis": "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" "
                   "BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "gpl3-work": "This work is licensed under the GNU General Public License, version 3.",
    "gpl3-licensed": "Licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
                "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
                "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    "cc-by": "Licensed under CC BY 4.0.",
    "cc-by-sa": "Licensed under CC BY-SA 4.0.",
    "cc-by-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "bsd-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
                          "conditions are met:",
    "bsd-source": "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.",
    "bsd-binary": "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in "
                  "the documentation and/or other materials provided with the distribution.",
    "bsd-names": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
                 "this software without specific prior written permission.",
    "rights-reserved": "All rights reserved.",
    "spdx-mit": "SPDX-License-Identifier: MIT",
    "spdx-apache": "SPDX-License-Identifier: Apache-2.0",
    "spdx-gpl3": "SPDX-License-Identifier: GPL-3.0-or-later",
    "spdx-bsd3": "SPDX-License-Identifier: BSD-3-Clause",
}

#: Fixed values: (rule, licence, sentence identifiers in order).
RULES: list[tuple[str, str, tuple[str, ...]]] = [
    ("mit-text", "MIT", ("mit-grant", "mit-notice", "mit-asis")),
    ("mit-short-notice", "MIT", ("mit-released",)),
    ("mit-licence-line", "MIT", ("mit-licensed",)),
    ("mit-spdx", "MIT", ("spdx-mit",)),
    ("apache-header", "Apache-2.0", ("apache-may-not", "apache-copy", "apache-url", "apache-asis")),
    ("apache-header-start", "Apache-2.0", ("apache-may-not",)),
    ("apache-short-notice", "Apache-2.0", ("apache-released",)),
    ("apache-licence-line", "Apache-2.0", ("apache-licensed",)),
    ("apache-spdx", "Apache-2.0", ("spdx-apache",)),
    ("gpl3-header", "GPL-3.0", ("gpl-free", "gpl-hope")),
    ("gpl3-work-line", "GPL-3.0", ("gpl3-work",)),
    ("gpl3-licence-line", "GPL-3.0", ("gpl3-licensed",)),
    ("gpl3-spdx", "GPL-3.0", ("spdx-gpl3",)),
    ("cc-by-nc-line", "CC-BY-NC-4.0", ("cc-by-nc",)),
    ("cc-by-line", "CC-BY-4.0", ("cc-by",)),
    ("cc-by-work-line", "CC-BY-4.0", ("cc-by-work",)),
    ("cc-by-sa-line", "CC-BY-SA-4.0", ("cc-by-sa",)),
    ("bsd3-text", "BSD-3-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary", "bsd-names")),
    ("bsd2-text", "BSD-2-Clause", ("bsd-redistribution", "bsd-source", "bsd-binary")),
    ("bsd3-spdx", "BSD-3-Clause", ("spdx-bsd3",)),
    ("reserved", "proprietary", ("rights-reserved",)),
]


def normal(sentence: str) -> str:
    """Normal form of one known sentence; the same as ``normal_column``'s."""
    return re.sub(r"[^a-z0-9]+", " ", sentence.lower()).strip(" ")


def pieces(text: Column) -> Column:
    """Normal forms of the lines, cut after a full stop before a blank, as "|a|b|"; a blank line leaves "||"."""
    cut = F.lower(F.replace(text, F.lit(". "), F.lit(".\n")))
    return F.concat(F.lit("|"), F.trim(F.regexp_replace(F.regexp_replace(cut, "[^a-z0-9\n]+", " "), " ?\n ?", "|")), F.lit("|"))


def _known() -> dict[str, str]:
    """Normal form -> identifier."""
    return {normal(text): name for name, text in SENTENCES.items()}


def recognised(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    known = _known()
    keys = F.array(*[F.lit(k) for k in known])
    names = F.array(*[F.lit(v) for v in known.values()])
    any_of = "|".join(k.replace(" ", "[ |]") for k in sorted(known, key=len, reverse=True))
    hits = F.regexp_extract_all(pieces(text), F.lit(rf"(?<=\|)(?:{any_of})(?=\|)"), F.lit(0))
    return F.transform(hits, lambda s: F.get(names, F.array_position(keys, F.replace(s, F.lit("|"), F.lit(" "))).cast("int") - 1))


def scan(docs: DataFrame, rules: list[tuple[str, str, tuple[str, ...]]] | None = None) -> DataFrame:
    """doc_id, license_id, rule, n_matches, n_sentences (known ones of the document): a row per document row and rule that matches."""
    ordered = sorted(rules or RULES, key=lambda r: (-len(r[2]), r[0]))
    rows = docs.select("doc_id", recognised(whole_text()).alias("ids"))
    # "<a><b>": longest rules first; what they match is taken out, so that shorter rules do not count it again
    seq = F.concat(F.lit("<"), F.array_join("ids", "><"), F.lit(">"))
    book = F.array(*[F.struct(F.lit("".join(f"<{i}>" for i in ids)).alias("pattern"), F.lit(lic).alias("license_id"), F.lit(name).alias("rule"))
                     for name, lic, ids in ordered])
    start = F.struct(seq.alias("rest"), F.array().cast("array<struct<license_id:string,rule:string,n_matches:int>>").alias("found"))

    def apply(acc: Column, rule: Column) -> Column:
        left = F.replace(acc["rest"], rule["pattern"], F.lit("|"))
        n = ((F.length(acc["rest"]) - F.length(left)) / (F.length(rule["pattern"]) - 1)).cast("int")
        hit = F.array(F.struct(rule["license_id"].alias("license_id"), rule["rule"].alias("rule"), n.alias("n_matches")))
        return F.when(F.contains(acc["rest"], rule["pattern"]), F.struct(left.alias("rest"), F.concat(acc["found"], hit).alias("found"))).otherwise(acc)

    matches = F.aggregate(book, start, apply, lambda acc: acc["found"])
    rows = rows.select("doc_id", F.size("ids").alias("n_sentences"), F.explode(matches).alias("m"))
    return rows.select("doc_id", "m.license_id", "m.rule", "m.n_matches", "n_sentences")
