"""Licence scan by sentence rules.

A text is cut into sentences; a normalised sentence (lower case, runs of
anything but letters, digits and plus signs as one blank) that is a known
licence sentence becomes its identifier; the others drop out.  A sentence may
be wrapped: consecutive pieces of the cut that together are a known sentence
are that sentence.  A licence is
found where its rule, an ordered list of identifiers, stands in the text's
identifiers in that order, other identifiers between them allowed, unless a
rule that holds its identifiers and more is found too: the longer one goes
before.  Reserved rights stand in most notices of free licences: ``proprietary``
is named only where no other licence is found.

DataFrame functions only, and nothing moves between rows: the table of known
sentences is a fixed literal.  Null and empty texts have no sentence; repeats
of a sentence count each time; ids and extra columns don't matter.  A very long
text is cut within its row; time grows in proportion to it.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import as_text

#: Licence sentences by identifier.
SENTENCES = {
    "apache-header": "Licensed under the Apache License, Version 2.0.",
    "apache-long": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License',
    "apache-copy": "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    "apache-as-is": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied',
    "mit-header": "Released under the MIT License.",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-notice": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "gpl3-header": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "bsd-no-endorse": "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    "cc-by-nc-4": "Licensed under CC BY-NC 4.0.",
    "cc-by-4": "Licensed under CC BY 4.0.",
    "cc-by-sa-4": "Licensed under CC BY-SA 4.0.",
    "cc0": "CC0 1.0 Universal.",
    "rights-reserved": "All rights reserved.",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl2-only": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2 as published by the Free Software Foundation.",
    "lgpl21-free": "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
    "lgpl3-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "agpl3-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "mpl2-form": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "isc-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
    "0bsd-grant": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "unlicense-free": "This is free and unencumbered software released into the public domain.",
    "epl2-made": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    "bsl-grant": 'Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:',
    "zlib-as-is": "This software is provided 'as-is', without any express or implied warranty.",
    "zlib-origin": "The origin of this software must not be misrepresented; you must not claim that you wrote the original software.",
    "cc-by-4-work": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "cc-by-sa-4-work": "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
    "cc-by-nc-4-work": "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
    "cc-by-nd-4-work": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    "cc-by-nc-sa-4-work": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
}
#: Licence identifiers that a line "SPDX-License-Identifier: ..." names.
SPDX = "Apache-2.0 MIT GPL-2.0-only GPL-2.0-or-later GPL-3.0-only GPL-3.0-or-later LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later AGPL-3.0-only AGPL-3.0-or-later MPL-2.0 BSD-2-Clause BSD-3-Clause ISC 0BSD Unlicense EPL-2.0 BSL-1.0 Zlib CC0-1.0 CC-BY-4.0 CC-BY-SA-4.0".split()
SENTENCES |= {f"spdx-{x.lower()}": f"SPDX-License-Identifier: {x}" for x in SPDX}
#: Ordered rules, (licence, identifiers); a licence may have several.
RULES = [
    ("Apache-2.0", ["apache-header"]),
    ("Apache-2.0", ["apache-long", "apache-copy", "apache-as-is"]),
    ("MIT", ["mit-header"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("GPL-3.0", ["gpl3-header"]),
    ("GPL-3.0", ["gpl-free", "gpl-hope"]),
    ("BSD-3-Clause", ["bsd-grant", "bsd-no-endorse"]),
    ("BSD-2-Clause", ["bsd-grant"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4"]),
    ("CC-BY-4.0", ["cc-by-4"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4"]),
    ("CC0-1.0", ["cc0"]),
    ("proprietary", ["rights-reserved"]),
    ("GPL-2.0", ["gpl2-free", "gpl-hope"]),
    ("GPL-2.0", ["gpl2-only"]),
    ("LGPL-2.1", ["lgpl21-free"]),
    ("LGPL-3.0", ["lgpl3-free"]),
    ("AGPL-3.0", ["agpl3-free"]),
    ("MPL-2.0", ["mpl2-form"]),
    ("ISC", ["isc-grant"]),
    ("0BSD", ["0bsd-grant"]),
    ("Unlicense", ["unlicense-free"]),
    ("EPL-2.0", ["epl2-made"]),
    ("BSL-1.0", ["bsl-grant"]),
    ("Zlib", ["zlib-as-is", "zlib-origin"]),
    ("CC-BY-4.0", ["cc-by-4-work"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-4-work"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-4-work"]),
    ("CC-BY-ND-4.0", ["cc-by-nd-4-work"]),
    ("CC-BY-NC-SA-4.0", ["cc-by-nc-sa-4-work"]),
]
RULES += [(x.removesuffix("-only").removesuffix("-or-later"), [f"spdx-{x.lower()}"]) for x in SPDX]
#: Licences that give way to any other.
LAST = {"proprietary"}
#: Ends of sentences: a mark before white space, a newline, a semicolon or colon at a line's end.
SENTENCE_END = r"(?<=[.!?])\s+|[;:]?\s*\n\s*"


def normalise(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), r"[^\p{L}\p{N}+]+", " "))


def plain(sentence: str) -> str:
    """``normalise`` for the fixed table (ASCII)."""
    return " ".join("".join(c if c.isalnum() or c == "+" else " " for c in sentence.lower()).split())


def longer(rules: list[tuple[str, list[str]]]) -> list[list[int]]:
    """For each rule those of another licence that hold its identifiers, in order, and more; for a rule of ``LAST`` those of any other licence."""

    def within(a: list[str], b: list[str]) -> bool:
        rest = iter(b)
        return len(a) < len(b) and all(x in rest for x in a)

    return [[j for j, (other, b) in enumerate(rules) if other != name and ((name in LAST and other not in LAST) or within(a, b))] for name, a in rules]


def scan(docs: DataFrame, sentences: dict[str, str] | None = None, rules: list[tuple[str, list[str]]] | None = None) -> DataFrame:
    """Per document: doc_id, n_sentences (pieces of the cut), sentence_ids (in text order), licenses (in the rules' order), n_licenses."""
    sentences, rules = sentences or SENTENCES, rules or RULES
    by_text = {plain(v): k for k, v in sentences.items()}
    ident = F.create_map(*[F.lit(x) for kv in by_text.items() for x in kv])
    df = docs.select("doc_id", F.filter(F.transform(F.split(F.coalesce(as_text("text"), F.lit("")), SENTENCE_END), normalise), lambda s: s != "").alias("_s"))
    # pieces between bars; a known sentence begins and ends at a bar, and any blank of it may be one
    wrapped = "|".join(r"[ |]".join(map(re.escape, k.split())) for k in sorted(by_text, key=len, reverse=True) if k)
    bars = F.concat(F.lit("|"), F.array_join("_s", "|"), F.lit("|"))
    hits = F.regexp_extract_all(bars, F.lit(rf"\|({wrapped})(?=\|)"), F.lit(1))
    df = df.select("doc_id", F.size("_s").cast("long").alias("n_sentences"), F.transform(hits, lambda s: ident[F.translate(s, "|", " ")]).alias("sentence_ids"))
    joined = F.concat(F.lit("|"), F.array_join("sentence_ids", "|"), F.lit("|"))
    stands = [joined.rlike("".join(rf"\|{i}(?=\|).*" if k + 1 < len(ids) else rf"\|{i}\|" for k, i in enumerate(ids))) for _, ids in rules]
    found = []
    for (name, _), own, above in zip(rules, stands, longer(rules)):
        for j in above:
            own = own & ~stands[j]
        found.append(F.when(own, F.lit(name)))
    some = joined != "||"  # most texts have no known sentence
    found = [F.when(some, x) for x in found]
    licenses = F.array_distinct(F.array_compact(F.array(*found)))
    return df.select("doc_id", "n_sentences", "sentence_ids", licenses.alias("licenses")).withColumn("n_licenses", F.size("licenses").cast("long"))
