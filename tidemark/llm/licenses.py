"""License scans: known sentences to identifiers, sequences of identifiers to licences."""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import batches, ready, whole_text

# Sentences of public licences, normalised, by identifier; several where notices differ.
SENTENCES = {
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-name": "released under the mit license",
    "mit-licensed": "licensed under the mit license",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd-names": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "apache-name": [
        "licensed under the apache license version 2 0",
        "licensed under the apache license version 2 0 the license",
    ],
    "apache-use": "you may not use this file except in compliance with the license",
    "apache-copy": [
        "you may obtain a copy of the license at http www apache org licenses license 2 0",
        "you may obtain a copy of the license at https www apache org licenses license 2 0",
    ],
    "gpl-3-name": [
        "this work is licensed under the gnu general public license version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation version 3",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation version 3 of the license",
    ],
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "gpl-3-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "mpl-name": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "cc-by-name": [
        "licensed under cc by 4 0",
        "this work is licensed under cc by 4 0",
        "this work is licensed under a creative commons attribution 4 0 international license",
        "this work is licensed under the creative commons attribution 4 0 international license",
    ],
    "cc-by-sa-name": [
        "licensed under cc by sa 4 0",
        "this work is licensed under cc by sa 4 0",
        "this work is licensed under a creative commons attribution sharealike 4 0 international license",
        "this work is licensed under the creative commons attribution sharealike 4 0 international license",
    ],
    "cc-by-nc-name": [
        "licensed under cc by nc 4 0",
        "this work is licensed under cc by nc 4 0",
        "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
        "this work is licensed under the creative commons attribution noncommercial 4 0 international license",
    ],
    "cc0-name": [
        "to the extent possible under law the author has waived all copyright and related rights to this work",
        "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
        "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide",
    ],
    "unlicense-free": "this is free and unencumbered software released into the public domain",
    "lgpl-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "agpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "spdx-mit": "spdx license identifier mit",
    "spdx-apache": "spdx license identifier apache 2 0",
    "spdx-bsd-3": "spdx license identifier bsd 3 clause",
    "spdx-gpl-2": "spdx license identifier gpl 2 0 only",
    "spdx-gpl-3": "spdx license identifier gpl 3 0 or later",
    "spdx-mpl": "spdx license identifier mpl 2 0",
    "reserved": "all rights reserved",
}

# Other known sentences, such as "all rights reserved", that may stand between two of a rule's. A
# rule can have a third value of its own.
GAP = 2

# Rules in the order in which they are tried: the licence, and its identifiers in order.
RULES = [
    ("BSD-3-Clause", ["bsd-grant", "bsd-source", "bsd-binary", "bsd-names"]),
    ("BSD-2-Clause", ["bsd-grant", "bsd-source", "bsd-binary"]),
    ("MIT", ["mit-grant", "mit-notice", "as-is"]),
    ("MIT", ["mit-grant", "mit-notice"]),
    ("Apache-2.0", ["apache-name", "apache-use", "apache-copy"]),
    ("GPL-2.0-or-later", ["gpl-free", "gpl-hope"]),
    ("GPL-3.0-or-later", ["gpl-3-free", "gpl-hope"]),
    ("Apache-2.0", ["apache-name"]),
    ("MIT", ["mit-name"]),
    ("MIT", ["mit-licensed"]),
    ("GPL-2.0-or-later", ["gpl-free"]),
    ("GPL-3.0-or-later", ["gpl-3-free"]),
    ("GPL-3.0-only", ["gpl-3-name"]),
    ("MPL-2.0", ["mpl-name"]),
    ("ISC", ["isc-grant"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-name"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-name"]),
    ("CC-BY-4.0", ["cc-by-name"]),
    ("CC0-1.0", ["cc0-name"]),
    ("Unlicense", ["unlicense-free"]),
    ("LGPL-2.1-or-later", ["lgpl-free"]),
    ("AGPL-3.0-or-later", ["agpl-free"]),
    ("MIT", ["spdx-mit"]),
    ("Apache-2.0", ["spdx-apache"]),
    ("BSD-3-Clause", ["spdx-bsd-3"]),
    ("GPL-2.0-only", ["spdx-gpl-2"]),
    ("GPL-3.0-or-later", ["spdx-gpl-3"]),
    ("MPL-2.0", ["spdx-mpl"]),
    ("all-rights-reserved", ["reserved"]),
]

_NOT_WORD = re.compile(r"[^a-z0-9]+")
_BREAK = re.compile(r"(?<=[.!?;:])\s+|\n")
_FIRST = re.compile(r"[^A-Za-z0-9]*([A-Za-z0-9]+)")


def normalise(sentence: str) -> str:
    """Letters A-Z lower-cased and digits; everything else between them is one space."""
    return _NOT_WORD.sub(" ", sentence.lower()).strip()


class Recogniser:
    def __init__(self, sentences: dict[str, str | list[str]] = SENTENCES, rules: list = RULES):
        self.rules = rules
        self.known = {normalise(s): name for name, forms in sentences.items() for s in ([forms] if isinstance(forms, str) else forms)}
        self.sorted = sorted(self.known)
        # A piece can only begin a sentence if its first word does.
        self.firsts = {s.split(" ")[0] for s in self.sorted}

    def _begins(self, text: str) -> bool:
        """Whether some known sentence begins so."""
        at = bisect_left(self.sorted, text)
        return at < len(self.sorted) and self.sorted[at].startswith(text)

    def sentences(self, text: str) -> list[tuple[str, int]]:
        """The known sentences in order, each with the offset of its first character.

        A sentence ends at a mark or at the end of a line, and may run over several lines: pieces
        are joined for as long as they still begin a known sentence, and the longest counts. Pieces
        without a letter or digit, such as blank lines, are passed over.
        """
        pieces, begin = [], 0  # begin, end and first word; the text is cut once
        for stop in [*_BREAK.finditer(text), None]:
            end = stop.start() if stop else len(text)
            first = _FIRST.match(text, begin, end)
            if first:
                pieces.append((begin, end, first[1].lower()))
            begin = stop.end() if stop else end
        normal: dict[int, str] = {}
        found, free = [], 0
        for i, (begin, _, first) in enumerate(pieces):
            if i < free or first not in self.firsts:
                continue
            so_far, best = "", None
            for j in range(i, len(pieces)):
                if j not in normal:
                    normal[j] = normalise(text[pieces[j][0]:pieces[j][1]])
                so_far = f"{so_far} {normal[j]}".strip()
                if so_far in self.known:
                    best = (self.known[so_far], j + 1)
                if not self._begins(so_far):
                    break
            if best:
                while text[begin].isspace():
                    begin += 1
                found.append((best[0], begin))
                free = best[1]
        return found

    def licences(self, names: list[str]) -> list[tuple[str, int, int]]:
        """Licence, and first and last place in the sequence, of the rules that match.

        Rules are tried in their order; a sentence that one rule has used no other can use. Between
        two sentences of a rule there may be as many others as its gap says.
        """
        found, used = [], [False] * len(names)
        for licence, rule, *own in self.rules:
            gap = own[0] if own else GAP
            for i, name in enumerate(names):
                if name != rule[0] or used[i]:
                    continue
                places = [i]
                for wanted in rule[1:]:
                    near = range(places[-1] + 1, min(places[-1] + 2 + gap, len(names)))
                    places.append(next((k for k in near if names[k] == wanted and not used[k]), -1))
                    if places[-1] < 0:
                        break
                else:
                    for k in places:
                        used[k] = True
                    found.append((licence, i, places[-1]))
        return sorted(found, key=lambda f: f[1])


def scan(docs: DataFrame, sentences: dict[str, str | list[str]] = SENTENCES, rules: list = RULES) -> DataFrame:
    """One row per document: doc_id, n_sentences, licences, sentences, offsets.

    ``sentences`` are the identifiers of the known sentences of the whole text in order, with
    repeats, ``offsets`` where they begin, ``n_sentences`` how many; ``licences`` are the
    licences of the rules that match them in order, each licence once, in order of the text.
    A text is cut and normalised once, so the time is proportional to its length in any script.
    Letter case, marks and blanks within a sentence do not count. Null and empty texts have
    none. Repeated rows are scanned each. An empty table gives no rows. Other columns are not
    read.
    """
    ready(docs.sparkSession)

    def find(parts):
        recogniser = Recogniser(sentences, rules)
        for rest, texts in batches(parts):
            found = [recogniser.sentences(t.decode()) for t in texts]
            names = [[n for n, _ in f] for f in found]
            licences = [list(dict.fromkeys(x for x, _, _ in recogniser.licences(n))) for n in names]
            yield pa.RecordBatch.from_arrays([
                rest.column(0), pa.array(np.array([len(n) for n in names], np.int64)), pa.array(licences, pa.list_(pa.string())),
                pa.array(names, pa.list_(pa.string())), pa.array([[o for _, o in f] for f in found], pa.list_(pa.int64())),
            ], ["doc_id", "n_sentences", "licences", "sentences", "offsets"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text")).mapInArrow(
        find, "doc_id long, n_sentences long, licences array<string>, sentences array<string>, offsets array<long>"
    )
