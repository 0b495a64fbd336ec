"""Licence scan by sentence rules. Built-in functions only, and no shuffle.

A text is normalised, with its sentence ends marked, and known licence sentences are found between the marks, which gives a
sequence of identifiers. A sentence may run over line ends, and over ; and :, so wrapped notices are found as well. Ordered rules are matched against the sequence: where a rule matches, its identifiers are used up, so a
later rule cannot claim them again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Normalised sentences of public licence notices, and the identifier of each.
SENTENCES = {
    "released under the mit license": "MITref",
    "licensed under the mit license": "MITref",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction": "MITgrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MITnotice",
    "the software is provided as is without warranty of any kind express or implied": "AsIs",
    "licensed under the apache license version 2 0": "Apache2ref",
    "licensed under the apache license version 2 0 the license": "Apache2ref",
    "you may not use this file except in compliance with the license": "Apache2comply",
    "you may obtain a copy of the license at": "Apache2copy",
    "this work is licensed under the gnu general public license version 3": "GPL3ref",
    "this work is licensed under the gnu general public license version 2": "GPL2ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "GPLfree",
    "either version 3 of the license or at your option any later version": "GPL3later",
    "either version 2 of the license or at your option any later version": "GPL2later",
    "this program is distributed in the hope that it will be useful but without any warranty": "GPLhope",
    "licensed under cc by nc 4 0": "CCBYNC4ref",
    "licensed under cc by 4 0": "CCBY4ref",
    "licensed under cc by sa 4 0": "CCBYSA4ref",
    "licensed under cc0 1 0": "CC01ref",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSDintro",
    "redistributions of source code must retain the above copyright notice": "BSDsource",
    "redistributions in binary form must reproduce the above copyright notice": "BSDbinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software": "BSDendorse",
    "all rights reserved": "AllRights",
}

# Rules in the order they are tried; each is a sequence of identifiers and the licence it shows.
RULES = [
    ("MITgrant MITnotice AsIs", "MIT"),
    ("MITgrant MITnotice", "MIT"),
    ("MITref", "MIT"),
    ("Apache2ref Apache2comply Apache2copy", "Apache-2.0"),
    ("Apache2ref Apache2comply", "Apache-2.0"),
    ("Apache2ref", "Apache-2.0"),
    ("GPLfree GPL3later GPLhope", "GPL-3.0-or-later"),
    ("GPLfree GPL3later", "GPL-3.0-or-later"),
    ("GPLfree GPL2later GPLhope", "GPL-2.0-or-later"),
    ("GPLfree GPL2later", "GPL-2.0-or-later"),
    ("GPL3ref", "GPL-3.0-only"),
    ("GPL2ref", "GPL-2.0-only"),
    ("BSDintro BSDsource BSDbinary BSDendorse", "BSD-3-Clause"),
    ("BSDintro BSDsource BSDbinary", "BSD-2-Clause"),
    ("CCBYNC4ref", "CC-BY-NC-4.0"),
    ("CCBY4ref", "CC-BY-4.0"),
    ("CCBYSA4ref", "CC-BY-SA-4.0"),
    ("CC01ref", "CC0-1.0"),
    ("AllRights", "proprietary"),
]

# Whole sentences of the public licence texts, normalised alike, and their identifiers.
FULL = {
    "this project is licensed under the mit license": "MITref",
    "this project is licensed under the mit license see the license": "MITref",  # LICENSE.md: the stop ends it
    "this project is licensed under the mit license see the license file for details": "MITref",
    "this software is released under the mit license": "MITref",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MITgrant",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "AsIs",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and non infringement": "AsIs",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSDsource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSDbinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDendorse",
}
for _named in ("this program is free software", "this library is free software", "this file is free software"):
    _free = _named + " you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"
    FULL[_free] = "GPLfree"
    for _version in "23":
        FULL[f"{_free} either version {_version} of the license or at your option any later version"] = f"GPLfree GPL{_version}later"
KNOWN = SENTENCES | FULL

# A sentence ends at ! or ?, or at a stop that no digit follows ("Version 2.0" stays whole). It may end at a line's end, ; or :.
STOP = "[!?]|[.](?![0-9])"
# Who may not be named differs from text to text.
HOLDER = ("neither the name of ", "[a-z0-9 |.]{1,200}?", " nor the names of (?:its|any|their|the) contributors")
ANY_HOLDER = "neither the name of the copyright holder nor the names of its contributors"
# The mark of a list's entry before a sentence.
ENTRY = "[0-9]{1,2} |[a-z] |i{2,3} |iv "


def _pattern() -> str:
    """A known sentence between two marks; the longest of those that begin at a place."""
    def gaps(words: str) -> str:
        return words.replace(" ", "[ |]")

    holder = gaps(HOLDER[0]) + HOLDER[1] + gaps(HOLDER[2]).replace("[ |]", "[ |.]", 1)  # after "Inc." or the like
    every = [gaps(s).replace(gaps(ANY_HOLDER), holder) for s in sorted(KNOWN, key=len, reverse=True)]
    return f"(?<=[|.])(?:{ENTRY})?(?:{'|'.join(every)})(?=[|.])"


def marked(text: str = "text") -> Column:
    """Words of a-z and 0-9 between single blanks; | where a sentence may end, and a stop where it must; a stop at both ends."""
    out = F.concat(F.lit("\n"), F.lower(F.coalesce(text, F.lit(""))), F.lit("\n"))
    out = F.regexp_replace(out, "[^a-z0-9.;:!?\\n\\r]+", " ")
    out = F.translate(F.regexp_replace(out, STOP, "\x01"), ".\n\r;:\x01", " ||||.")
    # Runs are shortened step by step, so that none is read again and again.
    out = F.regexp_replace(out, " {2,}", " ")
    out = F.regexp_replace(out, " ?[|][ |]*", "|")
    out = F.regexp_replace(out, "[ |]?[.][ |.]*", ".")
    return out


def sentence_ids(text: str = "text") -> Column:
    """Identifiers of the known sentences of a text, in order; empty for null."""
    found = F.regexp_extract_all(marked(text), F.lit(_pattern()), F.lit(0))
    plain = F.transform(found, lambda s: F.regexp_replace(F.translate(s, "|.", "  "), f"^(?:{ENTRY})", ""))
    plain = F.transform(plain, lambda s: F.regexp_replace(s, "".join(HOLDER), ANY_HOLDER))
    names = F.create_map(*[F.lit(x) for pair in KNOWN.items() for x in pair])
    return F.flatten(F.transform(plain, lambda s: F.split(F.element_at(names, s), " ")))


def scanned(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_known (known sentences), sentence_ids (one text), licences (sorted, joined by commas) and unmatched per row.

    `unmatched` counts known sentences that no rule used. A text without any, or null, has blank texts and zeros. Rows
    are judged one by one, so repeated ones come back as often; other columns play no part.
    """
    found = documents.select(F.col(doc_id), sentence_ids(text).alias("ids"))
    # Identifiers are kept between blanks of their own, so a rule matches whole identifiers only.
    rest = F.concat(F.lit(" "), F.array_join("ids", "  "), F.lit(" "))
    hits = []
    for sequence, licence in RULES:
        pattern = " " + sequence.replace(" ", "  ") + " "
        hits.append(F.when(F.contains(rest, F.lit(pattern)), F.lit(licence)))
        rest = F.replace(rest, F.lit(pattern), F.lit(" | "))
    out = found.withColumn("joined", F.array_join("ids", " "))
    quick = F.size("ids") > 0
    licences = F.when(quick, F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*hits)))), ",")).otherwise("")
    left = F.filter(F.split(rest, " "), lambda x: (x != "") & (x != "|"))
    return out.select(
        F.col(doc_id).alias("doc_id"), F.size("ids").cast("long").alias("n_known"), F.col("joined").alias("sentence_ids"),
        licences.alias("licences"), F.when(quick, F.size(left)).otherwise(0).cast("long").alias("unmatched"),
    )
