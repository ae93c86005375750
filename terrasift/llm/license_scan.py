"""Licence scans by sentence rules.

Texts are cut into pieces at sentence ends and line breaks. A known licence sentence
is one piece or several that follow one another by line breaks (a wrapped sentence),
normalised, and is mapped to its identifier; of several that begin at one piece the
longest counts. The identifiers that occur in a text, in order, are
matched against ordered rules: a rule is a sequence of identifiers that must
follow one another directly; the first rule that fits names the licence. All of
it is array functions on the row, so nothing is shuffled.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known sentences, normalised, with their identifiers.
SENTENCES = {
    "licensed under cc by nc 4 0": "ByNcNotice",
    "licensed under cc by 4 0": "ByNotice",
    "licensed under cc by sa 4 0": "BySaNotice",
    "this work is licensed under the gnu general public license version 3": "Gpl3Work",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license": "GplTerms",
    "licensed under the apache license version 2 0": "Apache2Notice",
    "you may not use this file except in compliance with the license": "ApacheCompliance",
    "released under the mit license": "MitNotice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software": "MitGrant",
    "all rights reserved": "AllRights",
    # Whole sentences of the usual notices.
    "licensed under the apache license version 2 0 the license": "Apache2Notice",
    "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license": "Apache2Header",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "Gpl3Terms",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "Gpl2Terms",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation": "Gpl2Terms",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "Agpl3Terms",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version": "Lgpl21Terms",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "Lgpl3Terms",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "Lgpl3Terms",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "Mpl2Notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MitGrant",
    "licensed under the mit license": "MitNotice",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BsdGrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BsdSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BsdBinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BsdNames",
    "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed": "BsdDisclaimer",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "IscGrant",
    "this is free and unencumbered software released into the public domain": "Unlicense",
    **{
        f"this work is licensed under {article}creative commons {words} 4 0 international license": name
        for article in ("a ", "the ")
        for words, name in (("attribution", "ByNotice"), ("attribution sharealike", "BySaNotice"), ("attribution noncommercial", "ByNcNotice"))
    },
}
# Licences with the identifier sequences that show them, in order of precedence.
RULES = (
    ("Apache-2.0", ("Apache2Notice", "ApacheCompliance")),
    ("Apache-2.0", ("Apache2Notice",)),
    ("Apache-2.0", ("Apache2Header",)),
    ("Apache-2.0", ("ApacheCompliance",)),
    ("GPL-3.0", ("Gpl3Work", "GplTerms")),
    ("GPL-3.0", ("Gpl3Work",)),
    ("GPL-3.0", ("Gpl3Terms",)),
    ("GPL-2.0", ("Gpl2Terms",)),
    ("AGPL-3.0", ("Agpl3Terms",)),
    ("LGPL-3.0", ("Lgpl3Terms",)),
    ("LGPL-2.1", ("Lgpl21Terms",)),
    ("MPL-2.0", ("Mpl2Notice",)),
    ("GPL", ("GplTerms",)),
    ("MIT", ("MitNotice", "MitGrant")),
    ("MIT", ("MitNotice",)),
    ("MIT", ("MitGrant",)),
    ("BSD-3-Clause", ("BsdGrant", "BsdSource", "BsdBinary", "BsdNames")),
    ("BSD-2-Clause", ("BsdGrant", "BsdSource", "BsdBinary", "BsdDisclaimer")),
    ("BSD", ("BsdGrant",)),
    ("ISC", ("IscGrant",)),
    ("Unlicense", ("Unlicense",)),
    ("CC-BY-NC-4.0", ("ByNcNotice",)),
    ("CC-BY-SA-4.0", ("BySaNotice",)),
    ("CC-BY-4.0", ("ByNotice",)),
    ("proprietary", ("AllRights",)),
)
# A piece ends at a line break, or at . ! ? before a blank or the end.
_STOP = r"[.!?]+(?=\s|$)"
ENDS = rf"\n|{_STOP}"


def hint_of(sentences) -> str:
    """Texts without one of these words, the longest of each sentence, have none of the sentences."""
    return "(?i)" + ("|".join(sorted({re.escape(max(s.split(), key=len)) for s in sentences if s.split()})) or "(?!)")


HINT = hint_of(SENTENCES)


def _pattern(sentences) -> str:
    """The sentences, the longest first, between ends of pieces. Lines may break between words, and an end may follow "v."."""
    def one(sentence: str) -> str:
        return r"[ \n]".join(map(re.escape, sentence.split())).replace(r"[ \n]v[ \n]", r"[ \n]v[ \n\x1e]")

    return r"(?<![^\n\x1e])(?:" + "|".join(map(one, sorted(sentences, key=lambda s: (-len(s), s)))) + r")(?![^\n\x1e])"


def normalised(text: Column) -> Column:
    """Lower case, runs of anything but ASCII letters and digits as one blank, line break, or at
    sentence ends and empty lines one record separator."""
    text = F.regexp_replace(F.translate(F.lower(text), "\x1e", " "), _STOP, "\x1e")
    text = F.regexp_replace(text, r"[^a-z0-9\n\x1e]+", " ")
    text = F.regexp_replace(text, r"[ \n]*(?:\x1e|\n *\n)[ \n\x1e]*", "\x1e")
    return F.trim(F.regexp_replace(text, r" ?\n ?", "\n"))


def scan_licenses(docs: DataFrame, sentences=None, rules=RULES) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, n_sentences, sentence_ids, license, licenses.

    ``n_sentences`` counts pieces, ``sentence_ids`` lists the identifiers in order, joined by commas; ``license``
    is that of the first rule that fits, ``licenses`` of all rules in their order,
    joined by commas, each once. Without a known sentence these are empty, and
    ``license`` is null. Null texts have no sentences. Rows without a doc_id and
    repeated rows stay as they are; other columns are not read.
    """
    sentences = SENTENCES if sentences is None else sentences
    text = F.coalesce("text", F.lit(""))
    parts = F.filter(F.split(text, ENDS), lambda s: F.length(F.regexp_replace(s, r"[^A-Za-z0-9]", "")) > 0)
    ids = F.array().cast("array<string>")
    if sentences:
        known = F.create_map(*[F.lit(x) for pair in sentences.items() for x in pair])
        found = F.regexp_extract_all(normalised(text), F.lit(_pattern(sentences)), F.lit(0))
        found = F.transform(found, lambda s: F.element_at(known, F.translate(s, "\n\x1e", "  ")))
        ids = F.when(F.lower(text).rlike(hint_of(sentences)), found).otherwise(ids)
    rows = docs.select("doc_id", F.size(parts).cast("long").alias("n_sentences"), ids.alias("ids"))
    rows = rows.withColumn("sentence_ids", F.array_join("ids", ","))
    line = F.concat(F.lit(","), "sentence_ids", F.lit(","))
    fits = F.array_compact(F.array(*[F.when(line.contains("," + ",".join(ids) + ","), F.lit(name)) for name, ids in rules]))
    rows = rows.withColumn("found", F.array_distinct(fits))
    return rows.select("doc_id", "n_sentences", "sentence_ids", F.get("found", F.lit(0)).alias("license"), F.array_join("found", ",").alias("licenses"))
