"""License scans by sentence rules; Column expressions only, in one narrow pass.

A text is cut in sentences, each is normalised and mapped to the identifier of a known licence sentence, and the
sequence of identifiers is matched against licence rules in their order: the first rule that fits at a place claims its
sentences, and what no rule claims stays as an unmatched sentence.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyforge.llm.spans import let

#: Public licence sentences and their identifiers, normalised as ``normalised`` does. A text that
#: ``SENTENCE_END`` cuts inside a sentence is listed by its parts, as cut.
SENTENCES = {
    "released under the mit license": "mit_ref",
    "licensed under the mit license": "mit_ref",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit_grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit_notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "mit_asis",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software": "mit_liability",
    "licensed under the apache license version 2 0": "apache2_ref",
    "licensed under the apache license version 2 0 the license": "apache2_ref",
    "you may not use this file except in compliance with the license": "apache2_comply",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache2_url",
    "you may obtain a copy of the license at": "apache2_at",
    "http www apache org licenses license 2 0": "apache2_link",
    "you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache2_url_asis",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied": "apache2_asis",
    "see the license for the specific language governing permissions and limitations under the license": "apache2_see",
    "this work is licensed under the gnu general public license version 3": "gpl3_ref",
    "this work is licensed under the gnu general public license version 2": "gpl2_ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3_later",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2_later",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose": "gpl_hope",
    "this program is free software": "gpl_free",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation": "gpl_terms",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3_terms",
    "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2_terms",
    "either version 3 of the license or at your option any later version": "gpl3_either",
    "either version 2 of the license or at your option any later version": "gpl2_either",
    "this program is distributed in the hope that it will be useful but without any warranty": "gpl_useful",
    "without even the implied warranty of merchantability or fitness for a particular purpose": "gpl_implied",
    "see the gnu general public license for more details": "gpl_see",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd_grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "bsd_source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "bsd_binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "bsd_name",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl2_ref",
    "this source code form is subject to the terms of the mozilla public license v": "mpl2_ref",  # of 'v. 2.0'; earlier versions say 'the contents of this file'
    "licensed under cc by nc 4 0": "ccbync4_ref",
    "licensed under cc by 4 0": "ccby4_ref",
    "licensed under cc by sa 4 0": "ccbysa4_ref",
    "this work is licensed under a creative commons attribution 4 0 international license": "ccby4_ref",
    "this work is licensed under a creative commons attribution noncommercial 4 0 international license": "ccbync4_ref",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation": "lgpl_terms",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version": "lgpl21_terms",
    "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgpl3_terms",
    "either version 2 1 of the license or at your option any later version": "lgpl21_either",
    "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "agpl3_terms",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc_grant",
    "this is free and unencumbered software released into the public domain": "unlicense_ref",
    "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work": "cc0_waiver",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0": "epl2_ref",
    "all rights reserved": "reserved",
}
#: Licence rules in order of precedence, longer sequences first.
RULES = [
    ("MIT", ["mit_grant", "mit_notice", "mit_asis", "mit_liability"]),
    ("MIT", ["mit_grant", "mit_notice", "mit_asis"]),
    ("MIT", ["mit_grant", "mit_notice"]),
    ("Apache-2.0", ["apache2_ref", "apache2_comply", "apache2_url", "apache2_asis", "apache2_see"]),
    ("Apache-2.0", ["apache2_ref", "apache2_comply", "apache2_at", "apache2_link", "apache2_asis", "apache2_see"]),
    ("Apache-2.0", ["apache2_ref", "apache2_comply", "apache2_url_asis", "apache2_see"]),
    ("Apache-2.0", ["apache2_ref", "apache2_comply"]),
    ("GPL-3.0-or-later", ["gpl_free", "gpl3_terms", "gpl_useful", "gpl_implied", "gpl_see"]),
    ("GPL-2.0-or-later", ["gpl_free", "gpl2_terms", "gpl_useful", "gpl_implied", "gpl_see"]),
    ("GPL-3.0-or-later", ["gpl_free", "gpl_terms", "gpl3_either", "gpl_useful", "gpl_implied", "gpl_see"]),
    ("GPL-2.0-or-later", ["gpl_free", "gpl_terms", "gpl2_either", "gpl_useful", "gpl_implied", "gpl_see"]),
    ("GPL-3.0-or-later", ["gpl3_later", "gpl_hope", "gpl_see"]),
    ("GPL-2.0-or-later", ["gpl2_later", "gpl_hope", "gpl_see"]),
    ("BSD-3-Clause", ["bsd_grant", "bsd_source", "bsd_binary", "bsd_name"]),
    ("BSD-2-Clause", ["bsd_grant", "bsd_source", "bsd_binary"]),
    ("MIT", ["mit_grant"]),
    ("GPL-3.0-or-later", ["gpl3_later"]),
    ("GPL-2.0-or-later", ["gpl2_later"]),
    ("GPL-3.0-or-later", ["gpl_free", "gpl3_terms"]),
    ("GPL-2.0-or-later", ["gpl_free", "gpl2_terms"]),
    ("GPL-3.0-or-later", ["gpl_free", "gpl_terms", "gpl3_either"]),
    ("GPL-2.0-or-later", ["gpl_free", "gpl_terms", "gpl2_either"]),
    ("LGPL-2.1-or-later", ["lgpl_terms", "lgpl21_either"]),
    ("LGPL-2.1-or-later", ["lgpl21_terms"]),
    ("LGPL-3.0-or-later", ["lgpl3_terms"]),
    ("LGPL-3.0-or-later", ["lgpl_terms", "gpl3_either"]),
    ("AGPL-3.0-or-later", ["agpl3_terms"]),
    ("ISC", ["isc_grant"]),
    ("Unlicense", ["unlicense_ref"]),
    ("CC0-1.0", ["cc0_waiver"]),
    ("EPL-2.0", ["epl2_ref"]),
    ("GPL-3.0-or-later", ["gpl3_terms"]),
    ("GPL-2.0-or-later", ["gpl2_terms"]),
    ("GPL-3.0-or-later", ["gpl_terms", "gpl3_either"]),
    ("GPL-2.0-or-later", ["gpl_terms", "gpl2_either"]),
    ("MIT", ["mit_ref"]),
    ("Apache-2.0", ["apache2_ref"]),
    ("GPL-3.0-only", ["gpl3_ref"]),
    ("GPL-2.0-only", ["gpl2_ref"]),
    ("MPL-2.0", ["mpl2_ref"]),
    ("CC-BY-NC-4.0", ["ccbync4_ref"]),
    ("CC-BY-4.0", ["ccby4_ref"]),
    ("CC-BY-SA-4.0", ["ccbysa4_ref"]),
    ("NOASSERTION", ["reserved"]),
]
#: A sentence ends at a full stop, question or exclamation mark, semicolon or colon before white space, or at a blank line.
SENTENCE_END = r"[.!?;:][\x20\x09\r]*\n|[.!?;:][\x20\x09]+|\n[\x20\x09]*\n"
#: Comment marks at the start of a line, and what is not a letter or digit.
_COMMENT = r"\n[\x20\x09]*(?://+|\*+|#+|;+|--)?[\x20\x09]*"
_NOISE = r"[^a-z0-9]+"
#: Words of which every known sentence holds one; a sentence without any is not normalised.
_HINT = r"(?i)licen[sc]|permission|copyright|software|warrant|liab|redistrib|rights"


def _check_table() -> None:
    """Every known sentence must be reachable: free of what the splitter cuts, hinted, and used by rules alone or not."""
    known, hint = set(SENTENCES.values()), re.compile(_HINT)
    for s in SENTENCES:
        if s != " ".join(re.split(_NOISE, s.lower())).strip() or not hint.search(s):
            raise ValueError(f"licence sentence can never match: {s}")
    if missing := {i for _, seq in RULES for i in seq} - known:
        raise ValueError(f"rules name unknown sentences: {sorted(missing)}")


_check_table()


def normalised(sentence: Column) -> Column:
    """Comment marks dropped, lower case, everything but a-z and 0-9 one space."""
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(sentence, _COMMENT, " ")), _NOISE, " "))


def sentence_ids(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order. A sentence that is not known as a whole is tried line by
    line, so that a licence line after an unfinished line counts."""
    known = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    lookup = lambda s: F.try_element_at(known, normalised(s))

    def ids(sentence: Column) -> Column:
        whole = F.array(lookup(sentence))
        lines = F.transform(F.split(sentence, "\n"), lookup)
        return F.when(F.element_at(whole, 1).isNotNull(), whole).otherwise(F.array_compact(lines))

    hinted = F.filter(F.split(text, SENTENCE_END), lambda s: s.rlike(_HINT))
    return F.flatten(F.transform(hinted, ids))


def matched_rules(ids: Column) -> Column:
    """Licences in order of their place. Identifiers are letters of a string of marks, and the rules, in order, are
    alternatives of one regex: at each place the first rule that fits claims its sentences."""
    pattern = "|".join("".join(f"<{i}>" for i in seq) for _, seq in RULES)
    names = F.create_map(*[F.lit(x) for x in dict(("".join(f"<{i}>" for i in seq), name) for name, seq in RULES).items() for x in x])
    marks = F.concat(F.lit(""), F.array_join(F.transform(ids, lambda i: F.concat(F.lit("<"), i, F.lit(">"))), ""))
    return F.transform(F.regexp_extract_all(marks, F.lit(pattern), F.lit(0)), lambda m: F.try_element_at(names, m))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``doc_id, n_sentences`` (known ones), ``sentences`` (their identifiers, comma-joined, in order),
    ``licenses`` (distinct, in order of first appearance, joined by " AND "; empty if none).

    Null and empty texts have none; null ids stay null; repeated rows repeat; other columns are ignored; an empty
    table gives none. Each row is handled by itself: no shuffle, no state."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    found = let(
        sentence_ids(text),
        lambda ids: F.struct(
            F.size(ids).alias("n"),
            F.array_join(ids, ",").alias("ids"),
            F.array_join(F.array_distinct(matched_rules(ids)), " AND ").alias("licenses"),
        ),
    )
    some = F.when(text.rlike(_HINT), found)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), some.alias("f")).select(
        "doc_id",
        F.coalesce("f.n", F.lit(0)).cast("long").alias("n_sentences"),
        F.coalesce("f.ids", F.lit("")).alias("sentences"),
        F.coalesce("f.licenses", F.lit("")).alias("licenses"),
    )
