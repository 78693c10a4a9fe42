"""License scan: canonical digests of texts, joined to the digests of known licences.

A text and each of its lines are normalised (case, punctuation, copyright lines and
equivalent spellings), digested with SHA-256 and joined by equality with the digests of known
licence texts. No line is left out of the lookup. The known table has a fixed size, that of KNOWN, and is broadcast; what
is found goes back to its rows by doc_id and a hash of the text. Whole licences are read
from license_texts/, each with its title, with other usual titles and without one, with and without
its appendix; a text with other words than these, such as an own name in a BSD clause, is not known.

A null or empty text, or one that normalises to nothing, has no licence. A text that equals
several known ones lists all, in order. Repeated rows are judged alike. Columns of the input
other than doc_id and text are not carried.
"""

from __future__ import annotations

import re
from itertools import product
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Public licence texts and notices, by SPDX identifier; the copyright lines are left out.
KNOWN = {
    "MIT": (
        "Released under the MIT License.",
        "Licensed under the MIT License.",
        """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    ),
    "ISC": (
        """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    ),
    "Zlib": (
        """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.
Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:
1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
    ),
    "Apache-2.0": (
        "Licensed under the Apache License, Version 2.0.",
        "Released under the Apache License, Version 2.0.",
    ),
    "GPL-3.0-only": (
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under the GNU General Public License, version 3.",
        "Released under the GNU General Public License, version 3.",
    ),
    "CC-BY-NC-4.0": (
        "Licensed under CC BY-NC 4.0.",
        "Released under CC BY-NC 4.0.",
    ),
    "CC-BY-4.0": ("Licensed under CC BY 4.0.", "Released under CC BY 4.0."),
}
TEXTS = Path(__file__).parent / "license_texts"
# By SPDX identifier, where the body begins after the title, and titles under which it is published besides
# its own. A file of TEXTS is named by the identifier, and what comes after it tells several published forms apart.
BODIES = {
    "0BSD": ("Permission to use", ("BSD Zero Clause License", "Zero-Clause BSD", "Zero-Clause BSD License", "BSD-0-Clause")),
    "Apache-2.0": ("TERMS AND CONDITIONS", ("Apache License\nVersion 2.0, January 2004", "Apache License 2.0")),
    "Artistic-1.0-Perl": ("Preamble", ("The Artistic License",)),
    "BSD-2-Clause": ("Redistribution and use", ("BSD 2-Clause License", "The BSD 2-Clause License", "The 2-Clause BSD License", 'BSD 2-Clause "Simplified" License', "BSD License", "The BSD License", "Simplified BSD License")),
    "BSD-3-Clause": ("Redistribution and use", ("BSD 3-Clause License", "The BSD 3-Clause License", "The 3-Clause BSD License", 'BSD 3-Clause "New" or "Revised" License', "BSD License", "The BSD License", "New BSD License", "Modified BSD License")),
    "BSL-1.0": ("Permission is hereby", ("Boost Software License 1.0", "Boost Software License", "The Boost Software License 1.0")),
    "CC-BY-4.0": ("Creative Commons Attribution 4.0", ("Creative Commons Attribution 4.0 International",)),
    "CC-BY-SA-4.0": ("Creative Commons Attribution-ShareAlike 4.0", ("Creative Commons Attribution-ShareAlike 4.0 International",)),
    "CC0-1.0": ("Statement of Purpose", ("CC0 1.0 Universal", "Creative Commons CC0 1.0 Universal")),
    "GFDL-1.2-only": ("0. PREAMBLE", ("GNU Free Documentation License",)),
    "GFDL-1.3-only": ("0. PREAMBLE", ("GNU Free Documentation License",)),
    "GPL-1.0-only": ("Preamble", ("GNU GENERAL PUBLIC LICENSE\nVersion 1, February 1989",)),
    "GPL-2.0-only": ("Preamble", ("GNU GENERAL PUBLIC LICENSE\nVersion 2, June 1991",)),
    "GPL-3.0-only": ("Preamble", ("GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007",)),
    "ISC": ("Permission to use", ("ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)", "ISC")),
    "LGPL-2.0-only": ("Preamble", ("GNU LIBRARY GENERAL PUBLIC LICENSE\nVersion 2, June 1991",)),
    "LGPL-2.1-only": ("Preamble", ("GNU LESSER GENERAL PUBLIC LICENSE\nVersion 2.1, February 1999",)),
    "LGPL-3.0-only": ("This version of the GNU Lesser", ("GNU LESSER GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007",)),
    "MIT": ("Permission is hereby", ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)", "MIT", "Expat License")),
    "MPL-1.1": ("1. Definitions", ("Mozilla Public License Version 1.1",)),
    "MPL-2.0": ("1. Definitions", ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0")),
    "OFL-1.1": ("PREAMBLE", ("SIL OPEN FONT LICENSE Version 1.1 - 26 February 2007",)),
    "Unlicense": ("This is free and unencumbered", ("The Unlicense", "Unlicense")),
    "Zlib": ("This software is provided", ("zlib License", "The zlib License", "The zlib/libpng License", "zlib/libpng License")),
}
# By SPDX identifier, wordings and their published alternatives, each of which may or may not be taken.
WORDINGS = {
    "Apache-2.0": ((r"http://www", "https://www"), (r"(?m)^ *Copyright \[yyyy\].*$", "")),
    "BSD-2-Clause": ((r"COPYRIGHT HOLDER OR", "COPYRIGHT OWNER OR"), (r"(?m)^ *[12]\.", "*")),
    "BSD-3-Clause": ((r"COPYRIGHT OWNER OR|COPYRIGHT HOLDER OR", "COPYRIGHT OWNER OR"), (r"COPYRIGHT HOLDER OR|COPYRIGHT OWNER OR", "COPYRIGHT HOLDER OR"), (r"(?m)^ *[123]\.", "*"), (r"the copyright holder\b", "the copyright holders")),
    "GPL-3.0-only": ((r"https://", "http://"), (r"http(s?)://www\.gnu\.org/philosophy", r"http\1://www.gnu.org/licenses")),
    "ISC": ((r"and/or distribute", "and distribute"),),
    "LGPL-3.0-only": ((r"https://", "http://"),),
    "MIT": ((r"this permission notice shall", "this permission notice (including the next paragraph) shall"),),
    "MPL-2.0": ((r"https://", "http://"), (r"http://", "https://")),
    "Unlicense": ((r"http://", "https://"),),
}
#: What ends the terms; an appendix after it is not always published with them.
END = r"END OF TERMS AND CONDITIONS|(?m:^[= \n]*Creative Commons is not a party to its\b)"


def whole_texts() -> dict[str, list[str]]:
    """The published forms of whole licences by SPDX identifier."""
    out: dict[str, list[str]] = {}
    for name, (begin, titles) in BODIES.items():
        # A notice is never a body: those of KNOWN with several lines are.
        plain = [p.read_text(encoding="utf-8") for p in sorted(TEXTS.glob(f"{name}.*txt"))] + [t for t in KNOWN.get(name, ()) if "\n" in t]
        forms = dict.fromkeys(plain)
        for pattern, other in WORDINGS.get(name, ()):
            forms |= dict.fromkeys(re.sub(pattern, other, t) for t in list(forms))
        for text in list(forms):
            if m := re.search(END, text):
                forms |= dict.fromkeys((text[: m.start()], text[: m.end()] if m[0].startswith("END") else text[: m.start()]))
        whole = dict.fromkeys(forms)
        for text, title, rights in product(forms, ("", *titles), ("", "All rights reserved.\n")):
            if not rights or name in SHORT:
                whole[f"{title}\n{rights}{text[text.index(begin) :]}"] = None
        # Texts that are the same but for spaces and signs are one.
        out[name] = list({re.sub(r"\W+", " ", re.sub(COPYRIGHT_LINE, " ", t)).strip().lower(): t for t in whole}.values())
    return out


#: Short licences, under whose copyright line all rights are often said to be reserved.
SHORT = ("0BSD", "BSD-2-Clause", "BSD-3-Clause", "ISC", "MIT", "Zlib")
#: Licences that let the text be used for training without further terms.
PERMISSIVE = ("MIT", "ISC", "Zlib", "Apache-2.0", "CC-BY-4.0", "0BSD", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC0-1.0", "Unlicense")
# Spellings that count as one, by the spelling that stands for them.
SPELLINGS = {
    "license": ("licences?", "licensed", "licenced", "licenses"),
    "organization": ("organisation",),
    "noncommercial": ("non ?commercial",),
    "merchantability": ("merchantibility",),
    "sublicense": ("sub license",),
    "noninfringement": ("noninfringment",),
    "acknowledgment": ("acknowledgement",),
}
COPYRIGHT_LINE = r"(?im)^[ \t]*(?:(?:copyright[ \t]*)?(?:\(c\)|©)|copyright[ \t]+[0-9])[^\n]*$"
for _name, _texts in whole_texts().items():
    KNOWN[_name] = (*KNOWN.get(_name, ()), *_texts)


def _spelled(text: Column, patterns: dict[str, tuple[str, ...]]) -> Column:
    for plain, others in patterns.items():
        text = F.regexp_replace(text, rf"\b(?:{'|'.join(others)})\b", plain)
    return text


def normalised_lines(text: Column) -> Column:
    """Lower case, without copyright lines, one space between words, no punctuation, one spelling each; lines are kept."""
    out = F.lower(F.regexp_replace(text, COPYRIGHT_LINE, " "))
    out = F.regexp_replace(out, r"[^\p{L}\p{N}\n]+", " ")
    return _spelled(out, SPELLINGS)


def joined_lines(lines: Column) -> Column:
    """A text of normalised lines as one line; spellings of two words may have been parted by its end."""
    return _spelled(F.trim(F.regexp_replace(lines, r"[ \n]+", " ")), {k: v for k, v in SPELLINGS.items() if any(" " in x for x in v)})


def known_digests(spark: SparkSession) -> DataFrame:
    """digest of each known text and its licences; as many rows as KNOWN has, whatever the input."""
    rows = [(name, text) for name, texts in KNOWN.items() for text in texts]
    at = spark.createDataFrame(rows, "license string, known string")
    digest = F.sha2(joined_lines(normalised_lines(F.col("known"))), 256)
    return at.groupBy(digest.alias("digest")).agg(F.array_sort(F.collect_set("license")).alias("names"))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """doc_id, license (of the whole text, or null), line_licenses (of its lines, sorted, distinct), permissive.

    The whole text and each of its lines are pieces, found by one join of digests. permissive is null where
    no licence is found.
    """
    text = F.coalesce("text", F.lit(""))
    keyed = docs.select("doc_id", F.xxhash64(text).alias("th"), text.alias("text"))
    lines = keyed.select("doc_id", "th", normalised_lines(F.col("text")).alias("lines"))
    pieces = F.concat(F.array(F.struct(joined_lines(F.col("lines")).alias("piece"), F.lit(True).alias("whole"))), F.transform(F.split("lines", "\n"), lambda x: F.struct(F.trim(x).alias("piece"), F.lit(False).alias("whole"))))
    each = lines.select("doc_id", "th", F.explode(pieces).alias("p")).where("p.piece != ''").select("doc_id", "th", "p.whole", F.sha2("p.piece", 256).alias("digest"))
    hits = each.join(F.broadcast(known_digests(docs.sparkSession)), "digest").select("doc_id", "th", "whole", F.explode("names").alias("name"))
    named = lambda whole: F.array_sort(F.collect_set(F.when(whole, F.col("name"))))
    of = hits.groupBy(F.col("doc_id").alias("own"), F.col("th").alias("hash")).agg(
        named(F.col("whole")).alias("of_text"), named(~F.col("whole")).alias("of_lines"), F.min(F.col("name").isin(*PERMISSIVE)).alias("permissive")
    )
    found = keyed.select("doc_id", "th").join(of, F.col("doc_id").eqNullSafe(F.col("own")) & (F.col("th") == F.col("hash")), "left")
    return found.select(
        "doc_id",
        F.when(F.size("of_text") > 0, F.array_join("of_text", ",")).alias("license"),
        F.coalesce(F.array_join("of_lines", ","), F.lit("")).alias("line_licenses"),
        "permissive",
    )
