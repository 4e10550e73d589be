"""Licence scan by canonical digests, in DataFrame functions only.

A text is brought to a canonical form: lower case, lines of copyright notices dropped, equivalent spellings unified,
every run of other characters than letters and digits one space. Its md5 digest is joined with the digests of known
licences in the same form. Looked up are the whole text and, as licence notices often stand inside of other text, each whole
paragraph (between blank lines) and each whole line of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that count as equal.
SPELLINGS = {
    "licence": "license", "licences": "licenses", "licenced": "licensed", "sub license": "sublicense",
    "organisation": "organization", "organisations": "organizations", "favour": "favor", "behaviour": "behavior",
    "recognise": "recognize", "fulfil": "fulfill", "non commercial": "noncommercial", "merchantability": "merchantability",
    "whilst": "while", "acknowledgement": "acknowledgment", "per cent": "percent", "copyright owner": "copyright holder",
}
COPYRIGHT_LINE = r"(^|\n)[ \t*#/;-]*(copyright|\(c\)|©|all rights reserved)[^\n]*"

_PERMISSION = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    "documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation "
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions:\n\n"
)
_NOTICE = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the Software.\n\n"
)
_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO "
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, "
    "TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE "
    "SOFTWARE."
)
_ISC = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL "
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
    "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)
_BSD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
    "conditions are met:\n\n1. Redistributions of source code must retain the above copyright notice, this list of conditions and the "
    "following disclaimer.\n\n2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and "
    "the following disclaimer in the documentation and/or other materials provided with the distribution.\n\n"
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived "
    "from this software without specific prior written permission.\n\n"
)
_BSD_AS_IS = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT "
    "NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL "
    "THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS "
    "INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE "
    "OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
# Public licence texts and the usual one-line notices, (licence id, text).
KNOWN = [
    *[("BSD-3-Clause", title + _BSD + _BSD_NAMES + _BSD_AS_IS) for title in ("", "BSD 3-Clause License\n\n")],
    *[("BSD-2-Clause", title + _BSD + _BSD_AS_IS) for title in ("", "BSD 2-Clause License\n\n")],
    ("MIT", "MIT License\n\nCopyright (c)\n\n" + _PERMISSION + _NOTICE + _AS_IS),
    ("MIT", "The MIT License (MIT)\n\n" + _PERMISSION + _NOTICE + _AS_IS),
    ("MIT", _PERMISSION + _NOTICE + _AS_IS),
    ("MIT-0", _PERMISSION.replace(", subject to the following conditions:", ".") + _AS_IS),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
            "hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n"
            + _ISC),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
             "hereby granted.\n\n" + _ISC),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "Licensed under the GNU General Public License, version 2."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC0-1.0", "This work is dedicated to the public domain under CC0 1.0."),
]

# Digests of the canonical form of common whole texts, as they are published, without what follows their terms, and each also
# with its paragraphs on one line (a line that begins with the word copyright is dropped, so the breaks of lines count).
DIGESTS = {
    "Apache-2.0": (
        "9768e9ac0a2ddb298695e7c2ca9bfa36",
        "ff27ba34e8ac36ddab0cbf04160132c5",
        "db4fae888ce4068810986a16e5953e7a",
        "80fd9072ff3abaac5ce5940ef25ed199",
        "4c6e317f52b13dccc5c775e26cc6d6b5",
        "5d21db9df0a659189b7aace1dc3df9b0",
    ),
    "Artistic-1.0": (
        "7fcf35f5ad3314fa9254c4e56baaceb8",
        "01297679267ad921516667ccd889865e",
    ),
    "BSD-3-Clause": (
        "ddcd765ed0a3236bf96e15f76c36983a",
    ),
    "CC0-1.0": (
        "93a180096f6cfcf2c0dd24f75c2eec48",
    ),
    "GFDL-1.2": (
        "6fae616a2084258d6f1635920433f2e2",
        "3fd7564fae8e9870c49a2b6749a4686c",
        "8e05c0aebdb35d56dcb04fe0f3aab4db",
        "f54fadee6f0a84667b90430775414a11",
    ),
    "GFDL-1.3": (
        "9715992e76e496f0c0d0a6fcfb268fed",
        "a5eac5dd01441a89eba8fc8853145b0a",
        "9c491806b8ebfaf789102d37792907b1",
        "9b03f0510b5e6389393f0b9aab87c96e",
    ),
    "GPL-1.0": (
        "738cc3b112640d95d4cd79a58967ecea",
        "bbc56cff7140c8c3cd4b868fb25de455",
        "dbf3c47f5a8f127e58d08cabc1ebb916",
        "3aecf3f85b2a7e1cf719c688a1c214fa",
        "21fa8693acc5194a648fe02e11f65a72",
        "ed18f57e6f8be34d9ff1e08bcf9104cb",
    ),
    "GPL-2.0": (
        "e374d0b43c25aed1a2b28951fe92a546",
        "c87461d4dc2703de84305277d25c82d8",
        "cbb3451938de95cbb302d3c10690ede8",
        "b8444fd08fb20cd8d245a1c56739b50b",
        "95f8e6eea7034bb28698597e2a21390c",
        "87c1ab3e4b266c98ddc0fafc9e827ec1",
    ),
    "GPL-3.0": (
        "057f186a69ca5796ed5fd60ffc00e686",
        "bd6f8bc415c5aa9e7c23dc0e19215f22",
        "9622e348e3655fc913d2a9a03f2362b1",
        "2ae5765f3e9def05b0d98370c5a5657d",
        "d7b2d50fa70d40ab725f812119aa2d3d",
        "f658e875d8d139792f31fecf68fd1a58",
    ),
    "LGPL-2.0": (
        "63ac11b5b2fcfe811ff161b9e5def0c5",
        "999f5b95aaa9362eae0bf3cb0eb7581c",
        "1389f4e6c9257fffaaa58a4ba72e4209",
        "53c7c83fea2ab2dfecbf363917d53a22",
        "67adee7de2991bbdb3346ca63ffc6b75",
        "65f359e639bdee839cb4bef5e2e86d5d",
    ),
    "LGPL-2.1": (
        "b0e44c745072418c0ff11407a0bc4ffc",
        "b438fe0ce082f3615cf69a492dbc792f",
        "ea4739ccf5314c5f636f979cc03259e2",
        "a40966c05dddcd43bfccd88fd4e2cfe7",
        "8bafa4c612887b0b12bf68d7e5fe0527",
        "940870bf133cfca37ab654966cecabe4",
    ),
    "LGPL-3.0": (
        "b31b7335bc37919e8cdd79154e04d88d",
        "087dc82eb7c367aa4297b1f0bb1c2c21",
    ),
    "MPL-1.1": (
        "b7edc06df79bc44a04f12befb8111960",
        "78c2a2394a9705d36b95f4476aedc69c",
        "fe448c137d57f580a7e10b9a06ee657d",
        "01fed7e53e79fea472dfa04ce26bcd7a",
    ),
    "MPL-2.0": (
        "35fb4d2625087f7fd780039aa7b4ebb2",
        "04f1aa7265a0b508cecbfab9de83b56c",
        "e4dcd8d38e594750386e39c960c18aec",
        "1967c3764d66509038315139ffda7051",
    ),
}


def known_licences(spark: SparkSession) -> DataFrame:
    """``license_id, text`` of the built-in licences that are held as texts."""
    return spark.createDataFrame(KNOWN, "license_id string, text string")


def known_digests(spark: SparkSession) -> DataFrame:
    """``license_id, digest`` of the built-in licences that are held as digests."""
    return spark.createDataFrame([(i, d) for i, many in DIGESTS.items() for d in many], "license_id string, digest string")


def canonical(text: Column) -> Column:
    """The canonical form, with the line breaks of the text."""
    out = F.regexp_replace(F.lower(text), COPYRIGHT_LINE, "$1")
    out = F.regexp_replace(out, r"[^\p{L}\p{N}\n]+", " ")
    out = F.regexp_replace(out, r" ?\n ?", "\n")
    same = "|".join(sorted((k for k, v in SPELLINGS.items() if k != v), key=len, reverse=True))
    found = F.regexp_extract_all(out, F.lit(rf"\b({same})\b"), F.lit(1))
    table = F.create_map(*[F.lit(x) for k, v in SPELLINGS.items() if k != v for x in (k, v)])
    once = F.array_distinct(found)  # only texts that hold such spellings are rewritten
    fixed = F.aggregate(once, out, lambda s, w: F.regexp_replace(s, F.concat(F.lit(r"\b"), w, F.lit(r"\b")), table[w]))
    return F.trim(F.when(F.size(once) > 0, fixed).otherwise(out))


def _flat(form: Column) -> Column:
    return F.trim(F.regexp_replace(form, r"[ \n]+", " "))


def scan_licences(
    df: DataFrame, known: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``df``: ``doc_id, digest`` (md5 of the canonical whole text), ``license_id`` (of the licence the
    whole text is, else null), ``notices`` (ids of licences that the whole text, a paragraph or a line is; sorted,
    comma-joined, empty if none).

    ``known``: columns license_id, text (default: the built-in texts and digests); a text known under several ids counts for the smallest id. Null texts are
    empty; an empty canonical form matches nothing. Repeated rows each get their row. Empty in, empty out.
    """
    built_in = known is None
    known = known_licences(df.sparkSession) if built_in else known
    form = F.md5(_flat(canonical(F.col("text"))))
    digests = known.where(_flat(canonical(F.col("text"))) != "").select("license_id", form.alias("digest"))
    if built_in:
        digests = digests.union(known_digests(df.sparkSession))
    digests = digests.groupBy("digest").agg(F.min("license_id").alias("found"))
    rows = df.select(
        F.col(id_col).alias("doc_id"), canonical(F.coalesce(F.col(text_col), F.lit(""))).alias("form"),
        F.monotonically_increasing_id().alias("row"),  # used within the task that makes it only
    )
    lines = F.split("form", r"\n+")
    paragraphs = F.when(F.contains("form", F.lit("\n\n")), F.split("form", r"\n{2,}")).otherwise(F.array())
    units = F.concat(F.array("form"), F.when(F.contains("form", F.lit("\n")), F.concat(paragraphs, lines)).otherwise(F.array()))
    digest = F.md5(_flat(F.col("unit")))
    exploded = rows.select("doc_id", "row", F.posexplode(units).alias("place", "unit")).where("place = 0 or unit <> ''")
    whole = F.col("place") == 0
    return (
        exploded.select("doc_id", "row", "place", digest.alias("digest"))
        .join(digests, "digest", "left")
        .groupBy("row", "doc_id")
        .agg(
            F.max(F.when(whole, F.col("digest"))).alias("digest"),
            F.max(F.when(whole, F.col("found"))).alias("license_id"),
            F.array_join(F.array_sort(F.collect_set("found")), ",").alias("notices"),
        )
        .drop("row")
    )


def _sql_form(text: str) -> str:
    steps = f"regexp_replace(lower({text}), '{COPYRIGHT_LINE}', '\\1', 'g')"
    steps = f"regexp_replace({steps}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"
    steps = f"regexp_replace({steps}, ' ?\\n ?', '\n', 'g')".replace("'\n'", "chr(10)")
    for k, v in sorted(((k, v) for k, v in SPELLINGS.items() if k != v), key=lambda x: -len(x[0])):
        steps = f"regexp_replace({steps}, '\\b{k}\\b', '{v}', 'g')"
    return f"trim({steps})"


def _sql_digest(form: str) -> str:
    return f"md5(trim(regexp_replace({form}, '[ \\n]+', ' ', 'g')))"


def scan_sql() -> str:
    """DuckDB SQL for ``scan_licences(documents)``."""
    values = ", ".join("('{}', '{}')".format(i, t.replace("'", "''")) for i, t in KNOWN)
    whole = ", ".join(f"('{i}', '{d}')" for i, many in DIGESTS.items() for d in many)
    return f"""
    WITH known AS (SELECT digest, min(license_id) AS found FROM (
                     SELECT license_id, {_sql_digest(_sql_form('text'))} AS digest FROM (VALUES {values}) t(license_id, text)
                     UNION ALL SELECT * FROM (VALUES {whole}) d(license_id, digest)) GROUP BY 1),
    forms AS (SELECT row_number() OVER () AS r, doc_id, {_sql_form("coalesce(text, '')")} AS form FROM documents),
    units AS (
      SELECT r, doc_id, 0 AS place, form AS unit FROM forms
      UNION ALL SELECT r, doc_id, 1, unnest(string_split_regex(form, '\\n+')) FROM forms WHERE contains(form, chr(10))
      UNION ALL SELECT r, doc_id, 1, unnest(string_split_regex(form, '\\n{{2,}}')) FROM forms WHERE contains(form, chr(10) || chr(10))),
    looked AS (SELECT r, doc_id, place, u.digest, found FROM
               (SELECT *, {_sql_digest('unit')} AS digest FROM units WHERE place = 0 OR unit <> '') u
               LEFT JOIN known ON known.digest = u.digest)
    SELECT doc_id, max(CASE WHEN place = 0 THEN digest END) AS digest, max(CASE WHEN place = 0 THEN found END) AS license_id,
           coalesce(string_agg(DISTINCT found, ',' ORDER BY found), '') AS notices
    FROM looked GROUP BY r, doc_id"""
