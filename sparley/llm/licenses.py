"""Licence scans by the digest of a canonical text.

Letter case, punctuation, layout, copyright lines and equivalent spellings are
normalised, and the digest of what remains is hash-joined with those of known licences:
of whole texts, and of every line, as a line may name the licence of the text around it.
The table of digests is a parameter of the operator, a row for each known text, so it is
broadcast; texts and lines are read once and only the digests of whole texts and of
lines that are known leave a task.

Defined results: a null text and a text without letters or digits have the digest of the
empty text, which is no licence; repeated rows are looked up alike; an empty table gives
an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import FILE, ROW, addressed

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A line that starts with a copyright mark and a year, a sign or a name after it.
COPYRIGHT_LINE = r"(^|\n)[ \t*#/;-]*(copyright[ \t]+(\(c\)|©|[0-9])|\(c\)[ \t]|©)[^\n]*"
PUNCTUATION = r"[\x01-\x2F\x3A-\x60\x7B-\x7F]+"
#: Spellings that are the same in a licence.
SPELLINGS = (
    ("licenc", "licens"),
    ("sub licens", "sublicens"),
    ("organis", "organiz"),
    ("authoris", "authoriz"),
    ("recognis", "recogniz"),
    ("favour", "favor"),
    ("honour", "honor"),
    ("acknowledgement", "acknowledgment"),
    ("judgement", "judgment"),
    ("non commercial", "noncommercial"),
    ("whilst", "while"),
    ("wilful", "willful"),
    ("per cent", "percent"),
    ("https", "http"),
    (" all rights reserved", ""),
)

_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC_END = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
_BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution."""
_UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
#: The texts of short licences, and notices that stand for a longer one.
LICENSES = (
    ("MIT", _MIT_GRANT),
    ("MIT", "MIT License\n\n" + _MIT_GRANT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT_GRANT),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_END),
    ("ISC", "ISC License\n\nPermission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _ISC_END),
    ("0BSD", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n" + _ISC_END),
    ("BSD-2-Clause", _BSD_START + _BSD_END),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_START + _BSD_END),
    ("BSD-3-Clause", _BSD_START + _BSD_THIRD + _BSD_END),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_START + _BSD_THIRD + _BSD_END),
    ("Zlib", _ZLIB),
    ("Unlicense", _UNLICENSE),
    ("Unlicense", _UNLICENSE + "\n\nFor more information, please refer to <https://unlicense.org>"),
    ("Unlicense", _UNLICENSE + "\n\nFor more information, please refer to <http://unlicense.org/>"),
    ("Zlib", "zlib License\n\n" + _ZLIB),
    *((i, f"{verb} under {the}{name}.") for verb in ("Licensed", "Released", "Distributed", "This work is licensed", "This software is licensed", "This project is licensed") for i, the, name in (
        ("MIT", "the ", "MIT License"),
        ("Apache-2.0", "the ", "Apache License, Version 2.0"),
        ("GPL-3.0", "the ", "GNU General Public License, version 3"),
        ("GPL-2.0", "the ", "GNU General Public License, version 2"),
        ("LGPL-3.0", "the ", "GNU Lesser General Public License, version 3"),
        ("AGPL-3.0", "the ", "GNU Affero General Public License, version 3"),
        ("MPL-2.0", "the ", "Mozilla Public License, version 2.0"),
        ("BSD-2-Clause", "the ", "BSD 2-Clause License"),
        ("BSD-3-Clause", "the ", "BSD 3-Clause License"),
        ("ISC", "the ", "ISC License"),
        ("Zlib", "the ", "zlib License"),
        ("Unlicense", "the ", "Unlicense"),
        ("CC-BY-4.0", "", "CC BY 4.0"),
        ("CC-BY-SA-4.0", "", "CC BY-SA 4.0"),
        ("CC-BY-NC-4.0", "", "CC BY-NC 4.0"),
        ("CC-BY-ND-4.0", "", "CC BY-ND 4.0"),
        ("CC-BY-NC-SA-4.0", "", "CC BY-NC-SA 4.0"),
        ("CC0-1.0", "", "CC0 1.0"),
    )),
    *((i, f"SPDX-License-Identifier: {i}") for i in ("MIT", "Apache-2.0", "GPL-3.0-only", "GPL-3.0-or-later", "GPL-2.0-only", "GPL-2.0-or-later", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0-only", "AGPL-3.0-or-later", "BSD-2-Clause", "BSD-3-Clause", "ISC", "MPL-2.0", "CC0-1.0", "CC-BY-4.0", "Unlicense", "Zlib")),
)

#: Digests of the canonical texts of long licences, as published: whole, and, where
#: it is usual to leave them out, without what follows the terms.
DIGESTS = (
    ("Apache-2.0", "4bc3c949c895ead14c0dc8c6e33fd6ed118359acaad7c084c4d563cd526a878d"),
    ("Apache-2.0", "108490d21e2d3edc9128233e48fabc169818d0c7c5f0bbdd58231a367d2d6c87"),
    ("Apache-2.0", "6ed232a1aaf66db92997c53c056b853f2a64b9f74585489f71cbae1bb4d6d166"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-1.0", "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-2.0", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34"),
    ("GPL-3.0", "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a"),
    ("GPL-3.0", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.0", "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-2.1", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-2.0", "95f6a0d094cf3da6a140310541c7b576789031b600469b70877b34f97918e4c9"),
    ("MPL-2.0", "2cec6f733aa157c2d0b72e9669f75ca354f332218fcb5a3a885931f385272a04"),
    ("MPL-1.1", "fcb579371133afd771fed87cd5d8c6dc5648746c9945d4adf08ec5c79aba5c61"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "15f6a8d360ffdecc988c29279c00f23e20de17f14f2a06572ab0d41de6e98b7b"),
    ("GFDL-1.3", "2d36daeff2ad303badb6dee8149748be25e22974dd468e1e8a55cf40f16fc01d"),
    ("Artistic-1.0-Perl", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
)


def canonical(text: Column) -> Column:
    """The normalised text: words of lower-case letters and digits, one space between."""
    out = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    out = F.regexp_replace(out, COPYRIGHT_LINE, " ")
    out = F.concat(F.lit(" "), F.btrim(F.regexp_replace(out, PUNCTUATION, " ")))
    for a, b in SPELLINGS:
        out = F.replace(out, F.lit(a), F.lit(b))
    return F.btrim(out)


def digest(text: Column) -> Column:
    return F.sha2(canonical(text), 256)


def known(spark: SparkSession, licenses=LICENSES, digests=DIGESTS) -> DataFrame:
    """license_id and digest of each known text; a digest belongs to one licence."""
    texts = spark.createDataFrame(list(licenses), "license_id string, text string").select("license_id", digest(F.col("text")).alias("digest"))
    told = spark.createDataFrame(list(digests), "license_id string, digest string")
    return texts.unionByName(told).groupBy("digest").agg(F.min("license_id").alias("license_id"))


def scan(docs: DataFrame, licenses=LICENSES, digests=DIGESTS) -> DataFrame:
    """doc_id, text_digest, license_id (of the whole text, or null), n_notices and notices
    (the licences that lines name, in order, joined by commas) of doc_id and text."""
    table = F.broadcast(known(docs.sparkSession, licenses, digests))  # a row for each text of the parameters
    rows = addressed(docs.select("doc_id", "text"))
    whole = F.array(F.struct(F.lit(True).alias("whole"), F.coalesce("text", F.lit("")).alias("text")))
    lines = F.transform(F.coalesce(F.split("text", "\n"), F.array().cast("array<string>")), lambda x: F.struct(F.lit(False).alias("whole"), x.alias("text")))
    parts = rows.select("doc_id", FILE, ROW, F.explode(F.concat(whole, lines)).alias("part"))
    looked_up = parts.select("doc_id", FILE, ROW, "part.whole", digest(F.col("part.text")).alias("own")).join(table, F.col("own") == F.col("digest"), "left")
    some = looked_up.filter("whole OR license_id IS NOT NULL")
    one = lambda c: F.max(F.when(F.col("whole"), F.col(c)))
    line = F.when(~F.col("whole"), F.col("license_id"))
    out = some.groupBy(FILE, ROW).agg(F.first("doc_id").alias("doc_id"), one("own").alias("text_digest"), one("license_id").alias("license_id"), F.count(line).alias("n_notices"), F.array_join(F.array_sort(F.collect_set(line)), ",").alias("notices"))
    return out.drop(FILE, ROW)
