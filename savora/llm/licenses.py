"""Licence notices: lines and paragraphs against templates by Dice's coefficient over word bigrams."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable
from math import ceil

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from savora.llm.text import texts

# Fixed: the usual short notices of public licences, by SPDX identifier.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3."),
    ("AGPL-3.0", "This work is licensed under the GNU Affero General Public License, version 3."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("Unlicense", "This is free and unencumbered software released into the public domain."),
    ("CC0-1.0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
)

# Fixed: licence texts and headers of source files, by paragraph and joined. Disclaimers that several licences share
# word for word tell none of them, and stand in joined texts only.
TEXTS = (
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:"),
    ("MIT", "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software."),
    ("MIT", "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."),
    ("BSD-2-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."),
    ("BSD-3-Clause", "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."),
    ("Zlib", "This software is provided \"as-is\", without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software."),
    ("Zlib", "Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("Zlib", "This software is provided \"as-is\", without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:"),
    ("Unlicense", "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("Apache-2.0", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("LGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Lesser General Public License for more details."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("AGPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU Affero General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU Affero General Public License for more details."),
    ("GPL-2.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."),
)
TEMPLATES = NOTICES + TEXTS


def _words(text: Column) -> Column:
    """Runs of a-z and digits, A-Z lower-cased."""
    return F.filter(F.split(F.translate(text, *_LOWER), "[^a-z0-9]+"), lambda w: w != "")


_LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def _bigrams(words: str) -> Column:
    """Distinct pairs of consecutive words; a single word is its own."""
    n = F.greatest(F.size(words) - 1, F.lit(0))
    # Zipped, so that no lambda names the words and has them made again for each pair.
    pairs = F.arrays_zip(F.slice(words, 1, n).alias("a"), F.slice(words, 2, n).alias("b"))
    joined = F.transform(pairs, lambda p: F.concat_ws(" ", p["a"], p["b"]))
    return F.array_distinct(F.when(F.size(words) == 1, F.col(words)).otherwise(joined))


def _units(rows: DataFrame) -> DataFrame:
    """``doc_id, line, unit``: every line, and every paragraph of several lines; lines count from 1.

    Paragraphs stand between lines that are empty but for blanks.
    """
    split = rows.select("doc_id", F.split("text", "\n").alias("lines"))
    blank = F.filter(F.transform("lines", lambda line, i: F.when(F.trim(line) == "", i + 1)), lambda i: i.isNotNull())
    bounds = split.select(
        "doc_id", "lines", F.concat(F.array(F.lit(0)), blank, F.array(F.size("lines") + 1)).alias("bounds")
    )
    gaps = F.arrays_zip(
        F.slice("bounds", 1, F.size("bounds") - 1).alias("before"), F.slice("bounds", 2, F.size("bounds") - 1).alias("end")
    )
    lines = F.transform("lines", lambda line, i: _unit(i + 1, line))
    # Joined inside the array: after an explode each paragraph would carry all lines of its text.
    paragraphs = F.transform(
        F.filter(gaps, lambda g: g["end"] - g["before"] > 2),
        lambda g: _unit(g["before"] + 1, F.concat_ws(" ", F.slice("lines", g["before"] + 1, g["end"] - g["before"] - 1))),
    )
    return bounds.select("doc_id", F.explode(F.concat(lines, paragraphs)).alias("u")).select("doc_id", "u.line", "u.unit")


def _unit(line: Column, text: Column) -> Column:
    return F.struct(line.cast("long").alias("line"), text.alias("unit"))


def probes(bigrams: Iterable[set[str]], min_dice: float) -> list[str]:
    """Bigrams of which every unit has one that comes up to ``min_dice`` with any template.

    Such a unit shares at least ``t / (2 - t)`` of a template's bigrams, so it cannot miss all of any others
    that are more than the rest. Long bigrams are taken, which are rare, and those that serve several templates.
    """
    chosen: set[str] = set()
    for own in bigrams:
        most_missed = len(own) - ceil(len(own) * min_dice / (2 - min_dice) - 1e-9)
        ranked = sorted(own, key=lambda b: (b not in chosen, -len(b), b))
        chosen.update(ranked[: most_missed + 1])
    return sorted(chosen)


def _pattern(bigrams: list[str]) -> str:
    """A pattern for texts that have one of the bigrams; only A-Z are taken for a-z, as in ``_words``."""
    if not bigrams:
        return "(?!)"
    # By first letter, so that most words are passed over after one look at each letter.
    tails = defaultdict(list)
    for b in bigrams:
        tails[b[0]].append(b[1:].replace(" ", "[^a-z0-9]+"))
    either = "|".join(f"{first}(?:{'|'.join(rest)})" for first, rest in tails.items())
    return f"(?i)(?<![a-z0-9])(?:{either})(?![a-z0-9])"


def template_bigrams(spark: SparkSession, templates: Iterable[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """``template, license, size, bigram``: a row per distinct bigram of each template."""
    rows = [(i, name, text) for i, (name, text) in enumerate(templates)]
    words = spark.createDataFrame(rows, "template int, license string, text string").select(
        "template", "license", _words(F.col("text")).alias("words")
    )
    return words.select("template", "license", _bigrams("words").alias("b")).select(
        "template", "license", F.size("b").alias("size"), F.explode("b").alias("bigram")
    )


def license_notices(
    docs: DataFrame, templates: Iterable[tuple[str, str]] = TEMPLATES, min_dice: float = 0.8, *,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``doc_id, line, license, dice``: the licence that a line or paragraph of a text states.

    The coefficient is twice the common bigrams over the bigrams of both; ``dice`` is the best of all
    templates and of the line and the paragraph that begin at ``line``, of equals the first by name. Texts and units
    without any of the bigrams that ``min_dice`` asks for (``probes``) go first; sizes a unit cannot have at
    ``min_dice`` rule a template out before bigrams are compared. A text that is null, empty or without words has no rows.
    Rows that repeat an id and a line are one; null ids count as one document. Other columns are not looked
    at.

    Templates are a list in the program, and so a small broadcast; only common bigrams are shuffled, summed up.
    """
    known = template_bigrams(docs.sparkSession, templates)
    of_template = defaultdict(set)
    for row in known.select("template", "bigram").collect():
        of_template[row.template].add(row.bigram)
    stated = F.rlike(F.col("text"), F.lit(pattern := _pattern(probes(of_template.values(), min_dice))))
    # By Dice >= t: size of the unit >= t / (2 - t) of the template's, and the other way round.
    ratio = min_dice / (2 - min_dice)
    sizes = [len(b) for b in of_template.values()]
    least, most = min(sizes, default=0) * ratio, max(sizes, default=0) / ratio
    units = (
        _units(texts(docs, id_col, text_col).where(stated))
        .where(F.rlike(F.col("unit"), F.lit(pattern)))
        .select("doc_id", "line", _words(F.col("unit")).alias("words"))
        .select("doc_id", "line", _bigrams("words").alias("b"))
        .where(F.size("b").between(least, most))
    )
    unit = units.select("doc_id", "line", F.size("b").alias("n"), F.xxhash64("b").alias("key"), F.explode("b").alias("bigram"))
    fits = (F.col("n") >= F.col("size") * ratio) & (F.col("n") * ratio <= F.col("size"))
    common = unit.join(F.broadcast(known), "bigram").where(fits)
    # ``key`` tells a line from the paragraph that begins there; rows that repeat are counted once.
    counted = common.groupBy("doc_id", "line", "key", "n", "template", "license", "size").agg(
        F.count_distinct("bigram").alias("both")
    )
    dice = 2 * F.col("both") / (F.col("n") + F.col("size"))
    return (
        counted.select("doc_id", "line", "license", F.round(dice, 6).alias("dice"))
        .where(F.col("dice") >= min_dice)
        .groupBy("doc_id", "line")
        .agg(F.min(F.struct((-F.col("dice")).alias("down"), "license", "dice")).alias("best"))
        .select("doc_id", "line", "best.license", "best.dice")
    )
