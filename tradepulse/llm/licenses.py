"""Licence scan: passages compared to licence templates by Dice coefficient over word bigrams."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from itertools import pairwise

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradepulse.llm.shared import map_rows

#: Notices as they stand in works; a caller may bring other templates. Fixed values.
TEMPLATES = {
    "mit-notice": "Released under the MIT License.",
    "apache-2.0-notice": "Licensed under the Apache License, Version 2.0.",
    "gpl-3.0-notice": "This work is licensed under the GNU General Public License, version 3.",
    "lgpl-3.0-notice": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "agpl-3.0-notice": "This work is licensed under the GNU Affero General Public License, version 3.",
    "bsd-3-clause-notice": "Released under the 3-Clause BSD License.",
    "mpl-2.0-notice": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "cc-by-4.0-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-4.0-notice": "Licensed under CC BY-SA 4.0.",
    "cc-by-nc-4.0-notice": "Licensed under CC BY-NC 4.0.",
    "cc0-1.0-notice": "Released under CC0 1.0 Universal.",
    "all-rights-reserved": "All rights reserved.",
    "mit": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
        "is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY "
        "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE "
        "AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
        "OTHER DEALINGS IN THE SOFTWARE."),
}
#: A licence of several paragraphs is found at its own extent; most paragraphs of such a run.
RUN = 12
WORDS = re.compile("[A-Za-z0-9]+")
PARAGRAPH = re.compile(r"\n[ \t\r]*\n")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bigrams(text: str) -> set[tuple[str, str]]:
    return set(pairwise(WORDS.findall(text.translate(LOWER))))


class Scanner:
    """Templates by bigram. The size of a passage rules out templates that no overlap could bring to the least score."""

    def __init__(self, templates: dict[str, str], least: float):
        self.least, self.sizes, self.of = least, {}, defaultdict(list)
        for name, text in sorted(templates.items()):
            found = bigrams(text)
            self.sizes[name] = len(found)
            for b in found:
                self.of[b].append(name)
        self.known = frozenset(self.of)
        # 2 min(a, b) / (a + b) is the best score that sizes a and b allow
        self.shortest = min(self.sizes.values(), default=1) * least / (2 - least)
        self.longest = max(self.sizes.values(), default=0) * (2 - least) / least

    def passage(self, text: str) -> dict[str, float]:
        return self.scored(bigrams(text))

    def scored(self, found: set) -> dict[str, float]:
        n = len(found)
        if not self.shortest <= n <= self.longest:
            return {}
        shared = Counter(name for b in found & self.known for name in self.of[b])
        out = {}
        for name, both in shared.items():
            m = self.sizes[name]
            if 2 * min(n, m) >= self.least * (n + m) and 2 * both >= self.least * (n + m):
                out[name] = 2 * both / (n + m)
        return out

    def text(self, text: str) -> dict[str, tuple[float, int]]:
        """Best score and number of matching passages of each licence found."""
        best: dict[str, tuple[float, int]] = {}
        for passage in passages(text):
            for name, score in self.passage(passage).items():
                top, n = best.get(name, (0.0, 0))
                best[name] = (max(top, score), n + 1)
        return best


def passages(text: str) -> list[str]:
    """Lines, paragraphs of several lines, runs of 2 to RUN paragraphs, and the whole text if it has several."""
    lines = text.split("\n")
    paragraphs = PARAGRAPH.split(text)
    n = len(paragraphs)
    runs = ["\n".join(paragraphs[i:i + k]) for k in range(2, min(RUN, n - 1) + 1) for i in range(n - k + 1)]
    return lines + [p for p in paragraphs if "\n" in p] + runs + ([text] if n > 1 else [])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         templates: dict[str, str] | None = None, least: float = 0.8) -> DataFrame:
    """``(id, license, score, passages)``: licences whose template a passage of the text matches.

    Passages are lines, paragraphs, runs of up to RUN paragraphs and the whole text, in A-Z lower-cased runs of
    ASCII letters and digits. The score is the Dice coefficient of the sets of word bigrams, ``least`` or more;
    ``passages`` counts what matched. Null and empty texts match nothing; rows that share an id
    give rows each.
    """
    scanner = Scanner(TEMPLATES if templates is None else templates, least)

    def run(part: dict) -> dict:
        out: dict[str, list] = {"id": [], "license": [], "score": [], "passages": []}
        for i, text in zip(part["id"], part["text"]):
            for name, (score, n) in sorted(scanner.text(text or "").items()):
                for k, v in zip(out, (i, name, score, n)):
                    out[k].append(v)
        return out

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return map_rows(rows, run, f"id {kind}, license string, score double, passages bigint")


def templates_sql() -> str:
    """The templates as a VALUES list."""
    return ", ".join("('{}', '{}')".format(n, t.replace("'", "''")) for n, t in sorted(TEMPLATES.items()))
