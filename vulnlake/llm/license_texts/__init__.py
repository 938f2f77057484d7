"""Full license texts as templates of operator 10.

The files of this folder are the published texts, named by SPDX identifier. A template is the terms alone: preambles are much the same in
related licenses, and the appendices hold the short notices, which are templates of their own.
"""

from __future__ import annotations

import re
from functools import cache
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Headings that open the terms, and those after which they are over.
OPENING = re.compile(r"^[ \t]*(?:GNU [A-Z ]+\n)?[ \t]*TERMS AND CONDITIONS\b", re.MULTILINE)
CLOSING = re.compile(r"^[ \t]*(?:END OF TERMS AND CONDITIONS\b|Exhibit A - Source Code Form|EXHIBIT A -)", re.MULTILINE)
# The one section in which the Affero terms differ from the GPL-3.0 otherwise than by their name.
SHARED = "GPL-3.0"
SECTION = re.compile(r"^[ \t]*13\. Use with the GNU Affero.*?(?=^[ \t]*14\. )", re.MULTILINE | re.DOTALL)
AFFERO = """13. Remote Network Interaction; Use with the GNU General Public License.

Notwithstanding any other provision of this License, if you modify the Program, your modified version must prominently offer all users interacting with it remotely through a computer network (if your version supports such interaction) an opportunity to receive the Corresponding Source of your version by providing access to the Corresponding Source from a network server at no charge, through some standard or customary means of facilitating copying of software. This Corresponding Source shall include the Corresponding Source for any work covered by version 3 of the GNU General Public License that is incorporated pursuant to the following paragraph.

Notwithstanding any other provision of this License, you have permission to link or combine any covered work with a work licensed under version 3 of the GNU General Public License into a single combined work, and to convey the resulting work. The terms of this License will continue to apply to the part which is the covered work, but the work with which it is combined will remain governed by version 3 of the GNU General Public License.

"""


def terms(text: str) -> str:
    """The text from the heading of its terms to their end; all of it where it has no such headings."""
    closed = CLOSING.search(text)
    text = text[: closed.start()] if closed else text
    opened = OPENING.search(text)
    return text[opened.end() :] if opened else text


def affero(gpl: str) -> str:
    """The terms of AGPL-3.0, from those of GPL-3.0."""
    before, after = SECTION.split(gpl)
    old, new = "GNU General Public License", "GNU Affero General Public License"
    return re.sub(r"GNU\s+General\s+Public\s+License", new, before) + AFFERO + after.replace(old, new)


@cache
def templates() -> tuple[tuple[str, str], ...]:
    """(license, terms) of every text, by name."""
    own = {path.stem: terms(path.read_text(encoding="utf-8")) for path in Path(__file__).parent.glob("*.txt")}
    own["AGPL-3.0"] = affero(own[SHARED])
    return tuple(sorted(own.items()))


def read_templates(spark: SparkSession, folder: str) -> DataFrame:
    """license, text: one row per text file `<license>.txt` of a folder, whole."""
    files = spark.read.text(folder, wholetext=True, pathGlobFilter="*.txt").withColumn("path", F.col("_metadata.file_name"))
    name = F.regexp_replace(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))), r"\.txt$", "")
    return files.select(name.alias("license"), F.col("value").alias("text"))
