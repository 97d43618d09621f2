"""Lines that the registered queries add to the documents, so that every class of block occurs; SQL adds the same."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# What a document gets at its end, by the last digit of its id.
PLANTS = [
    "\nCourse Contents: Theme 1 Introduction to the period and its sources, Unit 1 Early states and their courts, Unit 2 Trade and the towns, Unit 3 Temples and the land,"
    " Theme 2 Later states, Unit 4 Armies and taxes, Unit 5 Crafts and guilds. Pages\n14\n203",
    "\nPage 3 of 9\n1.2 Sources of the period\nand the sources go on",
    "\nWhich of the following is correct?\n(a) the first\nU.P.S.C. and the V ol. of thls",
    "\nCheck Your Progress 1\nUnit 4\nFigure one without a stop\nFigure two",
    "\nA running title of the file\nIn summary the page says this",
    "\nDoe, Jane. 2001. 'A title'\ndoi: 10.1234/x\nvisit www.abc.in",
    "\nwww.abc.in ÐÐÐÐÐÐÐÐÐÐÐÐÐÐ\nArticle 21A and the Finance Act, 1994 by RBI",
    "\n2019-200\n-\n7\nboxshadow\nLet's recal l the past",
    "\nSame heading 2\nSAME HEADING 2\nsame words here\nsame words here\n * spaced\n",
    "\nﬁne print\nfine print\n\nthe Polity and its Source in the Kingship\nhttp://a.in/x y.html",
]


def planted(documents: DataFrame) -> DataFrame:
    """documents with these lines at the end of each text."""
    lines = F.array(*(F.lit(p) for p in PLANTS))
    return documents.withColumn("text", F.concat(F.coalesce("text", F.lit("")), F.element_at(lines, (F.pmod("doc_id", F.lit(10)) + 1).cast("int"))))


def layout_type(kind: Column) -> Column:
    """The type that a layout model gives: like the text's, but it takes some openings of lines for footers and some
    for captions."""
    line = F.col("text")
    return F.when(line.rlike(r"^(Which of|\(a\) the|1\.2 S)"), "footer").when(line.startswith("Figure "), "caption").otherwise(kind)


def layout_top(top: Column) -> Column:
    """The upper edge: questions stand at the foot of the page."""
    return F.when(F.col("text").startswith("Which of"), 30).otherwise(top)


def part(c: Column | str, n: int) -> Column:
    """A number below n for each value, the same everywhere: the first 32 bits of its MD5 digest, modulo n."""
    return F.conv(F.substring(F.md5(F.col(c) if isinstance(c, str) else c), 1, 8), 16, 10).cast("long") % n
