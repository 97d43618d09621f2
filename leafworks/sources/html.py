"""Blocks of web pages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Tags that make a block, and its type.
TAGS = {"h1": "heading", "p": "paragraph", "li": "list_item", "nav": "header", "footer": "footer"}
#: Tags that end the block before them, besides these.
BREAKS = ["html", "head", "body", "title", "div", "section", "article", "main", "header", "aside", "ul", "ol", "table", "tr", "script", "style", "h2", "h3", "h4", "h5", "h6"]
#: A tag of either kind, with its name; marks that stand for it while the page is cut.
BLOCK_TAG = rf"(?i)<(/?(?:{'|'.join([*TAGS, *BREAKS])}))(?:[\s/][^<>]*)?>"

#: Tags inside a block that stand between words.
SPACES = ["br", "hr", "td", "th", "dt", "dd", "option"]
SPACE_TAG = rf"(?i)</?(?:{'|'.join(SPACES)})(?:[\s/][^<>]*)?>"


def html_blocks(pages: DataFrame) -> DataFrame:
    """(page_id, seq, type, text): the text of each element that makes a block, up to the next tag that makes or ends
    one; tags inside it (bold, links) are left out, their text stays, and those of breaks and cells are blanks. Blocks
    without text are left out."""
    marked = F.regexp_replace("html", BLOCK_TAG, "\x01$1\x02")
    rows = pages.select("page_id", F.posexplode(F.split(marked, "\x01")).alias("seq", "part"))
    tag = F.lower(F.regexp_extract("part", "^([A-Za-z0-9]+)\x02", 1))
    kinds = F.create_map(*(F.lit(x) for kv in TAGS.items() for x in kv))
    inside = F.regexp_replace(F.regexp_replace(F.regexp_replace("part", "^[^\x02]*\x02", ""), SPACE_TAG, " "), r"<[^<>]*>", "")
    text = F.trim(F.regexp_replace(inside, r"[ \t\r\n]+", " "))
    return rows.select("page_id", "seq", kinds[tag].alias("type"), text.alias("text")).where("type IS NOT NULL AND text != ''")
