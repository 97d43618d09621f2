"""The word lists, patterns and tables that the document operators work by.

They are data that results depend on, stated as they are; code elsewhere decides how they are used.
Patterns keep to what Java's, RE2's and Python's engines understand alike, but where noted.
"""

# Boilerplate patterns by class.
HEADER = [
    r"(?i)^\s*upsc\s+(civil\s+services|prelims|mains|examination)",
    r"(?i)^\s*general\s+studies\s*[-–:]?\s*paper\s+[i|v|x\d]+",
    r"(?i)^\s*egyankosh\s*\|\s*ignou",
    r"(?i)^\s*subject\s*:\s*(history|geography|polity|economy|anthropology)",
    r"(?i)^\s*module\s+\d+\s*[-–:]?\s*",
    r"(?i)^\s*chapter\s+\d+\s*[-–:]?\s*$",
    r"(?i)^\s*vision\s+ias\s*",
    r"(?i)^\s*drishti\s+ias\s*",
    r"(?i)^\s*insights\s+on\s+india\s*",
    r"(?i)^\s*forum\s+ias\s*",
    r"(?i)^\s*byju'?s\s+classes\s*",
    r"(?i)^\s*violence\s+and\s+repression\s*$",
    r"(?i)^\s*modern\s+warfare\s*$",
    r"(?i)^\s*total\s+war\s*$",
    r"(?i)^\s*violence\s+by\s+non[-\s]state\s+actors\s*$",
    r"(?i)^\s*unit\s+\d+\s*$",
    r"(?i)^\s*block[-\s]\d+\s*$",
]
FOOTER = [
    r"(?i)^\s*page\s+\d+\s*(of\s+\d+)?\s*$",
    r"^\s*\d+\s*/\s*\d+\s*$",
    r"^\s*-\s*\d+\s*-\s*$",
    r"^\s*\[\s*\d+\s*\]\s*$",
    r"^\s*\d+\s*$",
    r"(?i)^\s*continued\s+on\s+next\s+page",
    r"(?i)^\s*turn\s+over\s*$",
    r"(?i)^\s*pto\s*$",
]
COPYRIGHT = [
    r"(?i)all\s+rights?\s+reserved",
    r"(?i)copyright\s*(©|\(c\))?\s*\d{4}",
    r"(?i)for\s+(internal|personal)\s+use\s+only",
    r"(?i)do\s+not\s+(copy|duplicate|reproduce|distribute)",
    r"(?i)no\s+part\s+of\s+this\s+(publication|document)\s+may\s+be",
    r"(?i)www\.[a-z0-9\-]+\.[a-z]{2,}",
    r"(?i)email\s*:\s*[^\s]+@[^\s]+",
    r"(?i)call\s*/?s*whatsapp\s*:\s*\+?\d[\d\s\-]{8,}",
    r"(?i)contact\s*:\s*\+?\d[\d\s\-]{8,}",
]
BIBLIOGRAPHY = [
    r"^[A-Z][a-zA-Z\-]+,\s+[A-Z][a-zA-Z\s\.]+\.\s+\d{4}\.",
    r"^[A-Z][a-zA-Z\s\-]+\.\s+\d{4}\.\s+['\"‘’“”]",
    r"(?i)^doi\s*:\s*(10\.\d{4,})",
    r"(?i)https?://doi\.org/",
    r"(?i)https?://dx\.doi\.org/",
    r"(?i)https?://[a-z]+\.jstor\.org/stable/",
    r"(?i)https?://[a-z]+\.luminosoa\.org/",
    r"(?i)\bProceedings\s+of\s+the\s+Indian\s+History\s+Congress\b",
    r"(?i)\bModern\s+Asian\s+Studies\b",
    r"(?i)\bThe\s+Journal\s+of\s+Asian\s+Studies\b",
]
EXERCISE = [
    r"(?i)^\s*check\s+your\s+progress\s*[-–]?\s*\d*\s*$",
    r"(?i)^\s*intext\s+questions?\s*\d*\s*$",
    r"(?i)^\s*self\s+assessment\s+questions?\s*\d*\s*$",
    r"(?i)^\s*activity\s+\d+\s*$",
    r"(?i)^\s*terminal\s+questions?\s*$",
]
TOC = [r"\.{4,}\s*\d+\s*$", r"_{4,}\s*\d+\s*$", r"(?i)^\s*contents\s*$", r"(?i)^\s*table\s+of\s+contents\s*$"]
WATERMARK = [
    r"(?i)^\s*draft\s*$",
    r"(?i)^\s*confidential\s*$",
    r"(?i)^\s*sample\s+only\s*$",
    r"(?i)^\s*for\s+review\s+only\s*$",
    r"(?i)^\s*not\s+for\s+sale\s*$",
]
TOP_MARGIN_WORDS = ["upsc", "paper", "module", "chapter", "notes", "unit", "block"]
TOC_WORDS = ["course contents", "theme", "unit", "introduction", "pages"]

# Text correction, applied in this order.
DOMAIN_TERMS = [
    (r"\bU\.P\.S\.C\.\b", "UPSC"), (r"\bI\.A\.S\.\b", "IAS"), (r"\bI\.P\.S\.\b", "IPS"), (r"\bI\.F\.S\.\b", "IFS"),
    (r"\bC\.S\.A\.T\.\b", "CSAT"), (r"\bN\.C\.E\.R\.T\.\b", "NCERT"), (r"\bM\.L\.A\.\b", "MLA"), (r"\bM\.P\.\b", "MP"),
    (r"\bB\.C\.E\.\b", "BCE"), (r"\bC\.E\.\b", "CE"),
]
CHARACTERS = [
    ("\u201c", '"'), ("\u201d", '"'), ("\u2018", "'"), ("\u2019", "'"), ("\u2014", "-"),
    ("\u2013", "-"), ("\u2026", "..."), ("\u00a0", " "), ("\u200b", ""), ("\ufb01", "fi"),
    ("\ufb02", "fl"), ("\ufb00", "ff"), ("\ufb03", "ffi"), ("\u00cd", "I"), ("\u00ed", "i"),
    ("\u0146", "n"), ("\uf050", "✓"), ("\uf051", "✓"), ("\uf052", "✓"), ("\uf078", "✗"),
    ("\uf0a7", "•"), ("\uf0b7", "•"), ("\uf0d8", "➢"), ("\uf0e0", "✉"), ("\uf020", " "),
]
CONFUSIONS = [
    (r"\bThls\b", "This"), (r"\bthls\b", "this"), (r"\bsublecl\b", "subject"), (r"\bcondillon\b", "condition"),
    (r"\bcondillons\b", "conditions"), (r"\bthal\b", "that"), (r"\bil\b", "it"), (r"\bnol\b", "not"), (r"\{ho\b", "the"),
    (r"\blo\b", "to"), (r"\bwhlch\b", "which"), (r"\bwilh\b", "with"), (r"\bElforn\b", "Ellora"), (r"\bTempte\b", "Temple"),
    (r"\baud\b", "and"), (r"\bAud\b", "And"), (r"\bThiugs\b", "Things"), (r"\bthiugs\b", "things"),
    (r"\bPreachiug\b", "Preaching"), (r"\bpreachiug\b", "preaching"), (r"\bfiņd\b", "find"), (r"\bTne\b", "The"),
    (r"\bI'he\b", "The"), (r"\beaste['']?n\b", "eastern"), (r"\brnle\b", "rule"), (r"\bFhe\b", "The"),
    (r"\bgrealust\b", "greatest"), (r"\bsurious\b", "serious"), (r"\bsurhus\b", "serious"), (r"\bmeanirig\b", "meaning"),
    (r"\bterins\b", "terms"), (r"\bSyslem\b", "System"), (r"\bfoumndations\b", "foundations"),
    (r"\bfoumndatios\b", "foundations"), (r"\bHinduslan\b", "Hindustan"), (r"\bHíndu\b", "Hindu"), (r"\bÍndia\b", "India"),
    (r"\bgrulling\b", "gruelling"), (r"\bGrulling\b", "Gruelling"), (r"\bplebianize\b", "plebeianize"),
    (r"\bPlebianize\b", "Plebeianize"), (r"\bKesselschlact\b", "Kesselschlacht"), (r"\bkesselschlact\b", "kesselschlacht"),
    (r"\bSull[- ]k[iu]tl?\b", "Sulh-kul"), (r"\bentrused\b", "entrusted"), (r"\breligon\b", "religion"),
    (r"\bunifed\b", "unified"), (r"\bcial\b", "social"),
    (r"SOCIAL SCIENCE PART 1 SOCIAL SCIENCE - PART 1", "SOCIAL SCIENCE - PART I"),
    (r"SOCIAL SCIENCE - PART 1 SOCIAL SCIENCE - PART 1", "SOCIAL SCIENCE - PART I"),
    (r"\bmonotheistsant\b", "monotheist saint"), (r"\bMonotheistsant\b", "Monotheist Saint"),
    (r"\bSikhismsant\b", "Sikhism saint"), (r"\bHindusiant\b", "Hindu saint"), (r"\bBhaktisant\b", "Bhakti saint"),
    (r"\bgurubhakti\b", "guru bhakti"), (r"\bGurubhakti\b", "Guru Bhakti"), (r"\bRajputstate\b", "Rajput state"),
    (r"\brajputstate\b", "Rajput state"), (r"\bMughalcourt\b", "Mughal court"), (r"\bmughalcourt\b", "Mughal court"),
    (r"\bMughalempire\b", "Mughal Empire"), (r"\bmughalempire\b", "Mughal Empire"), (r"\bSubahdar\b", "Subahdar"),
]
SPLIT_WORDS = [
    (r"\bV\s+ol\.", "Vol."), (r"\bV\s+olume\b", "Volume"), (r"\bY\s+ork\b", "York"), (r"\bV\s+ernacular", "Vernacular"),
    (r"\bMiddleEastern\b", "Middle Eastern"), (r"(?i)\bmiddleeastern\b", "Middle Eastern"),
    (r"\bCentralAsian\b", "Central Asian"), (r"\bSouthAsian\b", "South Asian"), (r"\bNorthIndia\b", "North India"),
    (r"\bSouthIndia\b", "South India"), (r"\bS\s+hah\b", "Shah"), (r"\bK\s+han\b", "Khan"), (r"\bK\s+hafi\b", "Khafi"),
    (r"\bImreBangha\b", "Imre Bangha"), (r"\bPerso\s+-\s+Islamic\b", "Perso-Islamic"),
    (r"\bSabk\s+-\s+i\s+Hindi\b", "Sabk-i Hindi"), (r"\bNagari\s+Rekhta\b", "Nagari Rekhta"),
    (r"\bChandarBhan\b", "Chandar Bhan"), (r"\bAndhara\s+Pradesh\b", "Andhra Pradesh"),
]
RUNNING_HEADERS = [
    "Persian Histories and Memoirs", "Sources and Literary Traditions", "History of India-VII", "History of India-VI",
    "History of Modern Europe", "History of China", "Political Processes", "Production and Commercial Practices",
    "State, Society and Religion", "Visual Culture", "Society and Culture", "The 18th Century",
    "Mughal Decline and Disintegration", "Sanskrit Kavya Literature, Regional Sources and Travelogues",
    "Indian Ocean Trade Network", "Trading Communities and Commercial Practices", "Religious Ideas and Movements",
    "Courtly Culture", "Women and Gender",
]
FOREIGN_TERMS = ["schwerpunkt", "auftragstaktik", "blitzkrieg", "levee en masse", "volk", "volksgemeinschaft", "jihad", "jehad", "ghazi", "Kesselschlacht", "kesselschlacht"]
HYPHEN_BREAK = r"(\b[a-zA-Z]{2,})-\s*\n\s*([a-zA-Z]{2,}\b)"
URL_SPACE = r"(https?://\S*?)\s+(\S*(?:\.[a-zA-Z]{2,}|/)\S*)"
DIACRITICS = "ṇṣśñṭḍṛḷṃḥĀāĪīŪūṚṜṝḶḸḹṂḤÑṬḌṆŚṢ"

# Block clean-up.
GARBAGE_TOKENS = ["headright", "boxshadowdwn", "boxshadow"]
SINGLE_MARK = r"^[0-9\-–]$"
YEAR_MARK = r"(?i)^2019[-–]200?$"
STYLIZED_HEADINGS = [
    (r"(?i)\bLet['’]s\s+recal\s*l\b", "Let's recall"), (r"(?i)\bLet['’]s\s+imagin\s*e\b", "Let's imagine"),
    (r"(?i)\bLet['’]s\s+(?:discus\s*s|di\s*scus\s*s)\b", "Let's discuss"), (r"(?i)\bLet['’]s\s+d\s*o\b", "Let's do"),
]
FULL_PAGE_BOXES = [(0.0, 0.0, 595.0, 842.0), (0.0, 0.0, 595.2755737304688, 841.8897705078125)]
HEADER_PHRASES = [
    "social science - part i", "social science - part 1", "social science part 1", "social science part i",
    "india's struggle for independence", "the heritage of india",
]
HEADINGS = [
    r"(?i)^\s*chapter\s+\d+", r"(?i)^\s*exercises\s*$", r"(?i)^\s*things\s+to\s+know\b",
    r"(?i)^\s*india['’]?s\s+struggle\s+for\s+independence\b", r"(?i)^\s*revolt\s+of\s+1857\b",
    r"(?i)^\s*rise\s+of\s+indian\s+nationalism\b", r"(?i)^\s*indian\s+national\s+congress\b",
    r"(?i)^\s*boycott\s+and\s+swadeshi\b", r"(?i)^\s*morley[- ]minto\b", r"(?i)^\s*khilafat\b", r"(?i)^\s*non[- ]cooperation\b",
    r"(?i)^\s*civil\s+disobedience\b", r"(?i)^\s*quit\s+india\b", r"(?i)^\s*the\s+medieval\s+period\b",
    r"(?i)^\s*languages?\s+and\s+literature\b", r"(?i)^\s*architecture\b", r"(?i)^\s*cave\s*architecture\b",
    r"(?i)^\s*the\s+heritage\s+of\s+india\b",
]
LIST_ITEM = r"(?i)^\s*(\d+[\.\)]|[a-z][\.\)]|[•\-➢])\s+"
FOOTER_NUMBER = r"^\s*\d{1,3}\s*$"
QUESTION_OPENERS = r"(?i)^(Q[\.\t\s]|PREVIOUS YEAR QUESTION|With reference|Consider the following|Which (of|one|among)|How many|What (is|are|was|were)|\([a-d]\)\s)"
NUMBERED_HEADING = r"^\d+(\.\d+)*\s+[A-Z]"
SAME_TOPIC_WORDS = ["cave architecture", "gandhara"]

LINE_HEADINGS = [
    r"(?i)^\s*chapter\s+\d+", r"(?i)^\s*exercises\s*$", r"(?i)^\s*things\s+to\s+know\b",
    r"(?i)^\s*india['’]?s\s+struggle\s+for\s+independence\b", r"(?i)^\s*revolt\s+of\s+1857\b", r"(?i)^\s*non[- ]cooperation\b",
    r"(?i)^\s*civil\s+disobedience\b", r"(?i)^\s*quit\s+india\b",
]
FONT_LIST_ITEM = r"^(z |\? |\([a-d]\)\s)"
FONT_LIST_ITEM_MORE = r"^(z |\? |\([a-d]\)\s|\d+\.\s|[•\-➢]\s)"
SENTENCE_END = "[.!?:’\"'”]$"
SPLIT_END = r'[.!?:"]$'
LINE_END = "[.!?:\"’]\\s*$"
OCR_RESIDUE = r"\b[A-Z]\s+ol\b|\b[A-Z]\s+ork\b"
OCR_WORD = "monotheistsant"
SUMMARY_PHRASES = [
    "based on the provided text", "here is a summary", "in summary", "to summarize", "summary of the main historical facts",
    "summary of the provided text",
]
SUMMARY_BULLETS = r"(?m)\*\s{2,3}\*\*|^\s*-\s\*\*"

# Tables.
TABLE_BOILERPLATE = [r"(?i)india:\s*6\s*th\s*century\s*bce\s*to\s*200\s*bce", r"(?i)^\s*page\s+nos?\.\s*$", r"(?i)^\s*bhic-101\s*$"]
CITATION_ROW = r"(?i)^\s*\(.*?(?:Kumar|MHI|Block|Unit|p\.\s*\d+|Press|Edition|ISBN|Source|Adapted).*?\)\s*$"
GENERIC_HEADERS = ["column_1", "column_2", "column_3", "column_4", "column_5", "column_6", "column_7", "column_8", "list?", "s/no", "s.no", "sno", ""]
DOT_LEADER = r"\.{4,}"

# Entities, in order of precedence.
ENTITIES = [
    ("CONSTITUTIONAL_ARTICLE", r"(?i)\b(article|art\.)\s+\d+[a-z]?(\(\d+\))?|\b\d+(st|nd|rd|th)\s+constitutional\s+amendment(\s+act)?\b"),
    ("ACT_POLICY", r"(?i)\b([a-z\s]+)\s+act,?\s+\d{4}\b|\b([a-z\s]+)\s+policy,?\s+\d{4}\b|\bcode\s+of\s+[a-z\s]+\d{4}\b"),
    ("GOVT_BODY", r"(?i)\b(niti\s+aayog|election\s+commission|finance\s+commission|upsc|spsc|cag|law\s+commission|national\s+green\s+tribunal|ngt|supreme\s+court|high\s+court|rbi|reserve\b[a-z\s]*bank)\b"),
    ("SCHEME", r"(?i)\b(pm-?[a-z]+|mgnrega|ayushman\s+bharat|poshan\s+abhiyaan|swachh\s+bharat|make\s+in\s+india|digital\s+india|atmanirbhar\s+bharat)\b"),
    ("HISTORICAL_EVENT", r"(?i)\b(battle\s+of\s+[a-z]+|quit\s+india\s+movement|non-?cooperation\s+movement|civil\s+disobedience\s+movement|swadeshi\s+movement|treaty\s+of\s+[a-z]+|revolt\s+of\s+1857|sepoy\s+mutiny)\b"),
    ("DATE_YEAR", r"\b(1[0-9]{3}|20[0-2][0-9])\b|\b\d{1,2}(st|nd|rd|th)?\s+(january|february|march|april|may|june|july|august|september|october|november|december)\s+\d{4}\b"),
]

# Block types that an audit knows, and retrieval queries by keyword, first match first.
BLOCK_TYPES = ["heading", "paragraph", "list_item", "caption", "footnote", "header", "footer", "table", "blank_page", "exercise_heading", "toc_page_number"]
QUERY_RULES = [
    (("all", ["Polity", "Source"]), "What are the primary literary and epigraphic sources for reconstructing Ancient Indian Polity?"),
    (("any", ["Kingship", "~king"]), "How is the theory of the origin of kingship described in ancient Indian political thought?"),
    (("any", ["Taxation", "~tax"]), "What was the structure of the taxation system in Ancient and Early Medieval India?"),
    (("any", ["Epic", "Mahabharata"]), "How is statecraft and political philosophy depicted in the Indian Epics?"),
    (("any", ["Svara or accent", "Sanskrit language"]), "What are the rules regarding Svara and accents in Vaidika Sanskrit?"),
    (("any", ["Dichotomy of Veda", "divided into"]), "How are the Vedas divided into Samhita, Brahmana, Aranyaka and Upanishad?"),
    (("any", ["Vedavy", "heap"]), "Who organized the initial heap of Vedic texts into structured Vedas?"),
    (("any", ["Vedic, Epic and Puranic culture"]), "Overview of Vedic, Epic and Puranic culture of India"),
]

# The questions that are asked where no chunk gives one, of the first and the second chunk.
DEFAULT_QUERIES = ["Where was the Indus Valley Civilization located?", "What is the scientific study of human cultures and biology?"]


def any_of(patterns: list[str]) -> str:
    """One pattern that matches where any of the given ones does."""
    return "|".join(f"(?:{p})" for p in patterns)
