"""Regular expressions shared by the Spark operators and the SQL oracles.

Python's ``\\s``, ``\\w`` and ``\\b`` are Unicode-aware, Java's are ASCII unless
``(?U)`` and RE2's are ASCII, so every class is spelled out.  All patterns
below use syntax that Java regex and RE2 read the same way (``\\x{..}`` escapes,
``\\p{L}``/``\\p{N}`` classes, no look-around).
"""

# --- fixed values -----------------------------------------------------------
# The patterns below must match exactly what the reference's expressions
# match (URL, e-mail, handle, hashtag, non-letter, token patterns), rewritten
# with explicit classes so Java regex and RE2 agree with Python's Unicode \s/\w.

# Characters Python's str.isspace() accepts (what str.strip() and \s use).
WS_CHARS = (r"\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
            r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
WS = f"[{WS_CHARS}]"
NOT_WS = f"[^{WS_CHARS}]"
# Python's \w for str patterns: letters, numbers, underscore.
WORD_CHARS = r"\p{L}\p{N}_"
WORD = f"[{WORD_CHARS}]"
NOT_WORD = f"[^{WORD_CHARS}]"

# leading/trailing whitespace.
STRIP = f"^{WS}+|{WS}+$"
# URLs (the text is already lower case; (?i) kept for direct use).
URL = f"(?i)https?://{NOT_WS}+|www\\.{NOT_WS}+"
# E-mail addresses; a match always starts at a word character.
EMAIL = f"{WORD}[{WORD_CHARS}.-]*@[{WORD_CHARS}.-]+\\.{WORD}+"
# @handles and #hashtags at the start or after whitespace; the
# whitespace before them is consumed, as in the reference.
HANDLE = f"(^|{WS})@{WORD}+"
HASHTAG = f"(^|{WS})#{WORD}+"
# Everything that is not a lower-case ASCII letter separates words.
NON_LETTERS = "[^a-z]+"
# V1/V2: tokens are maximal runs of word characters.
BOW_TOKEN = "^[a-z]{2,}$"          # the BoW pattern keeps all-[a-z] runs
ALPHA = r"^\p{L}+$"                # N16: str.isalpha() on the lemma
# Apostrophes accepted in contractions.
APOS = "['’]"
# Boundary before a contraction word: start or a non-word, non-apostrophe char.
PRE = f"(^|[^{WORD_CHARS}'’])"
POST = f"($|[^{WORD_CHARS}'’])"
# Words with the apostrophes inside them, and what lies between words;
# together the matches give the whole text.
WORDS_AND_GAPS = f"{WORD}+(?:{APOS}[a-z]+)*|{NOT_WORD}+"

# --- end of fixed values ----------------------------------------------------


def auxiliary(end: str, adverbs, words) -> str:
    """A word with ``'<end>`` before one of ``words``: {1} and {2} stay, the ending goes between them."""
    between = "|".join(adverbs)
    return f"([a-z]){APOS}{end}((?: +(?:{between}))* +(?:{'|'.join(words)})){POST}"


def java_group(template: str) -> str:
    """Render a replacement template with {1}-style groups for Java regex."""
    return template.replace("{1}", "$1").replace("{2}", "$2").replace("{3}", "$3")


def re2_group(template: str) -> str:
    """Render a replacement template with {1}-style groups for RE2."""
    return template.replace("{1}", "\\1").replace("{2}", "\\2").replace("{3}", "\\3")
