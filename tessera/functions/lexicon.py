"""Word lists and small dictionaries used by the cleaner.

Values under "fixed values" must stay as they are for results to agree with
the reference behaviour; the larger lists are loaded from files and every one
of them can be replaced by a parameter.
"""

from __future__ import annotations

from functools import lru_cache
from importlib import resources

from .irregular import irregular_nouns, irregular_verbs, past_participles

# --- fixed values -----------------------------------------------------------
# Whole-cell junk literals nulled out after stripping (case-sensitive match).
JUNK_LITERALS = (
    "", " ", "na", "n/a", "none", "null", "nan", "no comment", "-", "—",
    "*", ".", "— —", "n.a.",
)

# Cell spellings the CSV reader of the reference treats as missing (exact,
# unstripped match), applied only when the corpus is read from CSV.
CSV_NA_SPELLINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# --- end of fixed values ----------------------------------------------------

# Contractions and slang expanded before cleaning: whole words first, then
# the regular suffixes.  Keys are lowercase; both ' and U+2019 are accepted.
CONTRACTION_WORDS = {
    "can't": "cannot",
    "won't": "will not",
    "shan't": "shall not",
    "ain't": "are not",
    "let's": "let us",
    "y'all": "you all",
    "ma'am": "madam",
    "o'clock": "of the clock",
    "it's": "it is",
    "he's": "he is",
    "she's": "she is",
    "that's": "that is",
    "there's": "there is",
    "here's": "here is",
    "what's": "what is",
    "where's": "where is",
    "who's": "who is",
    "how's": "how is",
    "gonna": "going to",
    "wanna": "want to",
    "gotta": "got to",
    "gimme": "give me",
    "lemme": "let me",
    "kinda": "kind of",
    "sorta": "sort of",
    "dunno": "do not know",
    "u": "you",
    "idk": "i do not know",
}
# Words with a leading apostrophe.
CONTRACTION_HEADS = {"cause": "because", "tis": "it is", "twas": "it was"}
# Behind 's these mean "has", behind 'd "had"; adverbs may stand between.  A
# noun's 's before any other word is a possessive and stays.
CONTRACTION_ADVERBS = ("not", "never", "always", "already", "also", "just", "only", "ever", "since", "recently", "finally")
PERFECT_WORDS = ("been", "become", "begun", "come", "fallen", "forgotten", "gone", "got", "gotten", "grown", "had", "happened",
                 "known", "risen", "seen", "taken")
PAST_WORDS = ("been", "better", "become", "put", "set", "used", *past_participles())
CONTRACTION_SUFFIXES = (
    ("n't", " not"),
    ("'re", " are"),
    ("'ll", " will"),
    ("'ve", " have"),
    ("'m", " am"),
    ("'d", " would"),
)

# Irregular forms for the dictionary lemmatizer (form -> lemma).  Forms that
# must not be touched by the suffix rules map to themselves.
LEMMA_WORDS = {
    "am": "be", "is": "be", "are": "be", "was": "be", "were": "be",
    "been": "be", "being": "be",
    "has": "have", "had": "have", "having": "have",
    "does": "do", "did": "do", "done": "do", "doing": "do",
    "goes": "go", "went": "go", "gone": "go",
    "said": "say", "says": "say", "told": "tell", "made": "make",
    "got": "get", "gotten": "get", "paid": "pay", "took": "take",
    "taken": "take", "gave": "give", "given": "give", "came": "come",
    "knew": "know", "known": "know", "saw": "see", "seen": "see",
    "thought": "think", "bought": "buy", "brought": "bring", "sent": "send",
    "spent": "spend", "left": "leave", "felt": "feel", "found": "find",
    "kept": "keep", "held": "hold", "lost": "lose", "meant": "mean",
    "met": "meet", "ran": "run", "sold": "sell", "spoke": "speak",
    "spoken": "speak", "stood": "stand", "understood": "understand",
    "wrote": "write", "written": "write", "began": "begin", "begun": "begin",
    "became": "become", "chose": "choose", "chosen": "choose", "fell": "fall",
    "fallen": "fall", "forgot": "forget", "forgotten": "forget",
    "heard": "hear", "led": "lead", "built": "build", "caught": "catch",
    "taught": "teach", "won": "win", "wore": "wear", "drove": "drive",
    "driven": "drive", "ate": "eat", "eaten": "eat", "broke": "break",
    "broken": "break", "stole": "steal", "stolen": "steal", "hid": "hide",
    "hidden": "hide", "sought": "seek", "fought": "fight", "threw": "throw",
    "thrown": "throw", "grew": "grow", "grown": "grow", "drew": "draw",
    "drawn": "draw", "flew": "fly", "flown": "fly", "rode": "ride",
    "ridden": "ride", "rose": "rise", "risen": "rise", "shook": "shake",
    "shaken": "shake", "woke": "wake", "woken": "wake",
    "children": "child", "men": "man", "women": "woman", "feet": "foot",
    "teeth": "tooth", "mice": "mouse", "geese": "goose", "people": "people",
    "this": "this", "his": "his", "yes": "yes", "always": "always",
    "perhaps": "perhaps", "afterwards": "afterwards", "whereas": "whereas",
    "news": "news", "series": "series", "species": "species",
    "analysis": "analysis", "basis": "basis", "crisis": "crisis",
    "thesis": "thesis", "status": "status", "bus": "bus", "gas": "gas",
    "plus": "plus", "thus": "thus", "bonus": "bonus", "campus": "campus",
    "virus": "virus", "focus": "focus", "census": "census",
    "buses": "bus", "gases": "gas", "viruses": "virus", "bonuses": "bonus",
    "campuses": "campus", "focuses": "focus", "censuses": "census",
    "statuses": "status", "lenses": "lens", "analyses": "analysis",
    "crises": "crisis", "theses": "thesis", "shoes": "shoe", "toes": "toe",
    "movies": "movie", "cookies": "cookie", "knives": "knife", "wives": "wife",
    "lives": "life", "leaves": "leave", "halves": "half", "shelves": "shelf",
    "agreed": "agree", "disagreed": "disagree", "guaranteed": "guarantee",
    "freed": "free", "added": "add", "adding": "add", "erred": "err",
    "owed": "owe", "owing": "owe", "died": "die", "dying": "die",
    "lied": "lie", "lying": "lie", "tied": "tie", "tying": "tie",
    "focused": "focus", "focusing": "focus", "biased": "bias",
    "invited": "invite", "inviting": "invite", "united": "unite",
    "excited": "excite", "exciting": "excite",
    "hundred": "hundred", "sacred": "sacred", "naked": "naked",
    "wicked": "wicked", "hatred": "hatred", "embed": "embed",
    "during": "during", "morning": "morning", "evening": "evening",
    "nothing": "nothing", "something": "something", "anything": "anything",
    "everything": "everything", "ceiling": "ceiling", "sibling": "sibling",
    "lightning": "lightning", "pudding": "pudding", "darling": "darling",
}

# The whole dictionary: forms made by rule, and the words above before them.
LEMMA_EXCEPTIONS = irregular_verbs() | irregular_nouns() | LEMMA_WORDS

# Suffix rules for tokens outside the dictionary (anchored regexes that Java
# and RE2 read alike).  Endings in -s and -ied: the first rule that matches.
LEMMA_RULES = (
    (r"^([a-z]{2,})ies$", "{1}y"),
    (r"^([a-z]{2,})ied$", "{1}y"),
    (r"^([a-z]+(ss|sh|ch|x|zz))es$", "{1}"),
    (r"^([a-z]{2,}o)es$", "{1}"),
    (r"^([a-z]{2,}[^siu])s$", "{1}"),
)
# -ed (not -eed) and -ing leave a stem, which must hold a vowel; a doubled last
# consonant is made single, and a silent e comes back behind these stem ends.
VERB_FORM = r"^[a-z]*[aeiouy][a-z]*([^e]ed|ing)$"
VERB_STEM = r"^[a-z]*[aeiouy][a-z]*$"
DOUBLED_STEM = r"(bb|dd|gg|mm|nn|pp|rr|tt)$|[aeiou][^aeiou]+(ell|oll)$"
SILENT_E_STEM = "|".join((
    r"[cuv]$", r"[^z]z$", r"[^s]s$",                    # reduce, remove, use
    r"[rd]g$", r"[ae]ng$", r"[aeiu]g$",                 # charge, change, manage
    r"[bcdfgkpstz]l$", r"dul$",                         # settle, schedule
    r"[^aeo]at$", r"creat$", r"[^aeo]ut$",              # state, create, dispute
    r"(pl|el|mp)et$", r"(qu|v|m)ot$",                   # complete, quote
    r"[^aeiou](ar|ir|ur)$", r"quir$", r"(st|gn|pl|sc)or$",  # share, require, ignore
    r"[^aeiou][aiou]d$", r"guid$",                      # provide, guide
    r"[^aeou]in$", r"[^aeiou]um$", r"com$",             # define, assume, become
    r"[^o]ok$", r"[^aeiou]ib$", r"cap$",                # revoke, describe, escape
    r"^[^aeiouy]*[aeiouy][bdkmnplrt]$",                 # name, like, type
))


@lru_cache(maxsize=1)
def default_stopwords() -> tuple[str, ...]:
    """The default English stop list, sorted, read from the packaged file."""
    text = resources.files("tessera.functions").joinpath(
        "data/stopwords_en.txt").read_text(encoding="utf-8")
    words: set[str] = set()
    for line in text.splitlines():
        if line.startswith("#"):
            continue
        words.update(w.lower() for w in line.split())
    return tuple(sorted(words))


def stopword_list(extra: tuple[str, ...] | list[str] | None = None,
                  base: tuple[str, ...] | list[str] | None = None) -> list[str]:
    words = set(default_stopwords() if base is None else (w.lower() for w in base))
    if extra:
        words |= {w.lower() for w in extra}
    return sorted(words)
