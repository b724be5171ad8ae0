"""Irregular English forms, made by rule.

Verbs are listed by the way they change (the end of the base, of the past and
of the participle) and carry the prefixes they take; forms are composed here.
A form that is also an everyday word of its own keeps that reading
(``OWN_WORDS``); ``functions.tagging`` resolves such forms by context.
"""

from __future__ import annotations

# (end of base, end of past, end of participle): stems
VERB_CLASSES = {
    ("ing", "ang", "ung"): "r s spr",
    ("ing", "ung", "ung"): "cl fl sl st sw wr str",
    ("ink", "ank", "unk"): "dr s shr st",
    ("im", "am", "um"): "sw",
    ("in", "an", "un"): "beg",
    ("in", "un", "un"): "sp",
    ("ang", "ung", "ung"): "h",
    ("ig", "ug", "ug"): "d",
    ("ick", "uck", "uck"): "st",
    ("ike", "uck", "uck"): "str",
    ("eep", "ept", "ept"): "k sl sw w cr",
    ("eel", "elt", "elt"): "kn f",
    ("eal", "ealt", "ealt"): "d",
    ("ean", "eant", "eant"): "m",
    ("ose", "ost", "ost"): "l",
    ("end", "ent", "ent"): "b l s sp",
    ("uild", "uilt", "uilt"): "b",
    ("eed", "ed", "ed"): "bl br f sp",
    ("ead", "ed", "ed"): "l",
    ("eet", "et", "et"): "m",
    ("ide", "id", "idden"): "h",
    ("ite", "it", "itten"): "b",
    ("ind", "ound", "ound"): "b f gr w",
    ("ow", "ew", "own"): "bl gr kn thr",
    ("aw", "ew", "awn"): "dr",
    ("y", "ew", "own"): "fl",
    ("ear", "ore", "orn"): "b sw t w",
    ("eak", "oke", "oken"): "br sp",
    ("eal", "ole", "olen"): "st",
    ("eave", "ove", "oven"): "w",
    ("eeze", "oze", "ozen"): "fr",
    ("oose", "ose", "osen"): "ch",
    ("ive", "ove", "iven"): "dr str",
    ("ide", "ode", "idden"): "r str",
    ("ise", "ose", "isen"): "r",
    ("ite", "ote", "itten"): "wr sm",
    ("ake", "ook", "aken"): "t sh",
    ("ake", "oke", "oken"): "w",
    ("get", "got", "gotten"): " for",
    ("ive", "ave", "iven"): "g forg",
    ("all", "ell", "allen"): "f",
    ("eat", "ate", "eaten"): " ",
    ("eek", "ought", "ought"): "s",
    ("uy", "ought", "ought"): "b",
    ("ink", "ought", "ought"): "th",
    ("ing", "ought", "ought"): "br",
    ("ight", "ought", "ought"): "f",
    ("atch", "aught", "aught"): "c",
    ("each", "aught", "aught"): "t",
    ("ell", "old", "old"): "s t",
    ("old", "eld", "eld"): "h",
    ("ay", "aid", "aid"): "s p l",
    ("ake", "ade", "ade"): "m",
    ("tand", "tood", "tood"): "s",
    ("ear", "eard", "eard"): "h",
    ("leave", "left", "left"): " ",
    ("lee", "led", "led"): "f",
    ("hoot", "hot", "hot"): "s",
    ("it", "at", "at"): "s sp",
    ("win", "won", "won"): " ",
    ("light", "lit", "lit"): " ",
    ("slide", "slid", "slid"): " ",
    ("shine", "shone", "shone"): " ",
    ("see", "saw", "seen"): " ",
    ("go", "went", "gone"): " ",
    ("do", "did", "done"): " ",
    ("come", "came", "come"): " ",
    ("run", "ran", "run"): " ",
    ("have", "had", "had"): " ",
}
#: Prefixes and the verbs that take them.
VERB_PREFIXES = {
    "under": "go take stand pay write lie sell feed", "over": "come take see hear pay draw do eat feed ride run sleep spend throw",
    "re": "build buy do draw grow make pay run sell send take tell think write bind hang", "mis": "lead give hear lay take understand speak",
    "un": "do bind wind", "out": "do grow run sell shine spend bid", "with": "draw hold stand", "for": "give bear", "fore": "see tell go",
    "be": "come fall hold", "up": "hold", "inter": "weave",
}
#: Forms whose everyday reading is a word of its own (noun, adjective or another verb).
OWN_WORDS = ("ground", "wound", "bound", "bore", "rung", "spat", "resent", "rebound")

# (end of plural, end of singular): stems; only plurals that the suffix rules would miss
NOUN_CLASSES = {
    ("ves", "f"): "hal cal shel lea thie loa scar wol el sel hoo whar",
    ("ves", "fe"): "kni wi li",
    ("ena", "enon"): "phenom",
    ("eria", "erion"): "crit bact",
    ("a", "um"): "medi dat bacteri curricul memorand referend addend strat errat ov",
    ("i", "us"): "alumn cact foc fung nucle radi stimul syllab",
    ("ses", "sis"): "analy ba cri diagno empha hypothe oa paraly parenthe synop synthe the",
    ("ices", "ex"): "ind vert vort cod",
    ("ices", "ix"): "append matr",
    ("ae", "a"): "alg formul larv vertebr",
    ("eet", "oot"): "f", ("eeth", "ooth"): "t", ("eese", "oose"): "g", ("ice", "ouse"): "m l",
    ("men", "man"): " wo chair sales police fire business crafts spokes",
    ("people", "person"): "sales spokes business", ("children", "child"): " grand school step", ("oxen", "ox"): " ",
}
#: Left alone: the plural stands for itself, or the singular is not the usual reading.
_KEPT_NOUNS = {"data": "datum", "media": "medium", "bases": "basis", "indices": "index"}


def irregular_verbs() -> dict[str, str]:
    """Past forms and participles to their base, prefixed verbs included."""
    forms: dict[str, set[str]] = {}
    for (base, past, part), stems in VERB_CLASSES.items():
        for stem in stems.split(" "):
            forms.setdefault(stem + base, set()).update({stem + past, stem + part})
    for prefix, verbs in VERB_PREFIXES.items():
        for verb in verbs.split():
            forms.update({prefix + verb: {prefix + f for f in forms[verb]}} if verb in forms else {})
    out = {form: verb for verb in sorted(forms) for form in sorted(forms[verb]) if form != verb}
    for word in OWN_WORDS:
        out.pop(word, None)
    return out


def irregular_nouns() -> dict[str, str]:
    """Irregular plurals to their singular."""
    out = {stem + plural: stem + single for (plural, single), stems in NOUN_CLASSES.items() for stem in stems.split(" ")}
    for plural in _KEPT_NOUNS:
        out.pop(plural, None)
    return out


def past_participles() -> list[str]:
    """Participles that are not base forms as well, for contractions."""
    out, bases = set(), set()
    for (base, _, part), stems in VERB_CLASSES.items():
        for stem in stems.split(" "):
            bases.add(stem + base)
            out.add(stem + part)
    return sorted(out - bases)
