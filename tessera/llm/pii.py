"""Surrogates for personal data and secrets, in Spark expressions only.

Detected entities get a replacement drawn from a keyed hash of their type and
canonical form, so that one entity has one surrogate in every document and in
every way it is written (phone and card numbers with other separators, mail
addresses in other case, a surname with or without the given name, a name with
or without a title or a possessive ending).  Surrogates
keep the type (card numbers pass their check digit, bank accounts theirs,
private addresses stay private), the format (separators, case, character
classes), and for names the gender and the script.  A name is a title or a known
given name and up to ``NAME_WORDS`` words, with initials and particles (von, de la)
between them; particles stay, initials turn into others by a keyed order.  Once a
document holds a name, every other capitalised word of it that is a word of that
name (Smith, SMITH, Smith's) is followed and gets the same surrogate; as a surname
if it is both a given name and a surname there.

Distinctness is checked over the whole corpus: of entities that drew the same
surrogate, or one that some document really holds, all but the first draw again
until none is left.  Names get longer with every draw, mail addresses, secrets and
numbers abroad after ``PLAIN_DRAWS``.  If a format is too full for that (most of a
private address block in use), its entities exchange their forms among each other
in a keyed order: still one to one and never their own, but forms that the corpus holds.
Entities are summed by type and form before that, so one
that a third of the documents share is one row.

Defined results: null text stays null and empty text empty; texts are read
whole; repeated rows are replaced alike; rows are told apart by a key of their
own, so null or repeated ids do no harm; other columns ride along.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lookup_join, stage

KEY = "tessera"  # set one of your own: who has the key can test guesses

#: Draws in the format of an entity before it is widened, and entities that exchange their forms in one task.
PLAIN_DRAWS = 6
#: Buckets that the names of a document are looked up in.
NAME_BUCKETS = 64
ROTATION_LOT = 10_000

MALE, FEMALE = "m", "f"
HONORIFICS = {
    "Mr": MALE, "Herr": MALE, "Monsieur": MALE, "Señor": MALE, "Sr": MALE, "Господин": MALE, "господин": MALE,
    "Κύριος": MALE, "Mrs": FEMALE, "Ms": FEMALE, "Miss": FEMALE, "Frau": FEMALE, "Mme": FEMALE, "Mlle": FEMALE,
    "Madame": FEMALE, "Señora": FEMALE, "Sra": FEMALE, "Srta": FEMALE, "Госпожа": FEMALE, "госпожа": FEMALE,
    "Κυρία": FEMALE, "Dr": "", "Prof": "",
}
GIVEN_NAMES = {
    MALE: ("James John Robert Michael William David Richard Thomas Charles Daniel Matthew Andrew Peter Hans Klaus "
           "Jürgen Wolfgang Stefan Pierre Jacques Philippe François Carlos Miguel Alejandro Fernando "
           "Иван Сергей Дмитрий Александр Γιώργος Νίκος").split(),
    FEMALE: ("Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Emily Anna Ursula Monika "
             "Sabine Petra Marie Nathalie Isabelle Sylvie María Carmen Lucía Isabel "
             "Мария Елена Ольга Наталья Μαρία Ελένη").split(),
}
# syllables of surrogate names, in letters that the other scripts have as well
STARTS = "ba be bo da de do fa fe fi ga ka ke ki la le li lo ma me mi na ne no pa pe ra re ro sa se ta te to va ve za".split()
MIDDLES = "la le li lo ma mi mo na ne ni no ra re ri ro sa se ta te ti va ve vi da di do ka ki po za".split()
ENDS = {MALE: "ran rek lin tor mas nis vin don kel mon dar fred".split(),
        FEMALE: "lina nisa rina mira tela dora sina vela rosa lena mara fina".split(),
        "": "ren lis nor mis tel ris".split(),
        "surname": "man ner sen ton vik mar len dor stin ger nov rist".split()}
SCRIPTS = {"cyrillic": ("abvgdeziklmnoprstufh", "абвгдезиклмнопрстуфх"),
           "greek": ("abgdeziklmnoprstufhv", "αβγδεζικλμνοπρστυφχβ")}

#: Words of a name after its title, or after a known given name one less.
NAME_WORDS = 4
PARTICLES = ("von van vom de der den del della di da do dos das du des la las le los el al af av bin ibn ben ten ter "
             "te tot und y e zu zum zur").split()
_NAME = r"\p{Lu}[\p{L}'’-]+"
ENDING = r"(?:['’][sS])?['’-]*$"
_INITIAL = r"\p{Lu}\.?"
_MORE = rf"(?: {_INITIAL}(?= )){{0,3}}(?: (?:{'|'.join(PARTICLES)})(?= )){{0,3}} {_NAME}"
#: Capital letters in whose ranges initials are exchanged; others stay.
_CAPITALS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞĆČĐŁŚŠŹŻŽ", "АБВГДЕЖЗИКЛМНОПРСТУФХЦЧШЩЭЮЯЁ",
             "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ")
_INITIALS = "".join(sorted({w[0] for w in [*HONORIFICS, *GIVEN_NAMES[MALE], *GIVEN_NAMES[FEMALE]]}))
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
LABEL = r"(?i:password|passwd|secret|token|api_?key)\b[\x20\t]{0,2}[=:][\x20\t]{0,2}[\"']?"
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "secret": r"(?<![\p{L}\p{N}_])" + LABEL + r"[A-Za-z0-9+/_-]{8,}",
    "aws": r"(?<![\p{L}\p{N}])AKIA[0-9A-Z]{16}(?![\p{L}\p{N}])",
    "phone": (r"(?<![\p{L}\p{N}+])(?:(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[.-])\d{3}[.-]\d{4}"
              r"|\+\d{8,15}|\+[2-9]\d{0,2}(?:[ .-]\(?\d{2,8}\)?){1,5})(?!\d)"),
    "ssn": r"(?<![\p{L}\p{N}-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}-])",
    "ip": rf"(?<![\p{{L}}\p{{N}}.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\p{{L}}\p{{N}}]|\.\d)",
    "iban": r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])",
    "card": (r"(?<![\p{L}\p{N}])(?:\d{13,19}|\d{4}-\d{4}-\d{4}-\d{4}|\d{4} \d{4} \d{4} \d{4}"
             r"|\d{4}[ -]\d{6}[ -]\d{5})(?![\p{L}\p{N}])"),
    "name": (rf"(?=[{_INITIALS}])(?<![\p{{L}}\p{{N}}])(?:(?:{'|'.join(HONORIFICS)})\.?(?:{_MORE}){{1,{NAME_WORDS}}}"
             rf"|(?:{'|'.join(GIVEN_NAMES[MALE] + GIVEN_NAMES[FEMALE])})(?:{_MORE}){{1,{NAME_WORDS - 1}}})"),
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: Words as names are made of, and what lies between them; together the whole text.
WORD_OR_GAP = r"\p{L}[\p{L}'’-]*|[^\p{L}]+"
#: Every type but names needs one of these; most texts hold none.
SIGNS = "[0-9@=:]|AKIA"


def _holds_entity(text: Column) -> Column:
    """Whether a text holds a match of ``ANY``; null text does not."""
    others = "|".join(f"(?:{p})" for k, p in PATTERNS.items() if k != "name")
    return F.coalesce((text.rlike(SIGNS) & text.rlike(others)) | text.rlike(PATTERNS["name"]), F.lit(False))


def _digits(raw: Column) -> Column:
    return F.regexp_replace(raw, "[^0-9]", "")


def _chars(text: Column) -> Column:
    return F.filter(F.split(text, ""), lambda c: c != "")


def _luhn_sum(digits: Column) -> Column:
    """Check sum of a digit string; a multiple of ten if it is valid."""
    return F.aggregate(F.transform(F.reverse(_chars(digits)), lambda d, k: F.when(
        k % 2 == 1, (2 * d.cast("int")) % 10 + F.floor(d.cast("int") / 5).cast("int")).otherwise(d.cast("int"))),
        F.lit(0), lambda a, x: a + x)


def _iban_rest(text: Column) -> Column:
    """Account number modulo 97, first four characters last; letters count 10 to 35."""
    turned = F.concat(F.substring(text, 5, 40), F.substring(text, 1, 4))
    return F.aggregate(_chars(turned), F.lit(0), lambda a, c: F.when(
        c.rlike("[0-9]"), (a * 10 + c.cast("int")) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97))


def _kind(raw: Column) -> Column:
    """Type of a mention: the first whose whole pattern it matches."""
    out = F.lit(None).cast("string")
    for kind, pattern in reversed(PATTERNS.items()):
        out = F.when(raw.rlike(f"^(?:{pattern})$"), F.lit(kind)).otherwise(out)
    return out


def _script(word: Column) -> Column:
    return (F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek")
            .otherwise("latin"))


def _name_parts(raw: Column) -> Column:
    """Words of a name: each with its type (null: kept as it is); a possessive ending or closing quote is no part of it."""
    words = F.split(raw, " ")
    genders = F.create_map(*[F.lit(x) for k, g in HONORIFICS.items() for x in (k, g)])
    given = F.create_map(*[F.lit(x) for g, names in GIVEN_NAMES.items() for n in names for x in (n, g)])
    title = F.element_at(genders, F.regexp_replace(F.get(words, F.lit(0)), r"\.$", ""))
    titled = title.isNotNull()

    def part(written: Column, k: Column) -> Column:
        tail = F.regexp_extract(written, ENDING, 0)
        word = F.substr(written, F.lit(1), F.length(written) - F.length(tail))
        first = F.when(titled, k == 1).otherwise(k == 0)
        more = F.size(words) > F.when(titled, 2).otherwise(1)
        own = F.element_at(given, word)
        gender = F.when(own.isNotNull(), own).otherwise(F.coalesce(title, F.lit("")))
        is_given = (first & (own.isNotNull() | more)) | (own.isNotNull() & (k < F.size(words) - 1))
        as_is = (titled & (k == 0)) | word.isin(PARTICLES)
        kind = F.when(as_is, F.lit(None).cast("string")).when(word.rlike(f"^{_INITIAL}$"), "initial").otherwise(F.concat_ws(
            ":", F.when(is_given, F.concat(F.lit("given:"), gender)).otherwise(F.lit("surname:surname")), _script(word)))
        return F.struct(kind.alias("kind"), F.concat(F.when(k > 0, " ").otherwise(""), F.lit("")).alias("lead"),
                        word.alias("raw"), F.lower(F.replace(word, F.lit("’"), F.lit("'"))).alias("form"), tail.alias("tail"))

    return F.transform(words, part)


def _parts(raw: Column) -> Column:
    """Parts of a mention: type, the raw part, its canonical form, and what stands before and after it unchanged."""
    kind = _kind(raw)
    digits = _digits(raw)
    lead = F.when(kind == "secret", F.regexp_extract(raw, "^" + LABEL, 0)).otherwise("")
    value = F.when(kind == "secret", F.regexp_replace(raw, "^" + LABEL, "")).otherwise(raw)
    form = (F.when(kind == "email", F.lower(raw))
            .when(kind == "phone", F.when(digits.rlike(r"^1\d{10}$"), F.substring(digits, 2, 10)).otherwise(digits))
            .when(kind.isin("card", "ssn"), digits)
            .when(kind == "iban", F.replace(raw, F.lit(" "), F.lit("")))
            .otherwise(value))
    real = (F.when(kind == "card", _luhn_sum(digits) % 10 == 0)
            .when(kind == "iban", _iban_rest(form) == 1).otherwise(True))
    one = F.array(F.struct(F.when(real, kind).alias("kind"), lead.alias("lead"), value.alias("raw"), form.alias("form"),
                           F.lit("").alias("tail")))
    return F.when(kind == "name", _name_parts(raw)).otherwise(one)


def _draw(seed: Column, at: Column | int, n: int) -> Column:
    """A number below ``n`` from place ``at`` of a stream of hex digits."""
    at = F.lit(at) if isinstance(at, int) else at
    block = F.sha2(F.concat(seed, F.floor(at / 8).cast("string")), 256)
    return (F.conv(F.substring(block, (at % 8 * 8 + 1).cast("int"), 8), 16, 10).cast("long") % n).cast("int")


def _pick(values: list[str], seed: Column, at: int) -> Column:
    return F.get(F.array(*map(F.lit, values)), _draw(seed, at, len(values)))


def _like(text: Column, seed: Column) -> Column:
    """Other characters of the same classes; a hexadecimal text stays one."""
    hexadecimal = text.rlike("^(?=.*[0-9])[0-9a-f]+$")

    def other(c: Column, k: Column) -> Column:
        letter = F.when(hexadecimal, _draw(seed, k, 6)).otherwise(_draw(seed, k, 26))
        return (F.when(c.rlike("[0-9]"), _draw(seed, k, 10).cast("string"))
                .when(c.rlike("[a-z]"), F.chr(letter + 97)).when(c.rlike("[A-Z]"), F.chr(letter + 65))
                .when(c.rlike(r"\p{Ll}"), F.chr(_draw(seed, k, 26) + 97))
                .when(c.rlike(r"\p{Lu}"), F.chr(_draw(seed, k, 26) + 65)).otherwise(c))
    return F.array_join(F.transform(_chars(text), other), "")


def _fixed_lead(digits: Column, lead: Column, seed: Column) -> Column:
    """Digits that begin with ``lead`` and go on at random to the length of ``digits``."""
    return F.concat(lead, _like(F.substr(digits, F.length(lead) + 1), seed))


def _domain(form: Column) -> Column:
    return F.substr(form, F.instr(form, "@") + 1)


def with_seeds(entities: DataFrame, key: str = KEY) -> DataFrame:
    """``entities`` with the hashes that ``surrogate`` draws from.

    They are columns: an expression that holds them whole at every draw makes plans of a megabyte on the driver.
    """
    def seeded(*parts) -> Column:
        return F.sha2(F.concat(F.lit(key), F.sha2(F.concat_ws("\x1f", F.lit(key), *parts), 256)), 256)

    return (entities.withColumn("seed", seeded(F.col("kind"), F.col("form"), F.col("attempt").cast("string")))
            .withColumn("domain_seed", F.when(F.col("kind") == "email", seeded(F.lit("domain"), _domain(F.col("form"))))))


def surrogate(kind: Column, form: Column, attempt: Column, seed: Column, domain_seed: Column) -> Column:
    """Canonical form of the surrogate of an entity, with the hashes of ``with_seeds``."""
    at = F.instr(form, "@")
    domain = _domain(form)
    top = F.regexp_extract(domain, r"\.[^.]*$", 0)
    site = F.substr(domain, F.lit(1), F.length(domain) - F.length(top))
    more = lambda n, low: F.when(attempt >= PLAIN_DRAWS, F.array_join(F.transform(
        F.sequence(F.lit(PLAIN_DRAWS), attempt), lambda k: F.chr(_draw(seed, k + 96, n) + low)), "")).otherwise("")
    email = F.concat(_like(F.substr(form, F.lit(1), at - 1), seed), more(26, 97), F.lit("@"),
                     _like(site, domain_seed), top)
    upto9 = lambda k: (_draw(seed, 40 + k, 8) + 2).cast("string")
    phone = (F.when(F.length(form) == 10, F.concat(
        upto9(0), _like(F.substring(form, 2, 2), seed), upto9(1),
        _like(F.substring(form, 5, 6), F.concat(seed, F.lit("x")))))
        .otherwise(F.substr(F.concat(_fixed_lead(form, F.substring(form, 1, 2), seed), more(10, 48)),
                            F.lit(1), F.greatest(F.length(form), F.lit(15)))))
    body = _fixed_lead(F.substr(form, F.lit(1), F.length(form) - 1), F.substring(form, 1, 1), seed)
    card = F.concat(body, ((10 - _luhn_sum(F.concat(body, F.lit("0"))) % 10) % 10).cast("string"))
    octet = lambda k, low=1, n=254: (_draw(seed, k, n) + low).cast("string")
    ip = (F.when(form.rlike(r"^(?:10|127)\."), F.concat_ws(".", F.regexp_extract(form, r"^\d+", 0), octet(1), octet(2), octet(3)))
          .when(form.rlike(r"^(?:192\.168|169\.254|172\.(?:1[6-9]|2\d|3[01]))\."),
                F.concat_ws(".", F.regexp_extract(form, r"^\d+\.\d+", 0), octet(2), octet(3)))
          .otherwise(F.concat_ws(".", octet(0, 11, 115), octet(1), octet(2), octet(3))))
    account = F.concat(F.substring(form, 1, 2), F.lit("00"), _like(F.substr(form, F.lit(5)), seed))
    iban = F.concat(F.substring(form, 1, 2), F.lpad((98 - _iban_rest(account)).cast("string"), 2, "0"), F.substr(account, F.lit(5)))
    name_type, end, script = (F.split_part(kind, F.lit(":"), F.lit(k)) for k in (1, 2, 3))
    extra = F.array_join(F.transform(F.sequence(F.lit(0), attempt), lambda k: F.get(
        F.array(*map(F.lit, MIDDLES)), _draw(seed, k + 8, len(MIDDLES)))), "")  # one more syllable a draw
    last = F.when(end == MALE, _pick(ENDS[MALE], seed, 1)).when(end == FEMALE, _pick(ENDS[FEMALE], seed, 1)) \
        .when(end == "surname", _pick(ENDS["surname"], seed, 1)).otherwise(_pick(ENDS[""], seed, 1))
    latin = name = F.concat(_pick(STARTS, seed, 0), extra, last)
    for s, (a, b) in SCRIPTS.items():
        name = F.when(script == s, F.translate(latin, a, b)).otherwise(name)
    return (F.when(kind == "email", email).when(kind == "phone", phone).when(kind == "card", card)
            .when(kind == "ip", ip).when(kind == "iban", iban)
            .when(kind == "ssn", F.concat(F.lit("9"), _like(F.substr(form, F.lit(2)), seed)))
            .when(kind == "aws", F.concat(F.lit("AKIA"), _like(F.substr(form, F.lit(5)), seed)))
            .when(name_type.isin("given", "surname"), name).otherwise(F.concat(_like(form, seed), more(26, 97))))


def _initial(raw: Column, key: str) -> Column:
    """Another initial: the next one of its alphabet in a keyed order, so that two never become one."""
    for letters in _CAPITALS:
        turned = "".join(sorted(letters, key=lambda c: hashlib.sha256(f"{key}\x1finitial\x1f{c}".encode()).digest()))
        raw = F.translate(raw, turned, turned[1:] + turned[0])
    return raw


def _written(kind: Column, raw: Column, form: Column, drawn: Column) -> Column:
    """The surrogate in the format of the raw part."""
    kept = F.length(_digits(raw)) - F.length(form)  # a country code that the canonical form leaves out
    digits = F.concat(F.substr(_digits(raw), F.lit(1), kept), drawn)
    empty = F.struct(F.lit("").alias("text"), F.lit(0).alias("k"))
    filled = F.aggregate(_chars(raw), empty, lambda a, c: F.when(
        c.rlike("[0-9]"), F.struct(F.concat(a["text"], F.substr(digits, a["k"] + 1, F.lit(1))).alias("text"),
                                   (a["k"] + 1).alias("k")))
        .otherwise(F.struct(F.concat(a["text"], c).alias("text"), a["k"].alias("k"))),
        lambda a: F.concat(a["text"], F.substr(digits, a["k"] + 1)))
    grouped = F.array_join(F.transform(_chars(raw), lambda c, k: F.when(c == " ", " ").otherwise(F.substr(
        drawn, k + 1 - F.length(F.regexp_replace(F.substr(raw, F.lit(1), k), "[^ ]", "")), F.lit(1)))), "")
    upper = (raw == F.upper(raw)) & (raw != F.lower(raw))
    return (F.when(kind.isin("phone", "card", "ssn"), filled).when(kind == "iban", grouped)
            .when(kind == "email", F.when(upper, F.upper(drawn)).otherwise(drawn))
            .when(kind.rlike("^(?:given|surname):"), F.when(upper, F.upper(drawn)).otherwise(F.initcap(drawn)))
            .otherwise(drawn))


def _shape(kind: Column, form: Column) -> Column:
    """What entities of a kind share that may exchange their forms."""
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(form, "[0-9]", "0"), "[a-z]", "a"), "[A-Z]", "A")
    length = F.length(form).cast("string")
    return (F.when(kind == "ip", F.regexp_extract(form, r"^(?:10|127|192\.168|169\.254|172\.(?:1[6-9]|2\d|3[01]))\.", 0))
            .when(kind == "email", F.regexp_extract(form, "@.*", 0))
            .when(kind == "phone", F.concat(F.when(length == "10", "").otherwise(F.substring(form, 1, 2)), F.lit(":"), length))
            .when(kind == "card", F.concat(F.substring(form, 1, 1), F.lit(":"), length))
            .when(kind == "iban", F.concat(F.substring(form, 1, 2), classes))
            .when(kind.isin("ssn", "aws", "secret"), classes).otherwise(""))


def _exchanged(judged: DataFrame, key: str) -> DataFrame:
    """``drawn`` of all entities, for shapes with unsettled ones the next form in a keyed order.

    An order is closed to a ring in every lot; one alone in its shape gets a hash.
    Settled surrogates are no form of the corpus, so the forms given here are free.
    """
    shaped = judged.withColumn("shape", _shape(F.col("kind"), F.col("form")))
    crowded = stage(shaped.groupBy("kind", "shape").agg(F.count(F.lit(1)).alias("n"), F.max("again").alias("crowded"))
                    .where("crowded"), "crowded")
    rank = F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit("exchange"), "kind", "form"), 256)
    rest = shaped.join(crowded, ["kind", "shape"], "left_anti").select("kind", "form", "drawn")
    lots = (lookup_join(shaped, crowded, ["kind", "shape"], "inner", crowded.count()).withColumn("rank", rank)
            .withColumn("lot", F.pmod(F.xxhash64("rank"), F.ceil(F.col("n") / ROTATION_LOT))))
    ring = Window.partitionBy("kind", "shape", "lot").orderBy("rank", "form")
    after = F.coalesce(F.lead("form").over(ring), F.first("form").over(ring))
    turned = lots.withColumn("after", after).select("kind", "form", F.when(F.col("after") != F.col("form"), F.col("after"))
                                                    .otherwise(F.sha2(F.concat(F.lit(key), "rank"), 256)).alias("drawn"))
    return rest.union(turned)


def assign_surrogates(entities: DataFrame, key: str = KEY, max_rounds: int = 12) -> DataFrame:
    """``kind``, ``form`` and a ``drawn`` surrogate that no other entity of the kind has or drew.

    What is unsettled after ``max_rounds`` draws is settled by exchange.
    """
    space = F.split_part("kind", F.lit(":"), F.lit(1))  # names are told apart whatever their gender
    own = stage(entities.select("kind", "form", space.alias("space")).distinct().withColumn("attempt", F.lit(0)), "entities")
    real = own.select(F.col("space").alias("s"), F.col("form").alias("f")).distinct()
    for _ in range(max_rounds):
        # written, so that the surrogate is drawn once, not in both sides of the join
        drawn = stage(with_seeds(own, key).withColumn("drawn", surrogate(*map(F.col, ("kind", "form", "attempt", "seed", "domain_seed"))))
                      .drop("seed", "domain_seed"), "draws")
        first = drawn.groupBy("space", "drawn").agg(F.min(F.struct("attempt", "form", "kind")).alias("first"))
        again = (~F.col("first").eqNullSafe(F.struct("attempt", "form", "kind"))) | F.col("f").isNotNull()
        judged = stage(drawn.join(first, ["space", "drawn"])
                       .join(real, (F.col("space") == F.col("s")) & (F.col("drawn") == F.col("f")), "left")
                       .select("kind", "form", "space", "attempt", "drawn", again.alias("again")), "entities")
        if judged.where("again").isEmpty():
            return judged.select("kind", "form", "drawn")
        own = judged.select("kind", "form", "space", (F.col("attempt") + F.col("again").cast("int")).alias("attempt"))
    return _exchanged(judged, key)


def _one_kind(entities: DataFrame) -> DataFrame:
    """``kind``, ``form`` and ``as_kind``, for which the surrogate is drawn: one for all kinds of a given name.

    That is the gender that its titles anywhere in the corpus give, or none if they give two or none.
    """
    plain = F.regexp_replace("kind", "^given:[mf]:", "given::").alias("plain")
    kinds = entities.groupBy(plain, "form").agg(F.collect_set("kind").alias("kinds"))
    gendered = F.filter("kinds", lambda k: k != F.col("plain"))
    as_kind = F.when(F.size(gendered) == 1, F.get(gendered, F.lit(0))).otherwise(F.col("plain"))
    return kinds.select(F.explode("kinds").alias("kind"), "form", as_kind.alias("as_kind"))


def _followed(piece: Column, buckets: Column) -> Column:
    """Words and gaps of a text between mentions; a capitalised word of a found name is written as its surrogate."""
    def one(x: Column) -> Column:
        tail = F.regexp_extract(x, ENDING, 0)
        word = F.substr(x, F.lit(1), F.length(x) - F.length(tail))
        form = F.lower(F.replace(word, F.lit("’"), F.lit("'")))
        near = F.get(buckets, F.pmod(F.xxhash64(form), F.lit(NAME_BUCKETS)).cast("int"))
        drawn = F.get(F.filter(near, lambda n: n["form"] == form), F.lit(0))["drawn"]
        new = F.concat(_written(F.lit("surname:"), word, form, drawn), tail)
        return F.when(x.rlike(r"^\p{Lu}") & drawn.isNotNull(), F.struct(new.alias("text"), F.lit(1).alias("n"))).otherwise(
            F.struct(x.alias("text"), F.lit(0).alias("n")))
    return F.transform(F.regexp_extract_all(piece, F.lit(WORD_OR_GAP), F.lit(0)), one)


def _names_of(parts: DataFrame) -> DataFrame:
    """``__row`` and the names found in it, ``(form, drawn)`` in buckets by form; one surrogate a form, a surname's first."""
    kind = F.split_part("kind", F.lit(":"), F.lit(1))
    one = (parts.where(kind.isin("given", "surname") & F.col("drawn").isNotNull())
           .groupBy("__row", "form").agg(F.max(F.struct(kind.alias("space"), F.col("drawn"))).alias("best")))
    bucket = F.pmod(F.xxhash64("form"), F.lit(NAME_BUCKETS)).cast("int")
    filled = (one.groupBy("__row", bucket.alias("bucket"))
              .agg(F.sort_array(F.collect_list(F.struct("form", F.col("best.drawn").alias("drawn")))).alias("names")))
    by_bucket = filled.groupBy("__row").agg(F.map_from_entries(F.collect_list(F.struct("bucket", "names"))).alias("m"))
    return by_bucket.select("__row", F.transform(F.sequence(F.lit(0), F.lit(NAME_BUCKETS - 1)),
                                                 lambda b: F.try_element_at("m", b)).alias("__names"))


def replace_entities(docs: DataFrame, text_col: str = "text", key: str = KEY,
                     count_col: str | None = None) -> DataFrame:
    """``docs`` with surrogates in ``text_col``; ``count_col`` names a column for the number replaced."""
    has = _holds_entity(F.col(text_col))
    hit = stage(docs.where(has).withColumn("__row", F.monotonically_increasing_id()), "mentions")
    mentions = hit.select("__row", F.posexplode(F.regexp_extract_all(F.col(text_col), F.lit(ANY), F.lit(0))).alias("at", "raw"))
    parts = stage(mentions.select("__row", "at", F.posexplode(_parts(F.col("raw"))).alias("part", "p"))
                  .select("__row", "at", "part", "p.kind", "p.lead", "p.raw", "p.form", "p.tail"), "parts")
    entities = stage(_one_kind(parts.where("kind <> 'initial'")), "kinds")
    drawn = (assign_surrogates(entities.select(F.col("as_kind").alias("kind"), "form"), key)
             .withColumnRenamed("kind", "as_kind").join(entities, ["as_kind", "form"]).select("kind", "form", "drawn"))
    new = F.when(F.col("kind") == "initial", _initial(F.col("raw"), key)).when(F.col("drawn").isNull(), F.col("raw")).otherwise(
        _written(F.col("kind"), F.col("raw"), F.col("form"), F.col("drawn")))
    found = stage(parts.join(drawn, ["kind", "form"], "left"), "drawn")
    written = (found.groupBy("__row", "at").agg(
                   F.sort_array(F.collect_list(F.struct("part", F.concat("lead", new, "tail").alias("new")))).alias("parts"),
                   F.max(F.col("drawn").isNotNull().cast("int")).alias("replaced"))
               .select("__row", F.struct("at", F.array_join(F.transform("parts", lambda x: x["new"]), "").alias("new"),
                                         "replaced").alias("m")))
    by_row = written.groupBy("__row").agg(F.sort_array(F.collect_list("m")).alias("__new"))
    between = F.split(F.col(text_col), ANY, -1)
    pieces = F.when(F.col("__names").isNull(), F.transform(between, lambda x: F.array(
        F.struct(x.alias("text"), F.lit(0).alias("n"))))).otherwise(
            F.transform(between, lambda x: _followed(x, F.col("__names"))))
    text = F.array_join(F.transform("__pieces", lambda p, k: F.concat(
        F.array_join(F.transform(p, lambda w: w["text"]), ""), F.coalesce(F.get(F.col("__new"), k)["new"], F.lit("")))), "")
    done = (hit.join(by_row, "__row").join(_names_of(found), "__row", "left")
            .withColumn("__pieces", pieces).withColumn(text_col, text))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rest = docs.where(~has).select(*columns)
    if count_col:
        add = lambda a, x: a + x
        n = (F.aggregate(F.transform("__new", lambda m: m["replaced"]), F.lit(0), add)
             + F.aggregate(F.transform(F.flatten("__pieces"), lambda w: w["n"]), F.lit(0), add)).cast("long")
        return done.select(*columns, n.alias(count_col)).union(rest.withColumn(count_col, F.lit(0).cast("long")))
    return done.select(*columns).union(rest)
