"""Personal data: keyed surrogates of the same type and format, in SQL functions only.

Found values are e-mail addresses, telephone and card numbers, IP addresses, identity numbers, IBANs,
and names after a form of address: any number of words, initials and particles, each word a value of its
own, and the same words wherever else the document has them, in capitals too. Of a script without
capitals a name is the first word, or up to four Han characters. Every distinct value of a kind gets
one surrogate in the whole table (coreference), made from a keyed digest: digits become digits, letters
become letters of the same script and case, the rest stays; names become names of the same gender and
script. Surrogates that two values would share, or that occur as a value themselves, are made again until
all differ; from the fifth attempt on they get longer, so that no number of values fills their space.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landstrata.session import materialise, materialise_observing

KINDS = ("email", "phone", "card", "ip", "identity", "iban", "name")
MENTION = "mention"  # a proper word outside the values found
WIDEN = 4  # attempts of the same length; each later one has a character more

# Forms of address by gender and language.
MALE = ("Mr", "Herr", "Herrn", "Monsieur", "Señor", "Sr", "Господин", "г-н")
FEMALE = ("Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mademoiselle", "Mlle", "Señora", "Sra", "Señorita", "Госпожа", "г-жа")
NEUTRAL = ("Dr", "Prof", "Mx")

# Syllables and endings of made-up names.
LATIN = "bal ber bor cal cor dan del dor el fer gal gar hal har jon kal kel lan lar lor mal mar mel mor nal nor pel ral ran rol sal san sel tal tan tor val ver vel wal".split()
CYRILLIC = "бал бер бор вал вел гал гор дан дел дор ел жан зар кал кел лан лар лор мал мар мел мор нал нор пел рал ран рол сал сан сел тал тан тор фал фер".split()
ENDINGS = {"family": ("son", "ов", "ης"), "male": ("en", "ан", "ος"), "female": ("a", "а", "α"), "neutral": ("i", "и", "ι")}
TO_GREEK = ("abcdefghijklmnoprstvw", "αβκδεφγχιξκλμνοπρστβω")
# Letters of other scripts than Latin: first and last code point of a range of small or caseless ones.
SCRIPTS = {
    "Cyrillic": (0x0430, 0x044F), "Greek": (0x03C3, 0x03C9), "Han": (0x4E00, 0x4FFF), "Hiragana": (0x304B, 0x3062), "Katakana": (0x30AB, 0x30C2),
    "Hangul": (0xAC00, 0xAEFF), "Arabic": (0x0628, 0x063A), "Hebrew": (0x05D0, 0x05EA), "Devanagari": (0x0915, 0x0939), "Thai": (0x0E01, 0x0E2E),
}

_WORD = r"\p{L}\p{N}"
_ADDRESS = rf"(?<![{_WORD}._%+-])[{_WORD}._%+-]++@[{_WORD}-]++(?:\.[{_WORD}-]++)++"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_IP = rf"(?<![\d.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?\d)"
_HEX = r"[0-9A-Fa-f]{1,4}"
_IP6 = (
    rf"(?<![{_WORD}:.])(?=[0-9A-Fa-f:]*\d)(?:(?:{_HEX}:){{7}}{_HEX}|(?:{_HEX}:){{2,6}}(?::{_HEX}){{1,5}}|{_HEX}:(?::{_HEX}){{2,6}}"
    rf"|[0-9A-Fa-f]{{3,4}}::{_HEX}|(?:{_HEX}:){{3,7}}:|::{_HEX}(?::{_HEX}){{1,6}})(?![{_WORD}:])(?!\.\d)"
)
_CARD = r"(?<![\d+])(?:\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{1,7}|3[47]\d{2}[ -]\d{6}[ -]\d{5}|3[0689]\d{2}[ -]\d{6}[ -]\d{4})(?!\d)"
_IDENTITY = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
# Digits in groups of thousands are an amount: behind one or two digits, or with a last group of zeros.
_END = r"(?![ .-]?\d)"
_AMOUNT = "|".join(
    rf"(?<!\d)\d{{1,2}}(?:{sep}\d{{3}}){{2,}}{_END}|(?<!\d)\d{{3}}(?:{sep}\d{{3}})*{sep}000{_END}|(?<=(?<!\d)\d{{1,2}}{sep})\d{{3}}(?:{sep}\d{{3}})+{_END}"
    for sep in (" ", r"\.", "\u00a0", "\u202f")
)
# By country: Russia, France, the others with a code in groups of any sizes (8 to 15 digits), France and
# Russia without one, and the usual groups of 2 to 4, 3 or 4, and 3 or 4 digits.
_PHONE = (
    r"(?<![\d+])(?:"
    r"\+7[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{2}[ .-]?\d{2}(?!\d)"
    r"|\+33[ .-]?(?:\(0\)[ .-]?)?\d(?:[ .-]?\d{2}){4}(?!\d)"
    r"|\+1[ .-]?(?:\(\d{3}\)|\d{3})[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
    r"|\+(?=[2-9](?:[ ().-]{0,2}\d){7})\d{1,3}(?:[ .-]?(?:\(\d{1,5}\)|\d{1,12}(?!\d))){1,5}+"
    r"|0[1-9](?:[ .-]\d{2}){4}(?![ .-]?\d)"
    r"|8[ -]?(?:\(\d{3,5}\)|\d{3})[ -]?\d{2,3}[ -]\d{2}[ -]\d{2}(?![ -]?\d)"
    rf"|(?!{_AMOUNT})(?:\+\d{{1,3}}[ .-]?)?(?:\(\d{{2,4}}\)[ .-]?|\d{{2,4}}[ .-])\d{{3,4}}[ .-]?\d{{3,4}}(?!\d)"
    r"|\+\d{8,15}(?!\d))"
)
_IBAN = rf"(?<![{_WORD}])[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{3,7}}(?: ?[A-Z0-9]{{1,3}})?(?![{_WORD}])"
_TITLE = "|".join((*MALE, *FEMALE, *NEUTRAL))
# A name's word: hyphens and apostrophes belong to it, but for an English genitive's.
_PROPER = r"\p{Lu}[\p{L}\p{M}]*+(?:-\p{Lu}[\p{L}\p{M}]*+|['’](?!s(?!\p{L}))[\p{L}\p{M}]++)*+"
_NAMED = rf"(?:\p{{Lu}}\.(?:-?\p{{Lu}}\.)*+|{_PROPER})"
_CASELESS = r"(?:\p{IsHan}{1,4}+|(?:(?!\p{IsHan})\p{Lo}\p{M}*+)++)"
_SINGLE = rf"(?!(?:{_TITLE})(?!\p{{L}}))(?![{_WORD}._%+-]++@){_NAMED}"
_PARTICLE = r"(?:(?:van|von|vom|de|del|della|der|den|des|di|da|do|dos|das|du|la|le|el|al|bin|ibn|ben|ter|ten|zu|zum|zur|af|av|y|e) )"
_NAME = rf"(?<=(?<![{_WORD}])(?:{_TITLE})\.? )(?:{_PARTICLE}*+{_SINGLE}(?: {_PARTICLE}*+{_SINGLE})*+|{_CASELESS})"
_MENTION = rf"(?<![{_WORD}])(?:{_PROPER}|{_CASELESS})(?![{_WORD}])"
# What a value begins with is asked first: looking back for a form of address at every character is slow.
ANY = rf"{_ADDRESS}|(?=[0-9A-Fa-f:]{{1,4}}:){_IP6}|(?=[\d+(])(?:{_IP}|{_CARD}|{_IDENTITY}|{_PHONE})|(?=[A-Z]{{2}}\d){_IBAN}|(?<= )(?=[\p{{Lu}}\p{{Lo}}]|{_PARTICLE}){_NAME}"


def replaced(docs: DataFrame, secret: str, text: str = "text") -> DataFrame:
    """`docs` with every value found in `text` replaced, and `n_<kind>` columns that count them.

    The same `secret` and table give the same surrogates. A value is replaced alike wherever it occurs,
    and different values of a kind differently; no surrogate is itself a value found in the table. Names
    that differ in capitals only are one value. Card numbers keep their first digit and have a right check
    digit. Null texts stay null with counts 0, empty texts empty; texts may be of any length. All rows,
    repeated ones too, and all other columns stay, whatever their names, but for columns of the names
    n_<kind>, which are replaced. An empty table gives an empty result.
    """
    columns = [c for c in docs.columns if c not in {f"n_{k}" for k in KINDS}]
    hit = F.coalesce(F.col(text).rlike(ANY), F.lit(False))
    clean = docs.where(~hit).select(*(F.col(f"`{c}`") for c in columns), *(F.lit(0).cast("bigint").alias(f"n_{k}") for k in KINDS))

    # What is given travels in one column, so that no name of it can clash with the working ones.
    held = docs.where(hit).select(F.struct(*(F.col(f"`{c}`") for c in columns)).alias("given"), F.col(text).alias("text"))
    held = held.withColumns({"parts": F.split("text", ANY, -1), "found": F.regexp_extract_all("text", F.lit(ANY), F.lit(0))})
    held = held.withColumn("kinds", F.transform("found", lambda v, i: _kind(v, i)))
    held = held.select("given", _said().alias("said"), F.monotonically_increasing_id().alias("row"))
    held = materialise(held.withColumn("before", F.col("said.before")))
    said = held.select("row", F.posexplode(F.transform("said", lambda x: x.dropFields("before"))).alias("place", "x"))
    named = F.col("x.kind").startswith("name-") | (F.col("x.kind") == MENTION)
    said = said.select("row", "place", "x.kind", F.col("x.value").alias("spelt"), F.when(named, F.lower("x.value")).otherwise(F.col("x.value")).alias("value"))

    # Other words are names if the document has them as such, but not initials.
    names = said.where("startswith(kind, 'name-') and length(value) > 1").groupBy("row", "value").agg(F.min("kind").alias("named"))
    others = said.where(F.col("kind") == MENTION).join(names, ["row", "value"], "left").withColumn("kind", F.col("named")).drop("named")
    said = said.where(F.col("kind").isNull() | (F.col("kind") != MENTION)).unionByName(others)
    known = surrogates(said.where("kind is not null").select("kind", "value").distinct(), secret)
    new = said.join(known, ["kind", "value"], "left")
    shouted = F.col("kind").startswith("name-") & F.col("spelt").rlike(r"^\P{Ll}*\p{Lu}\P{Ll}*\p{Lu}\P{Ll}*$") & ~F.col("spelt").contains(".")
    new = new.withColumn("surrogate", F.when(shouted, F.upper("surrogate")).otherwise(F.coalesce("surrogate", "spelt")))
    counts = [F.count_if(F.col("kind").startswith(k)).alias(f"n_{k}") for k in KINDS]
    new = new.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "surrogate"))).alias("new"), *counts)
    out = held.select("given", "row", "before").join(new, "row")
    whole = F.array_join(F.zip_with("before", F.col("new.surrogate"), lambda part, s: F.concat(part, s)), "")
    return out.select(*(whole.alias(c) if c == text else F.col("given").getField(c).alias(c) for c in columns), *(f"n_{k}" for k in KINDS)).unionByName(clean)


def _cut(text: Column, pattern: str, use) -> Column:
    """`use(before, match, last)` of every match of a pattern, and of the rest with an empty match."""
    parts, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    return F.transform(F.arrays_zip(parts.alias("a"), found.alias("b")), lambda x, i: use(x["a"], x["b"], i + 1 >= F.size(found)))


def _said() -> Column:
    """(before, value, kind) of the text in order: a name is taken apart into its words, and the text of a
    document with names into its other proper words, which may be mentions. The end is an empty value."""
    one = lambda before, value, kind: F.struct(before.alias("before"), F.coalesce(value, F.lit("")).alias("value"), kind.cast("string").alias("kind"))
    named = F.exists("kinds", lambda k: k.startswith("name-"))

    def pieces(part: Column, i: Column) -> Column:
        value, kind = F.get(F.col("found"), i), F.get(F.col("kinds"), i)
        free = _cut(part, _MENTION, lambda a, b, _: one(a, b, F.when(b.isNotNull(), MENTION)))
        free = F.when(named, free).otherwise(F.array(one(part, F.lit(""), F.lit(None))))
        script = lambda word: F.coalesce(*(F.when(word.rlike(rf"\p{{Is{name}}}"), name) for name in SCRIPTS), F.lit("Latin"))
        part_of = lambda b, last: F.concat_ws("-", F.when(last, "name-family").otherwise(kind), script(b))
        words = _cut(value, rf"{_NAMED}|{_CASELESS}", lambda a, b, last: one(a, b, F.when(b.isNotNull(), part_of(b, last))))
        whole = F.when(kind.startswith("name-"), words).otherwise(F.array(one(F.lit(""), value, kind)))
        return F.concat(free, whole)

    return F.flatten(F.transform("parts", pieces))


def _kind(value: Column, place: Column) -> Column:
    """The kind of the value found at `place`; that of a name says its form of address's gender."""
    before = F.get(F.col("parts"), place)
    title = F.regexp_extract(before, rf"({_TITLE})\.? $", 1)
    gender = F.when(title.isin(*MALE), "male").when(title.isin(*FEMALE), "female").otherwise("neutral")
    digits = F.length(F.regexp_replace(value, r"\D", ""))
    return (
        F.when(value.contains("@"), "email")
        .when(value.rlike(rf"^{_OCTET}(\.{_OCTET}){{3}}$"), "ip")
        .when(value.rlike("^[0-9A-Fa-f:]*:[0-9A-Fa-f:]*$"), "ip6")
        .when(value.rlike(r"^\d{3}-\d{2}-\d{4}$"), "identity")
        .when(value.rlike(r"^[A-Z]{2}\d{2}"), "iban")
        .when(value.rlike(r"^\p{L}"), F.concat_ws("-", F.lit("name"), gender))
        .when((digits >= 13) & ~value.startswith("+") & ~value.startswith("("), "card")
        .otherwise("phone")
    )


def surrogates(values: DataFrame, secret: str) -> DataFrame:
    """(kind, value, surrogate) for distinct (kind, value): surrogates that differ from each other and
    from every value. Who loses a collision (the later attempt, then the larger value) tries again; as
    surrogates get longer with the attempts, a few rounds do, however many values there are. Names
    are given in small letters, and compared in them."""
    values = materialise(values.select("kind", "value"))
    said = F.when(F.col("kind").startswith("name-"), F.lower("surrogate")).otherwise(F.col("surrogate"))
    now = materialise(values.withColumn("attempt", F.lit(0)).withColumn("surrogate", surrogate(secret)))
    while True:
        marked = now.withColumn("said", said)
        shared = marked.groupBy("said").agg(F.min(F.struct("attempt", "kind", "value")).alias("owner"), F.count(F.lit(1)).alias("n"))
        shared = shared.where("n > 1").select("said", "owner")
        taken = values.select(F.col("value").alias("said")).distinct().withColumn("taken", F.lit(True))
        marked = marked.join(shared, "said", "left").join(taken, "said", "left")
        lost = F.coalesce(F.col("owner") != F.struct("attempt", "kind", "value"), F.lit(False)) | F.col("taken").isNotNull()
        marked = marked.select("kind", "value", "attempt", "surrogate", lost.alias("lost"))
        marked, seen = materialise_observing(marked, again=F.count_if("lost"))
        now = marked.drop("lost")
        if not seen["again"]:
            return now.select("kind", "value", "surrogate")
        again = marked.where("lost").select("kind", "value", (F.col("attempt") + 1).alias("attempt")).withColumn("surrogate", surrogate(secret))
        now = materialise(marked.where("not lost").drop("lost").unionByName(again))


def surrogate(secret: str) -> Column:
    """The surrogate of columns kind, value and attempt."""
    digest = F.sha2(F.concat_ws("\u0001", F.lit(secret), "kind", F.col("attempt").cast("string"), "value").cast("binary"), 256)
    # A new digest for every 30 characters, so that long values do not repeat.
    number = lambda i: F.conv(F.substring(F.sha2(F.concat(digest, F.floor(i / 30).cast("string")).cast("binary"), 256), F.pmod(i, F.lit(30)) * 2 + 1, F.lit(4)), 16, 10).cast("int")
    pick = lambda letters, i: F.substring(F.lit(letters), F.pmod(number(i), F.lit(len(letters))) + 1, F.lit(1))
    chars = F.filter(F.split(F.col("value"), ""), lambda c: c != "")

    def letter(c: Column, i: Column) -> Column:
        own = (F.when(c.rlike(rf"^\p{{Is{name}}}$"), pick("".join(map(chr, range(a, b + 1))), i)) for name, (a, b) in SCRIPTS.items())
        return F.coalesce(*own, pick("abcdefghijklmnopqrstuvwxyz", i))

    def other(c: Column, i: Column) -> Column:
        small = letter(c, i)
        return F.when(c.rlike(r"^\d$"), pick("0123456789", i)).when(c.rlike(r"^\p{Lu}$"), F.upper(small)).when(c.rlike(r"^\p{L}$"), small).otherwise(c)

    spelt = F.array_join(F.transform(chars, other), "")
    # The last label of an address stays.
    label = F.regexp_extract("value", r"\.[^.]*$", 0)
    kept = F.length("value") - F.length(label)
    extra = F.sequence(F.lit(1), F.greatest(F.col("attempt") - WIDEN, F.lit(1)))
    longer = lambda letters: F.when(F.col("attempt") > WIDEN, F.array_join(F.transform(extra, lambda k: pick(letters, k + 400)), "")).otherwise("")
    email = F.concat(longer("abcdefghijklmnopqrstuvwxyz"), F.substring(spelt, F.lit(1), kept), label)
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.pmod(number(i), F.lit(254)) + 1), ".")
    hexadecimal = lambda c, i: F.when(c == ":", c).when(F.col("value").rlike("[A-F]"), pick("0123456789ABCDEF", i)).otherwise(pick("0123456789abcdef", i))
    ip6 = F.array_join(F.transform(chars, hexadecimal), "")
    wide = F.concat(F.lit("fd00:"), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(6)), lambda i: F.lower(F.hex(number(i + 50)))), ":"))
    full = F.col("attempt") > WIDEN  # an address gives way to one of the larger space
    iban = F.concat(F.substring(F.col("value"), 1, 2), F.substring(spelt, F.lit(3), F.length("value")))
    plus = F.regexp_extract("value", r"^\+\d{1,3}(?=\D)", 0)  # a country's code stays
    phone = F.concat(plus, F.substring(spelt, F.length(plus) + 1, F.length("value")), longer("0123456789"))
    card = _checked(F.concat(F.substring(F.col("value"), 1, 1), F.substring(spelt, F.lit(2), F.length("value")), longer("0123456789")))
    return (
        F.when(F.col("kind") == "email", email).when(F.col("kind").isin("ip", "ip6") & full, wide).when(F.col("kind") == "ip", octets).when(F.col("kind") == "ip6", ip6).when(F.col("kind") == "iban", F.concat(iban, longer("0123456789")))
        .when(F.col("kind") == "phone", phone).when(F.col("kind") == "card", card)
        .when(F.col("kind").startswith("name-"), _name(number, pick)).otherwise(F.concat(spelt, longer("0123456789")))
    )


def _checked(number: Column) -> Column:
    """A card number whose last digit makes the sum of its digits, every other one doubled, end in 0."""
    digits = F.reverse(F.filter(F.split(F.substring(number, F.lit(1), F.length(number) - 1), ""), lambda c: c.rlike(r"^\d$")))
    weighed = F.transform(digits, lambda d, i: F.when(i % 2 == 0, F.floor(d.cast("int") * 2 / 10) + (d.cast("int") * 2) % 10).otherwise(d.cast("int")).cast("int"))
    total = F.aggregate(weighed, F.lit(0), lambda a, d: a + d)
    return F.concat(F.substring(number, F.lit(1), F.length(number) - 1), ((10 - total % 10) % 10).cast("string"))


def _name(number, pick) -> Column:
    """Two syllables and an ending for the part, the gender and the script, or as many letters as the word
    has in scripts without such syllables; one more for each attempt."""
    kind = F.split("kind", "-")

    def syllable(i: Column) -> Column:
        latin = F.get(F.array(*map(F.lit, LATIN)), F.pmod(number(i), F.lit(len(LATIN))))
        cyrillic = F.get(F.array(*map(F.lit, CYRILLIC)), F.pmod(number(i), F.lit(len(CYRILLIC))))
        own = (F.when(kind[2] == name, pick("".join(map(chr, range(a, b + 1))), i)) for name, (a, b) in SCRIPTS.items() if name not in ("Cyrillic", "Greek"))
        return F.coalesce(F.when(kind[2] == "Latin", latin), F.when(kind[2] == "Cyrillic", cyrillic), F.when(kind[2] == "Greek", F.translate(latin, *TO_GREEK)), *own)

    def ending(part: str) -> Column:
        latin, cyrillic, greek = ENDINGS[part]
        return F.when(kind[1] == part, F.when(kind[2] == "Latin", latin).when(kind[2] == "Cyrillic", cyrillic).when(kind[2] == "Greek", greek).otherwise(""))

    syllables = F.when(kind[2].isin("Latin", "Cyrillic", "Greek"), 1).otherwise(F.length("value") - 1) + F.col("attempt")
    return F.initcap(F.concat(F.array_join(F.transform(F.sequence(F.lit(0), syllables), syllable), ""), F.coalesce(*map(ending, ENDINGS))))
