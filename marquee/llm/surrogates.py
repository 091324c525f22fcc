"""Personal data replaced by surrogates of the same kind; DataFrame functions only.

One pattern finds addresses, numbers and titled names of any number of words; the names that a text
gives with a title are then found in it without one too. Each different entity of the corpus gets a
surrogate from a keyed hash: letters stay letters of their script, digits digits, card and account
numbers keep or miss their check digits, given names keep their gender, particles stay. An entity is known by a canonical
form (digits without their layout, letters without their case), so all its occurrences get one
surrogate, each in the layout of the text it replaces.

Distinctness is checked over the whole corpus: of entities that draw the same surrogate the
smallest keeps it, nobody gets one that is itself an entity, and the others draw again until all
differ. From the twelfth draw on surrogates grow by a character, so a small space cannot run out.
What is grouped and joined are entities, not texts; texts move once, when they are put together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import id_and_text, materialise

EMAIL = r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,}"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
ADDRESS = rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d)"
SOCIAL = r"(?<![\p{L}\p{N}])\d{3}-\d{2}-\d{4}(?!\d)"
CARD = r"(?<![\p{L}\p{N}])\d(?:[ -]?\d){12,18}(?![\p{L}\p{N}])"
_HEX = "[0-9A-Fa-f]{1,4}"
ADDRESS6 = (
    rf"(?<![\p{{L}}\p{{N}}:.])(?:(?:{_HEX}:){{7}}{_HEX}|(?=[0-9A-Fa-f:]*\d)(?:{_HEX}:){{1,6}}(?::{_HEX}){{1,6}})(?![\p{{L}}\p{{N}}:])"
)
ACCOUNT = r"(?<![\p{L}\p{N}])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![\p{L}\p{N}])"
#: Seven to fifteen digits: after a plus sign; with an area code in brackets; after a leading zero, unless it is a date; in groups.
PHONE = (
    r"(?<![\p{L}\p{N}])(?:\+\d(?:[ .()/-]{0,3}\d){6,14}"
    r"|(?:\d{1,3}[ .-]?)?\(\d{2,5}\)[ .-]?\d(?:[ .-]?\d){4,9}"
    r"|(?!\d\d(?<mark>[./-])\d\d\k<mark>\d{4}(?!\d))0\d{1,4}[ ./-]\d(?:[ ./-]?\d){4,9}"
    r"|\d{2,4}[ .-]\d{3,4}[ .-]\d{3,4})(?!\d)"
)
MALE_TITLES = "Mr|Herrn|Herr|Monsieur|Señor|Sr|Господин|Κύριος|Κύριε|Κύριο"
FEMALE_TITLES = "Mrs|Ms|Miss|Frau|Madame|Mme|Señora|Sra|Госпожа|Κυρία"
OTHER_TITLES = "Dr|Prof"
PARTICLES = "van|von|der|den|ter|de|del|della|di|da|dos|du|la|le|el|al|bin|ibn|zu|zur"
#: Name words begin with a capital and may have one after an apostrophe, a hyphen or a prefix, as in O'Brien or McDonald.
_PIECE = r"(?:\p{Lu}['’])?\p{Lu}\p{Ll}+(?:\p{Lu}\p{Ll}+)?"
_WORD = rf"(?:{_PIECE}(?:-{_PIECE})*)"
_NAME = rf"(?:(?:{PARTICLES}) ){{0,3}}{_WORD}"
_TITLES = rf"(?:{FEMALE_TITLES}|{MALE_TITLES}|{OTHER_TITLES})\.?"
PERSON = rf"(?<![\p{{L}}\p{{N}}]){_TITLES} (?:\p{{Lu}}\. ?)*{_NAME}(?: (?:\p{{Lu}}\. )*{_NAME}){{0,5}}(?![\p{{L}}\p{{N}}])"
ENTITY = "|".join((EMAIL, ADDRESS6, ADDRESS, SOCIAL, ACCOUNT, CARD, PHONE, PERSON))

LATIN, ACCENTED = "abcdefghijklmnopqrstuvwxyz", "áàâäéèêëíìîïóòôöúùûüñç"
CYRILLIC, GREEK = "абвгдежзиклмнопрстуфхцчшэюя", "αβγδεζηθικλμνξοπρστυφχψω"
GIVEN = {
    ("latin", "male"): "Adam Bruno Carl David Emil Felix Georg Hugo Ivan Jonas Leon Marco Noah Oscar Paul Simon".split(),
    ("latin", "female"): "Ada Bella Clara Diana Elsa Flora Greta Hanna Ines Julia Laura Marta Nora Olga Petra Sara".split(),
    ("latin", "other"): "Alex Andrea Ariel Casey Dana Jamie Jordan Kai Kim Luca Morgan Noel Robin Sascha Taylor Toni".split(),
    ("cyrillic", "male"): "Антон Борис Виктор Глеб Денис Егор Иван Кирилл".split(),
    ("cyrillic", "female"): "Анна Вера Галина Дарья Елена Ирина Мария Ольга".split(),
    ("cyrillic", "other"): "Саша Женя Валя Шура".split(),
    ("greek", "male"): "Αλέξης Γιώργος Δημήτρης Κώστας Νίκος Πάνος Πέτρος Στέφανος".split(),
    ("greek", "female"): "Άννα Βασιλική Ελένη Ειρήνη Κατερίνα Μαρία Σοφία Χριστίνα".split(),
    ("greek", "other"): "Άρτεμις Φάνη Χάρις Ρένια".split(),
}
SYLLABLES = {
    "latin": "ba bel cor dan del fer gal hol kem lan lor mar nel por ran ros sen tal vin wer".split(),
    "cyrillic": "ба вел гор дан жин кор лен мар нов пет рас сен тал хор чер".split(),
    "greek": "βα γελ δαν θορ κορ λεν μαρ νοβ πετ ρασ σεν ταλ φορ χερ".split(),
}
LONGER_FROM, MOST_DRAWS = 12, 200


# --- detection -----------------------------------------------------------------------------------------------


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def kind_of(raw: Column) -> Column:
    return (
        F.when(F.contains(raw, F.lit("@")), "email")
        .when(F.contains(raw, F.lit(":")), "address6")
        .when(raw.rlike(r"^[A-Z]{2}\d"), "account")
        .when(raw.rlike(r"^\p{L}"), "person")
        .when(raw.rlike(rf"^{ADDRESS}$"), "address")
        .when(raw.rlike(r"^\d{3}-\d{2}-\d{4}$"), "social")
        .when(raw.rlike(r"^\d(?:[ -]?\d){12,18}$"), "card")
        .otherwise("phone")
    )


def _name_words(raw: Column) -> Column:
    """Words of a name without its title; initials stand apart."""
    untitled = F.regexp_replace(raw, rf"^{_TITLES} ", "")
    return F.split(F.regexp_replace(untitled, r"(\p{Lu}\.)(?! )", "$1 "), " ")


def _of_person(words: Column) -> Column:
    return F.filter(words, lambda w: ~w.rlike(rf"^(?:{PARTICLES})$"))


def _person_parts(raw: Column) -> Column:
    """(kind, canonical form) of the words of a titled name: given names, and the last one a surname."""
    gender = (
        F.when(raw.rlike(rf"^(?:{FEMALE_TITLES})(?!\p{{L}})"), "female").when(raw.rlike(rf"^(?:{MALE_TITLES})(?!\p{{L}})"), "male").otherwise("other")
    )
    words = _of_person(_name_words(raw))
    kind = lambda i: F.when(i == F.size(words) - 1, "surname").otherwise(F.concat(F.lit("given "), gender))
    return F.transform(words, lambda w, i: F.struct(kind(i).alias("kind"), F.lower(w).alias("canon")))


def _is_titled(raw: Column) -> Column:
    return raw.rlike(rf"^{_TITLES} ")


def _parts(raw: Column, names: Column) -> Column:
    """Entities that an occurrence stands for: (kind, canonical form); a titled name has one for each of its words.

    ``names`` are those of the text's titled names; a bare word is the one that it repeats, a surname first.
    """
    kind = kind_of(raw)
    country = F.regexp_extract(raw, r"^\+(\d{1,3})(?!\d)", 1)
    phone = F.when(
        F.startswith(raw, F.lit("+")),
        F.concat(F.lit("+"), country, F.lit(" "), F.substring(_digits(raw), F.length(country) + 1, F.length(raw))),
    ).otherwise(_digits(raw))
    one = lambda k, c: F.struct(k.alias("kind"), c.alias("canon"))
    same = F.filter(names, lambda x: x["canon"] == F.lower(raw))
    bare = F.slice(F.reverse(F.array_sort(same)), 1, 1)
    canon = (
        F.when((kind == "email") | (kind == "address6"), F.lower(raw))
        .when(kind == "address", raw)
        .when(kind == "phone", phone)
        .when(kind == "account", F.regexp_replace(raw, " ", ""))
        .otherwise(_digits(raw))
    )
    return F.when(kind == "person", F.when(_is_titled(raw), _person_parts(raw)).otherwise(bare)).otherwise(F.array(one(kind, canon)))


def _bare_pattern(found: Column) -> Column:
    """What finds the words of titled names where they stand alone; null without any. Longer words go first."""
    words = F.flatten(F.transform(F.filter(found, _is_titled), lambda raw: _of_person(_name_words(raw))))
    words = F.filter(F.array_distinct(words), lambda w: ~F.endswith(w, F.lit(".")))
    longest = F.array_sort(words, lambda a, b: F.length(b) - F.length(a))
    return F.when(
        F.size(words) > 0, F.concat(F.lit(r"|(?<![\p{L}\p{N}])(?:"), F.array_join(longest, "|"), F.lit(r")(?![\p{L}\p{N}])"))
    )


def occurrences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document with entities: ``doc_id``, ``row_key``, ``found``, ``bare`` and ``names``.

    ``found`` are the entities as they stand, in order, ``bare`` the pattern that finds names without a title, and
    ``names`` the kinds and canonical forms of the words of titled names.
    """
    rows = id_and_text(docs, id_col, text_col).withColumn("row_key", F.xxhash64("text", "doc_id"))
    titled = F.filter(F.col("found"), _is_titled)
    found = (
        rows.withColumn("found", F.regexp_extract_all("text", F.lit(ENTITY), F.lit(0)))
        .where(F.size("found") > 0)
        .withColumn("names", F.array_distinct(F.flatten(F.transform(titled, _person_parts))))
        .withColumn("bare", _bare_pattern(F.col("found")))
    )
    again = F.regexp_extract_all("text", F.concat(F.lit(ENTITY), F.col("bare")), F.lit(0))
    found = found.withColumn("found", F.when(F.col("bare").isNull(), F.col("found")).otherwise(again))
    # Rows that repeat are put together once.
    return found.select("doc_id", "row_key", "found", "bare", "names").dropDuplicates(["doc_id", "row_key"])


# --- surrogates ----------------------------------------------------------------------------------------------


def _byte(h: Column, i: Column | int) -> Column:
    at = F.lit(1 + 2 * (i % 64)) if isinstance(i, int) else 1 + 2 * F.pmod(i, F.lit(64))
    return F.conv(F.substring(h, at, F.lit(2)), 16, 10).cast("int")


def _pick(letters: str, byte: Column) -> Column:
    return F.substring(F.lit(letters), 1 + F.pmod(byte, F.lit(len(letters))), F.lit(1))


def _chars(text: Column, each) -> Column:
    at = F.sequence(F.lit(1), F.length(text))
    return F.array_join(F.transform(at, lambda i: each(F.substring(text, i, F.lit(1)), i)), "")


def _drawn(text: Column, h: Column) -> Column:
    """Every letter and digit drawn anew from its own class; all else stays."""
    return _chars(
        text,
        lambda c, i: F.when(c.rlike("[0-9]"), F.pmod(_byte(h, i), F.lit(10)).cast("string"))
        .when(c.rlike("[a-z]"), _pick(LATIN, _byte(h, i)))
        .when(c.rlike(r"\p{IsLatin}"), _pick(ACCENTED, _byte(h, i)))
        .when(c.rlike(r"\p{IsCyrillic}"), _pick(CYRILLIC, _byte(h, i)))
        .when(c.rlike(r"\p{IsGreek}"), _pick(GREEK, _byte(h, i)))
        .otherwise(c),
    )


def _octets(address: Column, h: Column) -> Column:
    """Octets of as many digits as before."""
    each = F.transform(
        F.split(address, r"\."),
        lambda o, i: F.when(F.length(o) == 1, F.pmod(_byte(h, i), F.lit(10)))
        .when(F.length(o) == 2, 10 + F.pmod(_byte(h, i), F.lit(90)))
        .otherwise(100 + F.pmod(_byte(h, i), F.lit(156)))
        .cast("string"),
    )
    return F.array_join(each, ".")


def check_digit(body: Column) -> Column:
    """The digit that makes ``body`` and it pass the Luhn test."""
    at = F.sequence(F.lit(1), F.length(body))
    value = lambda i: F.substring(body, -i, F.lit(1)).cast("int")
    doubled = lambda v: 2 * v - F.when(v > 4, 9).otherwise(0)
    total = F.aggregate(at, F.lit(0), lambda s, i: s + F.when(i % 2 == 1, doubled(value(i))).otherwise(value(i)))
    return F.pmod(10 - F.pmod(total, F.lit(10)), F.lit(10))


def _card(digits: Column, h: Column) -> Column:
    body, last = F.expr("substring(canon, 1, length(canon) - 1)"), F.substring(digits, -1, 1).cast("int")
    drawn = F.concat(F.substring(body, 1, 1), _drawn(F.expr("substring(canon, 2, length(canon) - 2)"), h))
    good = check_digit(drawn)
    bad = F.pmod(good + 1 + F.pmod(_byte(h, 40), F.lit(9)), F.lit(10))
    return F.concat(drawn, F.when(last == check_digit(body), good).otherwise(bad).cast("string"))


def _remainder(text: Column) -> Column:
    """What is left of an account's digits by 97, with letters as 10 to 35."""
    value = lambda c: F.when(c.rlike("[0-9]"), c.cast("int")).otherwise(F.ascii(c) - 55)
    step = lambda rest, c: F.pmod(rest * F.when(c.rlike("[0-9]"), 10).otherwise(100) + value(c), F.lit(97))
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), F.lit(0), step)


def _account(canon: Column, h: Column) -> Column:
    """Country and form stay; check digits are right if those of ``canon`` are."""
    country, body = F.substring(canon, 1, 2), F.expr("substring(canon, 5)")
    capitals = F.lit(LATIN.upper())
    drawn = _chars(
        body, lambda c, i: F.when(c.rlike("[0-9]"), F.pmod(_byte(h, i), F.lit(10)).cast("string"))
        .otherwise(F.substring(capitals, 1 + F.pmod(_byte(h, i), F.lit(26)), F.lit(1)))
    )
    right = _remainder(F.concat(body, F.substring(canon, 1, 4))) == 1
    good = 98 - _remainder(F.concat(drawn, country, F.lit("00")))
    bad = 2 + F.pmod(good - 1 + F.pmod(_byte(h, 40), F.lit(95)), F.lit(97))
    check = F.lpad(F.when(right, good).otherwise(bad).cast("string"), 2, "0")
    return F.concat(country, check, drawn)


def _hexed(canon: Column, h: Column) -> Column:
    return _chars(
        canon, lambda c, i: F.when(c.rlike("[0-9]"), F.pmod(_byte(h, i), F.lit(10)).cast("string"))
        .when(c == ":", c).otherwise(_pick("abcdef", _byte(h, i)))
    )


def _script(text: Column) -> Column:
    return F.when(text.rlike(r"\p{IsCyrillic}"), "cyrillic").when(text.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _listed(values: list[str], byte: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), 1 + F.pmod(byte, F.lit(len(values))))


def _given(canon: Column, h: Column, draw: Column) -> Column:
    out = F.lit(None).cast("string")
    for (script, gender), names in GIVEN.items():
        one = F.when(draw < 3, _listed(names, _byte(h, 0))).otherwise(
            F.concat_ws("-", _listed(names, _byte(h, 0)), _listed(names, _byte(h, 1)))
        )
        out = F.when((_script(canon) == script) & (F.col("kind") == f"given {gender}"), one).otherwise(out)
    return F.lower(out)


def _surname(canon: Column, h: Column, draw: Column) -> Column:
    out = F.lit(None).cast("string")
    for script, parts in SYLLABLES.items():
        three = F.concat(*(_listed(parts, _byte(h, k)) for k in range(3)))
        one = F.when(draw < 3, three).otherwise(F.concat(three, _listed(parts, _byte(h, 3))))
        out = F.when(_script(canon) == script, one).otherwise(out)
    return out


def surrogate(secret: str, draw: int) -> Column:
    """The ``draw``-th surrogate of the columns ``kind`` and ``canon``, in canonical form."""
    kind, canon, number = F.col("kind"), F.col("canon"), F.lit(draw)
    h = F.col("h")
    country = F.regexp_extract(canon, r"^(\+\d* )", 1)
    phone = F.concat(country, _drawn(F.expr("substring(canon, length(regexp_extract(canon, '^([+][0-9]* )', 1)) + 1)"), h))
    host = F.regexp_extract(canon, r"^(.*)\.", 1)
    email = F.concat(_drawn(host, h), F.substring(canon, F.length(host) + 1, F.length(canon)))
    made = (
        F.when(kind == "email", email)
        .when(kind == "address", _octets(canon, h))
        .when(kind == "address6", _hexed(canon, h))
        .when(kind == "account", _account(canon, h))
        .when(kind == "card", _card(canon, h))
        .when(kind == "phone", phone)
        .when(kind == "surname", _surname(canon, h, number))
        .when(F.startswith(kind, F.lit("given")), _given(canon, h, number))
        .otherwise(_drawn(canon, h))
    )
    if draw < LONGER_FROM:
        return made
    more = _drawn(F.lit("0" * (draw - LONGER_FROM + 1)), F.substring(h, F.lit(65), F.lit(64)))
    letters = F.translate(more, "0123456789", "abcdefghij")
    longer_email = F.concat(letters, made)
    return (
        F.when(kind == "email", longer_email).when(kind == "surname", F.concat(made, letters))
        .when(F.startswith(kind, F.lit("given")), F.concat(made, letters))
        .when(kind == "address", F.concat(made, F.lit("."), more))
        .when(kind == "address6", F.concat(made, F.lit(":"), more))
        .otherwise(F.concat(made, more))
    )


def assign(entities: DataFrame, secret: str) -> DataFrame:
    """``kind``, ``canon`` and ``surrogate`` for different entities; surrogates of a kind differ from each other and from all entities.

    ``secret`` is the key: the same key and corpus give the same surrogates. Genders of given names share
    their surrogates' space, as a text shows the name only.
    """
    space = F.regexp_replace("kind", " .*", "")
    every = entities.select(space.alias("space"), F.col("canon").alias("taken"))
    todo, done = entities.select("kind", "canon"), None
    for draw in range(MOST_DRAWS):
        h = F.sha2(F.concat_ws("|", F.lit(secret), "kind", "canon", F.lit(str(draw))), 512)
        drawn = todo.withColumn("h", h).withColumn("surrogate", surrogate(secret, draw)).drop("h").withColumn("space", space)
        taken = every if done is None else every.unionByName(done.select("space", F.col("surrogate").alias("taken")))
        taken = taken.withColumnRenamed("space", "of_space").distinct()
        free = drawn.join(taken, (F.col("space") == F.col("of_space")) & (F.col("surrogate") == F.col("taken")), "left_anti")
        first = free.groupBy("space", "surrogate").agg(F.min(F.struct("canon", "kind")).alias("first"))
        won = first.select("space", F.col("first.kind").alias("kind"), F.col("first.canon").alias("canon"), "surrogate")
        won = materialise(won, "surrogates")
        done = won if done is None else done.unionByName(won)
        todo = materialise(todo.join(won.select("kind", "canon"), ["kind", "canon"], "left_anti"), "losers")
        if not todo.limit(1).count():
            return done.select("kind", "canon", "surrogate")
    raise ValueError(f"entities are left without a surrogate after {MOST_DRAWS} draws")


# --- putting together ----------------------------------------------------------------------------------------


def _filled(raw: Column, digits: Column) -> Column:
    """The digits in the layout of ``raw``; any that are left over come last."""
    before = lambda i: F.length(_digits(F.substring(raw, F.lit(1), i)))
    laid = _chars(raw, lambda c, i: F.when(c.rlike("[0-9]"), F.substring(digits, before(i), F.lit(1))).otherwise(c))
    return F.concat(laid, F.substring(digits, F.length(_digits(raw)) + 1, F.length(digits)))


def _cased(raw: Column, text: Column) -> Column:
    """Upper case where ``raw`` has it, by place."""
    return _chars(text, lambda c, i: F.when(F.substring(raw, i, F.lit(1)).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c))


def _named(word: Column, surrogate: Column) -> Column:
    """A surrogate in the form of a name's word: an initial stays one."""
    whole = F.array_join(F.transform(F.split(surrogate, "-"), F.initcap), "-")
    return F.when(word.rlike(r"^\p{Lu}\.$"), F.concat(F.upper(F.substring(surrogate, 1, 1)), F.lit("."))).otherwise(whole)


def _grouped(raw: Column, text: Column) -> Column:
    """``text`` with the spaces of ``raw``; what is left over comes last."""
    before = lambda i: F.length(F.regexp_replace(F.substring(raw, F.lit(1), i), " ", ""))
    laid = _chars(raw, lambda c, i: F.when(c == " ", c).otherwise(F.substring(text, before(i), F.lit(1))))
    return F.concat(laid, F.substring(text, F.length(F.regexp_replace(raw, " ", "")) + 1, F.length(text)))


def rendered(raw: Column, surrogates: Column) -> Column:
    """What stands in for ``raw``, given the surrogates of its parts in order; particles of names stay."""
    kind = kind_of(raw)
    title = F.regexp_extract(raw, rf"^({_TITLES} )", 1)
    words = _name_words(raw)
    place = lambda i: F.size(_of_person(F.slice(words, F.lit(1), i + 1)))
    each = F.transform(
        words, lambda w, i: F.when(w.rlike(rf"^(?:{PARTICLES})$"), w).otherwise(_named(w, F.get(surrogates, place(i) - 1)))
    )
    return (
        F.when((kind == "email") | (kind == "address6"), _cased(raw, surrogates[0]))
        .when(kind == "address", surrogates[0])
        .when(kind == "account", _grouped(raw, surrogates[0]))
        .when(kind == "person", F.concat(title, F.array_join(each, " ")))
        .otherwise(_filled(raw, _digits(surrogates[0])))
    )


def replace_entities(docs: DataFrame, secret: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row per document: ``doc_id``, ``text`` with surrogates, and ``n_entities``.

    A null or empty text gives an empty text. Texts without entities are unchanged. Rows that repeat are
    changed alike.
    """
    found = materialise(occurrences(docs, id_col, text_col), "occurrences")
    each = found.select("doc_id", "row_key", "names", F.posexplode("found").alias("pos", "raw"))
    parts = each.select("doc_id", "row_key", "pos", "raw", F.posexplode(_parts(F.col("raw"), F.col("names"))).alias("part", "entity"))
    parts = materialise(parts.select("doc_id", "row_key", "pos", "raw", "part", "entity.kind", "entity.canon"), "parts")
    known = materialise(assign(materialise(parts.select("kind", "canon").distinct(), "entities"), secret), "dictionary")
    placed = (
        parts.join(known, ["kind", "canon"])
        .groupBy("doc_id", "row_key", "pos", "raw")
        .agg(F.sort_array(F.collect_list(F.struct("part", "surrogate"))).alias("parts"))
        .withColumn("new", rendered(F.col("raw"), F.col("parts.surrogate")))
        .groupBy("doc_id", "row_key")
        .agg(F.sort_array(F.collect_list(F.struct("pos", "new"))).alias("news"))
        .select(F.col("doc_id").alias("of_id"), F.col("row_key").alias("of_key"), F.col("news.new").alias("new"))
    )
    # The patterns of bare names are joined narrow, without the entities they were found with.
    patterns = found.where(F.col("bare").isNotNull()).select(F.col("doc_id").alias("p_id"), F.col("row_key").alias("p_key"), "bare")
    placed = placed.join(patterns, F.col("of_id").eqNullSafe(F.col("p_id")) & (F.col("of_key") == F.col("p_key")), "left").drop("p_id", "p_key")
    rows = id_and_text(docs, id_col, text_col).withColumn("row_key", F.xxhash64("text", "doc_id"))
    same = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("row_key") == F.col("of_key"))
    between = F.when(F.col("bare").isNull(), F.split("text", ENTITY, -1)).otherwise(
        F.split("text", F.concat(F.lit(ENTITY), F.col("bare")), -1)
    )
    joined = F.array_join(
        F.zip_with(between, F.concat("new", F.array(F.lit(""))), lambda a, b: F.concat(a, b)), ""
    )
    # A broadcast of the documents with entities would fit small corpora only, so texts are always dealt out.
    return rows.join(materialise(placed, "placed").hint("merge"), same, "left").select(
        "doc_id",
        F.when(F.col("new").isNull(), F.col("text")).otherwise(joined).alias("text"),
        F.coalesce(F.size("new"), F.lit(0)).cast("long").alias("n_entities"),
    )
