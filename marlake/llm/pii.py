"""Surrogates for personal data, in DataFrame functions only.

Every detected entity is replaced by another one of its kind, drawn from a keyed hash of the
entity: the same entity gets the same surrogate in all documents, two entities never share one, and no surrogate
is itself an entity of the texts (a drawn name is no given or family name found in its script). Format is kept: letters stay letters of their script and case, digits
digits, separators where they were; cards keep their check digit right, addresses their
top-level domain, phone numbers their country code. A given name keeps the gender that its titles
tell over all documents; where none does, or two differ, it gets a name of any gender.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlake.session import stage

# Titles that tell a gender; fixed values.
MALE = ["Mr", "Herr", "Monsieur", "Señor", "Sr", "господин", "Господин", "κύριος", "Κύριος"]
FEMALE = ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Mademoiselle", "Señora", "Señorita", "Sra", "госпожа", "Госпожа", "κυρία", "Κυρία"]
NEUTRAL = ["Dr", "Prof"]
# Given names by script and gender; fixed values.
GIVEN = {
    ("latin", "m"): "Adam Bruno Carlos David Edgar Felix Georg Hugo Ivan Jonas Karl Lukas Martin Nico Oscar Paul Robert Simon Thomas Victor".split(),
    ("latin", "f"): "Anna Bella Clara Diana Emma Flora Greta Helena Irene Julia Karla Laura Maria Nora Olga Paula Rosa Sofia Teresa Vera".split(),
    ("latin", "n"): "Alex Andrea Charlie Dominique Eden Francis Jamie Jean Jordan Kim Leslie Morgan Noel Pat Robin Sam Sasha Taylor Toni Val".split(),
    ("cyrillic", "m"): "Андрей Борис Виктор Глеб Денис Егор Захар Игорь Кирилл Леонид Максим Никита Олег Павел Роман Сергей".split(),
    ("cyrillic", "f"): "Анна Вера Галина Дарья Елена Жанна Зоя Ирина Ксения Лидия Мария Нина Ольга Полина Раиса Светлана".split(),
    ("greek", "m"): "Αλέξης Βασίλης Γιώργος Δημήτρης Ηλίας Κώστας Λεωνίδας Μανώλης Νίκος Πέτρος Σπύρος Φώτης".split(),
    ("greek", "f"): "Άννα Βασιλική Γεωργία Δήμητρα Ελένη Ζωή Ιωάννα Κατερίνα Μαρία Νίκη Σοφία Χρύσα".split(),
}
# Syllables that family names are made of, by script; fixed values.
SYLLABLES = {
    "latin": "ba be bo da de do fa fe ga go ha ho ka ke ko la le lo ma me mo na ne no pa po ra re ro sa so ta".split(),
    "cyrillic": "ба бе бо ва ве во га го да де до жа за зо ка ко ла ле ло ма ме мо на не но па по ра ре ро са та".split(),
    "greek": "βα βε γα γο δα δε δο ζα θε κα κο λα λε λο μα με μο να νε νο πα πο ρα ρο σα σο τα τε τα φα φο χα".split(),
}
LETTERS = {
    "[a-z]": "abcdefghijklmnopqrstuvwxyz",
    "[A-Z]": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "[0-9]": "0123456789",
    "[а-яё]": "абвгдежзийклмнопрстуфхцчшщъыьэюя",
    "[А-ЯЁ]": "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ",
    "[α-ω]": "αβγδεζηθικλμνξοπρστυφχψω",
    "[Α-Ω]": "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ",
    "[ß-öø-ÿ]": "àáâäçèéêëíîïñóôöùúûü",
    "[À-ÖØ-Þ]": "ÀÁÂÄÇÈÉÊËÍÎÏÑÓÔÖÙÚÛÜ",
}

NAME_WORD = r"\p{Lu}[\p{L}'’-]+"
TITLES = "|".join(MALE + FEMALE + NEUTRAL)
TITLE = rf"(?:{TITLES})\.?(?: (?:{'|'.join(NEUTRAL)})\.?)*"
OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
# What stands before the value of a named secret.
NAMED = r"(?:password|passwd|pwd|secret|api_?key|(?:access_?|auth_?)?token|bearer)[\"']?[ \t]{0,2}[=:][ \t]{0,2}[\"']?(?:bearer[ \t]{1,2})?"
BEARER = r"bearer[ \t]{1,2}"
VALUE = r"[^\s\"',;]"
# Kinds in the order in which they are tried at a place.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)*\.\p{L}{2,24}",
    "key": r"\bAKIA[0-9A-Z]{16}\b",
    "secret": rf"(?<![\p{{L}}\p{{N}}])(?:(?i:{NAMED}){VALUE}{{4,}}|(?i:{BEARER})(?={VALUE}*[0-9]){VALUE}{{16,}})",
    "hex": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,}|[0-9A-F]{32,})(?![0-9A-Za-z])",
    "ipv4": rf"(?<![0-9.])(?:{OCTET}\.){{3}}{OCTET}(?![0-9]|\.[0-9])",
    "phone": r"(?<![\p{L}\p{N}+])(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])|(?<![\p{L}\p{N}+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])|(?<![\p{L}\p{N}+.-])(?:1[ .-])?(?:[0-9]{3}-[0-9]{3}-|[0-9]{3}\.[0-9]{3}\.|[0-9]{3} [0-9]{3} )[0-9]{4}(?![0-9]|[.-][0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "card": r"(?<![0-9.-])[3-6][0-9]{3}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,4}(?![0-9-])",
    "name": rf"(?<![\p{{L}}\p{{N}}]){TITLE} {NAME_WORD}(?: {NAME_WORD})*",
}
ANY = "|".join(PATTERNS.values())
ATTEMPTS = 40


def kind_of(found: Column) -> Column:
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(PATTERNS.items()):
        kind = F.when(found.rlike(f"^(?:{pattern})$"), name).otherwise(kind)
    return kind


def script_of(word: Column) -> Column:
    return F.when(word.rlike(r"\p{IsCyrillic}"), "cyrillic").when(word.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def parts_of(kind: Column, found: Column) -> Column:
    """The entities inside a match, as an array of (type, name of the entity, gender its title tells).

    Of several words of a name, the last is the family name and the others are given names.
    """
    digits = F.regexp_replace(found, "[^0-9]", "")
    title = F.regexp_extract(found, rf"^({TITLES})(?![\p{{L}}])", 1)
    gender = F.when(title.isin(MALE), "m").when(title.isin(FEMALE), "f")
    names = F.split(F.lower(F.regexp_replace(found, rf"^{TITLE} ", "")), " ")
    script = script_of(names[0])

    def one(t: Column, c: Column) -> Column:
        return F.struct(t.alias("type"), c.alias("name"), F.lit(None).cast("string").alias("gender"))

    given = F.transform(
        F.slice(names, F.lit(1), F.size(names) - 1), lambda n: F.struct(F.concat(F.lit("given:"), script).alias("type"), n.alias("name"), gender.alias("gender"))
    )
    family = one(F.concat(F.lit("family:"), script), F.element_at(names, -1))
    return (
        F.when(kind == "name", F.concat(given, F.array(family)))
        .when(kind == "email", F.array(one(kind, F.lower(found))))
        .when(kind.isin("phone", "card", "ssn"), F.array(one(kind, digits)))
        .when(kind == "secret", F.array(one(F.lit("token"), secret_value(found))))
        .when(kind.isin("hex", "key"), F.array(one(F.lit("token"), found)))
        .otherwise(F.array(one(kind, found)))
    )


def secret_value(found: Column) -> Column:
    return F.regexp_extract(found, rf"^(?i:{NAMED}|{BEARER})(.*)$", 1)


def stream(key: str) -> Column:
    """Bytes of the keyed hash of (type, name, attempt), as 128 hex digits."""
    seed = F.concat_ws("\x1f", F.lit(key), F.col("type"), F.col("name"), F.col("attempt").cast("string"))
    return F.concat(F.sha2(seed, 256), F.sha2(F.concat(seed, F.lit("\x1f+")), 256))


def byte(i: Column) -> Column:
    """Byte ``i`` (from 0, going round) of the column ``_s``."""
    return F.conv(F.substr(F.col("_s"), (i % 63) * 2 + 1, F.lit(3)), 16, 10).cast("int")


def drawn(text: Column, letters: dict[str, str] = LETTERS) -> Column:
    """Each letter or digit exchanged for one of its class; anything else stays."""

    def other(c: Column, i: Column) -> Column:
        out = c
        for pattern, own in letters.items():
            out = F.when(c.rlike(pattern), F.substr(F.lit(own), byte(i) % len(own) + 1, F.lit(1))).otherwise(out)
        return out

    return F.array_join(F.transform(F.split(text, ""), other), "")


def with_check_digit(digits: Column) -> Column:
    """Digits whose last one is set so that the Luhn sum is a multiple of ten."""
    n = F.length(digits)
    doubled = F.transform(
        F.sequence(F.lit(1), n - 1),
        lambda i: F.when((n - i) % 2 == 1, luhn_twice(F.substr(digits, i, F.lit(1)).cast("int"))).otherwise(F.substr(digits, i, F.lit(1)).cast("int")),
    )
    total = F.aggregate(doubled, F.lit(0), lambda a, x: a + x)
    return F.concat(F.substr(digits, F.lit(1), n - 1), ((F.lit(10) - total % 10) % 10).cast("string"))


def luhn_twice(d: Column) -> Column:
    return F.when(d > 4, d * 2 - 9).otherwise(d * 2)


def surrogate(key: str) -> Column:
    """The surrogate of the entity (type, name) at the current attempt; needs the column ``_s``.

    From the eighth attempt on, where a short format may have no value left, letters or digits are added.
    """
    name, kind, i0 = F.col("name"), F.col("type"), F.lit(0)
    top = F.regexp_extract(name, r"(\.[^.@]+)$", 1)
    email = F.concat(drawn(F.regexp_replace(name, r"\.[^.@]+$", "")), top)
    octets = F.transform(
        F.split(name, r"\."),
        lambda o, i: F.when(F.length(o) == 1, byte(i) % 9 + 1).when(F.length(o) == 2, byte(i) % 90 + 10).otherwise(byte(i) % 155 + 100).cast("string"),
    )
    all_digits = drawn(name)
    card = F.concat(F.substr(name, F.lit(1), F.lit(1)), F.substr(all_digits, F.lit(2)))
    card = F.when(with_check_digit(name) == name, with_check_digit(card)).otherwise(card)
    country = F.greatest(F.length(name) - 10, i0)
    phone = F.concat(F.substr(name, F.lit(1), country), ((byte(i0) % 8) + 2).cast("string"), F.substr(all_digits, country + 2))
    hexes = drawn(name, {"[a-f]": "abcdef", "[A-F]": "ABCDEF", "[0-9]": "0123456789"})
    keys = F.concat(F.lit("AKIA"), F.substr(drawn(name), F.lit(5)))
    out = (
        F.when(kind == "email", email)
        .when(kind == "ipv4", F.array_join(octets, "."))
        .when(kind == "card", card)
        .when(kind == "phone", phone)
        .when((kind == "token") & name.rlike("^([0-9a-f]+|[0-9A-F]+)$"), hexes)
        .when((kind == "token") & name.rlike("^AKIA[0-9A-Z]{16}$"), keys)
        .otherwise(drawn(name))
    )
    for (script, gender), names in GIVEN.items():
        genders = [gender] if script == "latin" or gender == "f" else ["m", "n"]
        pick = F.element_at(F.array(*map(F.lit, names)), (byte(i0) * 256 + byte(F.lit(9))) % len(names) + 1)
        more = F.when(F.col("attempt") > 0, family_name(script, F.lit(1) + F.col("attempt") / 4)).otherwise("")
        pick = F.when(F.col("attempt") > 0, F.concat(pick, F.lit("-"), F.initcap(more))).otherwise(pick)
        out = F.when((kind == f"given:{script}") & F.col("gender").isin(genders), F.lower(pick)).otherwise(out)
    for script in SYLLABLES:
        out = F.when(kind == f"family:{script}", family_name(script, F.lit(3) + F.col("attempt") / 4)).otherwise(out)
    longer = F.col("attempt") >= 8
    digits = F.conv(F.substr(F.col("_s"), F.lit(1), F.lit(8)), 16, 10)
    out = F.when(longer & kind.isin("phone", "card", "ssn"), F.concat(out, digits)).when(
        longer & kind.isin("email"), F.concat(F.substr(F.col("_s"), F.lit(1), F.lit(8)), out)
    ).when(longer & kind.isin("token"), F.concat(out, F.substr(F.col("_s"), F.lit(1), F.lit(8)))).otherwise(out)
    return out


def family_name(script: str, n: Column) -> Column:
    parts = F.array(*map(F.lit, SYLLABLES[script]))
    return F.array_join(F.transform(F.sequence(F.lit(1), n.cast("int")), lambda i: F.element_at(parts, byte(i * 2) % len(SYLLABLES[script]) + 1)), "")


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(type, name, surrogate) for distinct entities (type, name, gender); no surrogate twice within a type, none the name of an entity.

    All entities draw at once; those whose draw is taken draw again with the next attempt (the smallest
    name keeps it). Every round works on what the last one left.
    """
    # A given name must not be drawn that somebody has as a family name, and the other way round.
    scope = F.regexp_replace("type", "^(given|family):", "name:").alias("scope")
    taken = stage(entities.select(scope, F.col("name").alias("surrogate")).distinct().withColumn("_real", F.lit(True)), "names")
    todo, done = entities.withColumn("attempt", F.lit(0)), None
    for attempt in range(ATTEMPTS):
        drawn_now = todo.withColumn("attempt", F.lit(attempt)).withColumn("_s", stream(key)).withColumn("surrogate", surrogate(key)).drop("_s")
        drawn_now = stage(drawn_now, "draws")
        first = drawn_now.groupBy("type", "surrogate").agg(F.min("name").alias("_first"))
        marked = drawn_now.join(first, ["type", "surrogate"])
        marked = marked.withColumn("scope", scope).join(taken, ["scope", "surrogate"], "left").drop("scope")
        if done is not None:
            marked = marked.join(done.select("type", "surrogate", F.lit(True).alias("_taken")), ["type", "surrogate"], "left")
        else:
            marked = marked.withColumn("_taken", F.lit(None).cast("boolean"))
        free = (F.col("name") == F.col("_first")) & F.col("_real").isNull() & F.col("_taken").isNull()
        marked = stage(marked.select("type", "name", "gender", "surrogate", free.alias("_free")), "draws")
        won = marked.where("_free").select("type", "name", "surrogate")
        done = won if done is None else done.unionByName(won)
        todo = marked.where("not _free").select("type", "name", "gender", F.lit(attempt).alias("attempt"))
        if todo.limit(1).count() == 0:
            return done
    raise RuntimeError(f"entities without a free surrogate after {ATTEMPTS} draws")


def rendered() -> Column:
    """The replacement of a match: surrogates ``_subs`` put into the format of ``found``."""
    subs, found, kind = F.col("_subs"), F.col("found"), F.col("kind")
    one = subs[0]
    chars = F.split(found, "")
    # The k-th digit of the match takes the k-th digit of the surrogate; more digits follow at the end.
    n_digits = F.length(F.regexp_replace(found, "[^0-9]", ""))
    put = F.transform(
        chars,
        lambda c, i: F.when(c.rlike("[0-9]"), F.substr(one, F.length(F.regexp_replace(F.substr(found, F.lit(1), i + 1), "[^0-9]", "")), F.lit(1))).otherwise(c),
    )
    by_digit = F.concat(F.array_join(put, ""), F.substr(one, n_digits + 1))
    cased = F.when(
        F.length(one) == F.length(found),
        F.array_join(F.transform(F.split(one, ""), lambda c, i: F.when(F.substr(found, i + 1, F.lit(1)).rlike(r"\p{Lu}"), F.upper(c)).otherwise(c)), ""),
    ).otherwise(one)
    title = F.regexp_extract(found, rf"^({TITLE} )", 1)
    shout = F.substr(found, F.length(title) + 1, F.lit(2)).rlike(r"^\p{Lu}\p{Lu}")
    names = F.array_join(F.transform(subs, lambda s: F.when(shout, F.upper(s)).otherwise(F.initcap(s))), " ")
    value = secret_value(found)
    return (
        F.when(kind == "name", F.concat(title, names))
        .when(kind.isin("phone", "card", "ssn"), by_digit)
        .when(kind == "email", cased)
        .when(kind == "secret", F.concat(F.substr(found, F.lit(1), F.length(found) - F.length(value)), one))
        .otherwise(one)
    )


def replace_personal_data(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with the personal data in ``text_col`` replaced; two columns are added.

    ``pii_found`` is the number of replaced matches, ``pii_kinds`` the sorted kinds. Found are e-mail
    addresses, access keys, named secrets and bearer tokens of any length, hex secrets of 32 digits or more, IPv4 addresses, phone numbers,
    US social security numbers, card numbers, and names after a title. Spellings of one entity
    (letter case, separators) share a surrogate.

    Only documents with a match are written and joined; the others pass through. Occurrences are
    joined with the table of distinct entities, where an entity that a third of the documents hold is split by the adaptive
    join. Null and empty texts have no match and stay as they are. All other columns, null or not, are carried
    unchanged; columns of ``docs`` named ``pii_found`` or ``pii_kinds`` are replaced.
    Repeated rows stay repeated. An empty table gives no rows.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = docs.drop("pii_found", "pii_kinds")
    names = docs.columns
    # A cheap test first: every pattern but a name needs a digit, an "@", "=" or ":".
    marks = text.rlike(f"[0-9@=:]|(?:{TITLES})") & text.rlike(ANY)
    plain = docs.where(~marks).withColumns({"pii_found": F.lit(0), "pii_kinds": F.array().cast("array<string>")})
    # The caller's columns are packed into one, so that none meets a column of this function.
    held = docs.where(marks).select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("doc"), F.col(text_col).alias("body"))
    held = stage(held.withColumn("row", F.monotonically_increasing_id()), "personal")
    each = held.select("row", F.posexplode(F.regexp_extract_all("body", F.lit(ANY), F.lit(0))).alias("pos", "found"))
    each = each.withColumn("kind", kind_of(F.col("found"))).where("kind is not null or found <> ''")
    each = each.withColumn("kind", F.coalesce("kind", F.lit("other")))
    each = each.select("row", "pos", "found", "kind", F.posexplode(parts_of(F.col("kind"), F.col("found"))).alias("k", "part"))
    parts = stage(each.select("row", "pos", "found", "kind", "k", "part.*"), "entities")
    told = F.when(F.min("gender") == F.max("gender"), F.min("gender"))
    gender = F.when(F.col("type").startswith("given:"), F.coalesce("gender", F.lit("n"))).alias("gender")
    entities = parts.groupBy("type", "name").agg(told.alias("gender")).select("type", "name", gender)
    # Draws cost much more than the few bytes of an entity, so these are dealt to all cores.
    spread = 2 * docs.sparkSession.sparkContext.defaultParallelism
    entities = stage(entities.repartition(spread, "type", "name"), "entities")
    mapping = stage(surrogates(entities, key), "surrogates")
    drawn_parts = parts.join(mapping, ["type", "name"])
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("k", "surrogate"))), lambda x: x["surrogate"])
    matches = drawn_parts.groupBy("row", "pos", "found", "kind").agg(ordered.alias("_subs")).withColumn("new", rendered())
    per_row = matches.groupBy("row").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("pos", "new"))), lambda x: x["new"]).alias("news"),
        F.count("*").cast("int").alias("pii_found"),
        F.array_sort(F.collect_set("kind")).alias("pii_kinds"),
    )
    between = F.split("body", ANY, -1)
    whole = F.array_join(F.zip_with(between, F.col("news"), lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    changed = held.join(per_row, "row").select(
        *[whole.alias(c) if c == text_col else F.col("doc").getField(c).alias(c) for c in names], "pii_found", "pii_kinds"
    )
    return plain.unionByName(changed)
