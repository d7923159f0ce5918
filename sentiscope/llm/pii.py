"""Operator 5: personal data replaced by keyed surrogates.

Detected kinds: e-mail addresses, IPv4 addresses, phone numbers, card numbers, and names
after a title.  An entity's canonical form (lower case; digits only for numbers) and a
secret key give its surrogate, so every mention of one entity, in any document and any
format, gets the same one (coreference), and each mention keeps its own format:

* e-mail: letters become letters, digits digits; separators and the top-level domain stay
  (one without letters or digits before that domain gets eight letters on both sides);
* IPv4: four new numbers from 0 to 255; phone and card: new digits in the old places, a
  country code and a card's first digit stay;
* names: the title stays and gives the gender; the given name comes from a list of that
  gender and script, the last name from syllables of that script.

Collision checks: over the table of distinct entities, a surrogate that equals another
entity's surrogate or any real entity is drawn again with the next attempt number, round by
round, until all differ.  A surrogate grows with the attempts - by a syllable, letter, digit
or number every few rounds - so the room of every shape is unbounded and the rounds end
whatever the number of entities.  Only mentions and entities are shuffled, and the texts of
rows that have a mention, by text digest; all steps are built-in functions.

Defined results: a null text stays null, a text without mentions stays as it is; repeated
rows are treated alike; an empty table gives no rows.  Other columns are kept and cannot
clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentiscope.llm.common import fresh_name, materialise, text_key, text_or_empty

KEY = "surrogate-key-1"

# Patterns in order of precedence, and the titles by gender.
EMAIL = "(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]+\\.)+[A-Za-z]{2,}"
IPV4 = "(?<![0-9.])(?:[0-9]{1,3}\\.){3}[0-9]{1,3}(?![0-9])"
PHONE = "(?:\\+[0-9]{1,3}[ .-]?)?(?:\\([0-9]{3}\\)|(?<![0-9])[0-9]{3})[ .-]?[0-9]{3}[ .-][0-9]{4}(?![0-9])"
CARD = "(?<![0-9])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![0-9])"
FEMALE = "Mrs|Ms|Miss|Frau|Mme|Madame|Sra|Señora|Г-жа|Κα"
MALE = "Mr|Herr|M|Monsieur|Sr|Señor|Г-н|Κος"
# a capital, then letters, and apostrophes and hyphens between letters, but no possessive s
NAME = "\\p{Lu}(?:[\\p{L}\\p{M}]|(?!['’]s(?!\\p{L}))['’-](?=\\p{L}))+"
PERSON = f"(?<![\\p{{L}}])(?:{FEMALE}|{MALE})\\.? {NAME}(?: {NAME})?"
ANY = "|".join((EMAIL, IPV4, PHONE, CARD, PERSON))
GIVEN = {
    "latin": ("Anna Clara Emma Julia Laura Maria Nora Sara".split(), "Adam David Felix Jonas Lucas Martin Oscar Paul".split()),
    "cyrillic": ("Анна Вера Дарья Елена Ирина Мария Нина Ольга".split(), "Антон Борис Виктор Иван Максим Олег Павел Роман".split()),
    "greek": ("Άννα Δάφνη Ελένη Ζωή Ιωάννα Μαρία Νίκη Σοφία".split(), "Άγγελος Γιώργος Ηλίας Κώστας Μάριος Νίκος Πέτρος Σπύρος".split()),
}
SYLLABLES = {
    "latin": "ba den fo gar hel ka lin mo nor pel ro san tol ver wes zin".split(),
    "cyrillic": "ба вен го дар зел ка лин мо нов пет ро сан тол вер ким зин".split(),
    "greek": "βα δεν γο καρ λεν μα νιδ πο ρον σαλ τιν φο χαρ ζελ κον μιρ".split(),
}


def kind_of(mention: Column) -> Column:
    return (F.when(mention.contains("@"), "email").when(mention.rlike(f"^{IPV4}$"), "ipv4")
            .when(mention.rlike("\\p{L}"), "person").when(mention.rlike(f"^{PHONE}$"), "phone").otherwise("card"))


def _digits(mention: Column) -> Column:
    return F.regexp_replace(mention, "[^0-9]", "")


def canonical(kind: Column, mention: Column) -> Column:
    return (F.when(kind.isin("phone", "card"), _digits(mention))
            .when(kind == "person", F.lower(F.translate(mention, "’.", "'"))).otherwise(F.lower(mention)))


def _number(stream: Column, at: Column) -> Column:
    """A number below 65536 from the digest stream (64 of them, repeated)."""
    return F.conv(F.substring(stream, (at % 64) * 4 + 1, F.lit(4)), 16, 10).cast("int")


def _pick(words, n: Column) -> Column:
    return F.get(F.array(*[F.lit(w) for w in words]), n % len(words))


def _spelled(entity: Column, stream: Column, first: Column) -> Column:
    """Digits to digits and letters to letters from place ``first`` on; other characters stay."""
    letters = F.lit("abcdefghijklmnopqrstuvwxyz")
    return F.array_join(F.transform(F.split(entity, ""), lambda c, i: F.when(i < first, c)
                        .when(c.rlike("[0-9]"), (_number(stream, i) % 10).cast("string"))
                        .when(c.rlike("[a-z]"), F.substring(letters, _number(stream, i) % 26 + 1, F.lit(1))).otherwise(c)), "")


def _letters(stream: Column, n: Column, skip: int) -> Column:
    """``n`` new letters, from number ``skip`` of the stream on."""
    letters = F.lit("abcdefghijklmnopqrstuvwxyz")
    places = F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))
    return F.array_join(F.transform(places, lambda i: F.substring(letters, _number(stream, i + skip) % 26 + 1, F.lit(1))), "")


def _email(entity: Column, stream: Column, more: Column) -> Column:
    """New letters and digits in the old places, and ``more`` letters after the local part."""
    kept = F.regexp_extract(entity, "(\\.[^.]*)$", 1)
    spelled = _spelled(F.regexp_extract(entity, "^(.*)\\.[^.]*$", 1), stream, F.lit(0))
    grown = F.concat(F.regexp_extract(spelled, "^([^@]*)@", 1), _letters(stream, more, 31), F.regexp_extract(spelled, "(@.*)$", 1))
    made = F.concat(_letters(stream, F.lit(8) + more, 0), F.lit("@"), _letters(stream, F.lit(8), 40))
    return F.concat(F.when(spelled.rlike("[a-z0-9]"), grown).otherwise(made), kept)


def _name(entity: Column, stream: Column, more: Column) -> Column:
    """A new canonical name: the title, a given name if there was one, a last name of four syllables and ``more``."""
    parts = F.split(entity, " ")
    female = F.get(parts, F.lit(0)).rlike(f"(?i)^(?:{FEMALE})$")

    def of_script(script):
        women, men = GIVEN[script]
        given = F.when(female, _pick(women, _number(stream, F.lit(0)))).otherwise(_pick(men, _number(stream, F.lit(0))))
        last = F.initcap(F.array_join(F.transform(
            F.sequence(F.lit(1), F.lit(4) + more), lambda i: _pick(SYLLABLES[script], _number(stream, i))), ""))
        return F.when(F.size(parts) > 2, F.concat_ws(" ", given, last)).otherwise(last)

    name = F.element_at(parts, -1)
    new = F.when(name.rlike("\\p{IsCyrillic}"), of_script("cyrillic")).when(name.rlike("\\p{IsGreek}"), of_script("greek"))
    return F.concat_ws(" ", F.get(parts, F.lit(0)), new.otherwise(of_script("latin")))


def surrogate(kind: Column, entity: Column, attempt: Column, key: str = KEY) -> Column:
    """Surrogate of a canonical entity, in canonical form (names keep capitals)."""
    seed = F.concat_ws("\x1f", F.lit(key), kind, entity, attempt.cast("string"))
    stream = F.concat(F.sha2(seed, 512), F.sha2(F.concat(seed, F.lit("+")), 512))
    soon, late = F.floor(attempt / 2).cast("int"), F.floor(attempt / 4).cast("int")
    octets = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(3) + late), lambda i: (_number(stream, i) % 256).cast("string")), ".")
    country = F.when(kind == "card", F.lit(1)).otherwise(F.greatest(F.length(entity) - 10, F.lit(0)))
    return (F.when(kind == "email", _email(entity, stream, soon)).when(kind == "ipv4", octets)
            .when(kind == "person", _name(entity, stream, soon))
            .otherwise(_spelled(F.concat(entity, F.repeat(F.lit("0"), late)), stream, country)))


def surrogate_table(entities: DataFrame, key: str = KEY) -> DataFrame:
    """``kind, entity`` -> plus ``new``: distinct per kind, and no real entity."""
    left = entities.withColumn("attempt", F.lit(0))
    done = None
    while True:
        drawn = materialise(left.withColumn("new", surrogate(F.col("kind"), F.col("entity"), F.col("attempt"), key)), "drawn")
        claims = drawn.groupBy("kind", "new").agg(F.min("entity").alias("owner"))
        real = entities.select(F.col("kind").alias("k"), F.col("entity").alias("e"))
        judged = (drawn.join(claims, ["kind", "new"])
                  .join(real, (F.col("kind") == F.col("k")) & (F.lower("new") == F.col("e")), "left"))
        if done is not None:
            used = done.select(F.col("kind").alias("k2"), F.col("new").alias("n2"))
            judged = judged.join(used, (F.col("kind") == F.col("k2")) & (F.col("new") == F.col("n2")), "left")
        else:
            judged = judged.withColumn("n2", F.lit(None).cast("string"))
        judged = materialise(judged.withColumn(
            "ok", (F.col("owner") == F.col("entity")) & F.col("e").isNull() & F.col("n2").isNull()).select(
            "kind", "entity", "attempt", "new", "ok"), "judged")
        good = judged.where("ok").select("kind", "entity", "new")
        done = good if done is None else done.unionByName(good)
        left = judged.where(~F.col("ok")).select("kind", "entity", (F.col("attempt") + 1).alias("attempt"))
        if left.isEmpty():
            return done


def render(kind: Column, mention: Column, new: Column) -> Column:
    """The surrogate in the mention's format."""
    digit = F.split(new, "")
    before = F.transform(F.split(mention, ""), lambda c, i: F.struct(
        c.alias("c"), F.length(_digits(F.substring(mention, F.lit(1), i))).alias("n")))
    filled = F.array_join(F.transform(before, lambda x: F.when(x.c.rlike("[0-9]"), F.get(digit, x.n)).otherwise(x.c)), "")
    filled = F.concat(filled, F.substring(new, F.length(_digits(mention)) + 1, F.length(new)))  # digits that it has grown
    title = F.regexp_extract(mention, "^([^ ]*) ", 1)
    cased = F.when((mention == F.upper(mention)) & (mention != F.lower(mention)), F.upper(new)).otherwise(new)
    return (F.when(kind.isin("phone", "card"), filled)
            .when(kind == "person", F.concat_ws(" ", title, F.regexp_replace(new, "^[^ ]* ", ""))).otherwise(cased))


def replace_personal_data(docs: DataFrame, *, text_col: str = "text", key: str = KEY, count_col: str = "n_entities") -> DataFrame:
    """``docs`` with every mention replaced, plus the number of mentions as last column: ``count_col``, longer if ``docs`` has that."""
    count_col = fresh_name(docs, count_col)
    digest, cuts = fresh_name(docs, "_key"), fresh_name(docs, "_cuts")
    own = [F.col(f"`{c}`") for c in docs.columns]
    text = text_or_empty(text_col)
    some = docs.where(text.rlike(ANY)).withColumn(digest, text_key(text))
    rest = docs.where(~text.rlike(ANY)).select(*own, F.lit(0).cast("long").alias(count_col))
    mentions = some.select(F.col(digest).alias("k"), F.posexplode(F.regexp_extract_all(text, F.lit(ANY), F.lit(0))).alias("i", "m"))
    mentions = mentions.withColumn("kind", kind_of(F.col("m")))
    mentions = materialise(mentions.withColumn("entity", canonical(F.col("kind"), F.col("m"))).distinct(), "mentions")
    table = materialise(surrogate_table(mentions.select("kind", "entity").distinct(), key), "surrogates")
    rendered = mentions.join(table, ["kind", "entity"]).withColumn("r", render(F.col("kind"), F.col("m"), F.col("new")))
    by_text = rendered.groupBy(F.col("k").alias(digest)).agg(F.sort_array(F.collect_list(F.struct("i", "r"))).alias(cuts))
    pieces, new = F.split(text, ANY), F.concat(F.col(cuts)["r"], F.array(F.lit("")))
    joined = some.join(by_text, digest).withColumn(count_col, F.size(cuts).cast("long")).withColumn(
        text_col, F.array_join(F.zip_with(pieces, new, lambda p, r: F.concat(p, r)), ""))
    return rest.unionByName(joined.select(*own, count_col))
