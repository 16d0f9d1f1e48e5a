"""Surrogates for personal data, on Spark expressions alone.

Entities found in texts get keyed replacements of their own kind.  The same
entity gets the same one everywhere, however it is written; two entities never
share one, and none equals a real entity of the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowlake.llm.blocks import stored

# Words that tell a name, by gender.
TITLES = {
    "f": "Mrs|Ms|Miss|Lady|Frau|Madame|Mme|Mademoiselle|Señora|Señorita|Sra|Doña|Signora|Госпожа|Κυρία",
    "m": "Mr|Mister|Sir|Lord|Herr|Monsieur|Señor|Sr|Signor|Господин|Κύριος",
    "n": "Dr|Prof|Doktor|Professor",
}
# Given names by gender: common ones of English, German, French, Spanish, Italian and
# some of other languages, Russian and Greek, without many that are words or places.
GIVEN = {
    "f": "Patricia|Jennifer|Elizabeth|Barbara|Susanne|Jessica|Margaret|Katharina|Ursula|Brigitte|Nathalie|"
    "Isabelle|Catherine|Guadalupe|Francisca|Mary|Linda|Susan|Sarah|Karen|Lisa|Nancy|Betty|Sandra|"
    "Ashley|Kimberly|Emily|Donna|Michelle|Amanda|Melissa|Deborah|Stephanie|Rebecca|Laura|Helen|Sharon|"
    "Cynthia|Kathleen|Amy|Angela|Shirley|Anna|Ruth|Brenda|Pamela|Nicole|Samantha|Katherine|Emma|"
    "Christine|Rachel|Carolyn|Janet|Maria|Diane|Olivia|Julie|Joyce|Victoria|Christina|Joan|Evelyn|"
    "Lauren|Judith|Megan|Cheryl|Hannah|Jacqueline|Martha|Gloria|Teresa|Ann|Sara|Frances|Kathryn|Janice|"
    "Abigail|Alice|Julia|Judy|Sophia|Denise|Doris|Marilyn|Danielle|Beverly|Theresa|Diana|Brittany|"
    "Natalie|Isabella|Charlotte|Kayla|Anne|Jane|Eleanor|Lucy|Chloe|Claire|Zoe|Fiona|Sophie|Mia|Ella|"
    "Amelia|Sabine|Petra|Monika|Heike|Claudia|Renate|Karin|Birgit|Gabriele|Ingrid|Helga|Erika|Christa|"
    "Gisela|Anja|Silke|Kerstin|Katrin|Jana|Lena|Leonie|Johanna|Franziska|Annika|Anke|Nadine|Jutta|Elke|"
    "Hannelore|Ilse|Gertrud|Greta|Heidi|Marie|Monique|Françoise|Sylvie|Martine|Valérie|Véronique|"
    "Sandrine|Céline|Aurélie|Chantal|Élodie|Hélène|Amélie|Juliette|Margaux|Mathilde|Pauline|Émilie|"
    "Geneviève|Colette|Carmen|Josefa|Ana|Lucía|Marta|Cristina|Paula|Elena|Raquel|Rocío|Beatriz|Silvia|"
    "Inés|Sofía|Alicia|Yolanda|Montserrat|Nuria|Verónica|Gabriela|Daniela|Valentina|Mariana|Fernanda|"
    "Luisa|Juana|Giulia|Chiara|Francesca|Federica|Giovanna|Paola|Caterina|Alessandra|Lucia|Ilaria|"
    "Elisa|Valeria|Ewa|Agnieszka|Katarzyna|Małgorzata|Joanna|Fatima|Aisha|Екатерина|Наталья|Светлана|"
    "Елена|Ольга|Татьяна|Ирина|Анна|Мария|Людмила|Галина|Юлия|Анастасия|Валентина|Марина|Оксана|Дарья|"
    "Ксения|Алла|Лариса|Полина|Алина|Виктория|Александра|Евгения|Тамара|Нина|Ελένη|Αικατερίνη|Μαρία|"
    "Κατερίνα|Βασιλική|Σοφία|Αγγελική|Γεωργία|Δήμητρα|Κωνσταντίνα|Παναγιώτα|Ειρήνη|Ευαγγελία|Άννα|"
    "Ιωάννα|Χριστίνα|Αναστασία|Αθηνά",
    "m": "Michael|William|Richard|Joseph|Charles|Christopher|Matthew|Wolfgang|Jürgen|Günther|Philippe|"
    "François|Laurent|Alejandro|Francisco|Guillermo|James|Robert|John|David|Thomas|Daniel|Anthony|"
    "Donald|Steven|Andrew|Paul|Joshua|Kenneth|Kevin|Brian|George|Timothy|Ronald|Jason|Edward|Jeffrey|"
    "Ryan|Jacob|Gary|Nicholas|Eric|Jonathan|Stephen|Larry|Justin|Scott|Brandon|Benjamin|Samuel|Gregory|"
    "Alexander|Patrick|Jack|Dennis|Jerry|Tyler|Aaron|Jose|Adam|Nathan|Henry|Zachary|Douglas|Peter|Kyle|"
    "Noah|Ethan|Jeremy|Walter|Keith|Roger|Terry|Sean|Gerald|Carl|Dylan|Harold|Jesse|Bryan|Lawrence|"
    "Arthur|Gabriel|Bruce|Billy|Joe|Alan|Juan|Elijah|Albert|Wayne|Randy|Vincent|Liam|Roy|Bobby|Caleb|"
    "Bradley|Russell|Lucas|Oliver|Harry|Simon|Martin|Ian|Neil|Graham|Stuart|Colin|Oscar|Steve|Mike|Tom|"
    "Jim|Dan|Tim|Tony|Matt|Ben|Fred|Ted|Luke|Philip|Hans|Klaus|Uwe|Dieter|Manfred|Helmut|Horst|Heinz|"
    "Bernd|Jörg|Ralf|Rainer|Frank|Stefan|Andreas|Matthias|Markus|Sebastian|Tobias|Florian|Jan|Lukas|"
    "Felix|Jonas|Maximilian|Niklas|Karl|Friedrich|Heinrich|Johannes|Gerhard|Werner|Kurt|Otto|Fritz|"
    "Ernst|Ulrich|Volker|Holger|Thorsten|Torsten|Dirk|Sven|Lars|Björn|Christoph|Günter|Johann|Pierre|"
    "Michel|André|Alain|Bernard|Jacques|Gérard|Christophe|Nicolas|Julien|Frédéric|Stéphane|Sébastien|"
    "Olivier|Thierry|Pascal|Éric|Marc|Guillaume|Antoine|Mathieu|Maxime|Alexandre|Louis|Hugo|Étienne|"
    "Luc|Yves|Didier|René|Benoît|Jérôme|José|Antonio|Manuel|Javier|Carlos|Miguel|Ángel|Pedro|Rafael|"
    "Fernando|Luis|Sergio|Pablo|Jorge|Alberto|Álvaro|Diego|Adrián|Raúl|Enrique|Ramón|Vicente|Andrés|"
    "Joaquín|Eduardo|Víctor|Jaime|Ignacio|Mario|Rubén|Óscar|Jesús|Ricardo|Roberto|Giuseppe|Giovanni|"
    "Francesco|Luigi|Angelo|Vincenzo|Pietro|Salvatore|Franco|Paolo|Marco|Matteo|Lorenzo|Alessandro|"
    "Stefano|Andrzej|Piotr|Krzysztof|Tomasz|João|Mohammed|Muhammad|Ahmed|Ali|Omar|Hassan|Александр|"
    "Дмитрий|Владимир|Сергей|Андрей|Алексей|Иван|Михаил|Николай|Евгений|Максим|Виктор|Юрий|Олег|Павел|"
    "Игорь|Денис|Антон|Константин|Анатолий|Василий|Борис|Григорий|Пётр|Кирилл|Илья|Артём|Никита|Фёдор|"
    "Георгий|Леонид|Γεώργιος|Κωνσταντίνος|Γιώργος|Δημήτριος|Δημήτρης|Ιωάννης|Γιάννης|Νικόλαος|Νίκος|"
    "Κώστας|Παναγιώτης|Βασίλειος|Βασίλης|Χρήστος|Αθανάσιος|Μιχαήλ|Ευάγγελος|Σπύρος|Αντώνιος|Αναστάσιος|"
    "Θεόδωρος|Ανδρέας|Στέλιος|Πέτρος|Σταύρος|Αλέξανδρος",
    "n": "Andrea|Jean|Jordan|Kelly|Alexis|Morgan|Robin|Jamie|Casey|Jessie|Alex|Sam|Chris|Camille|Claude|"
    "Dominique|Kim|Sasha|Саша|Женя",
}

# Syllables of made-up names by script, and their endings by gender
# (of given names) or "s" (surnames).
SYLLABLES = {
    "latin": "ba be bo da de do fa fi ga ka ke la le li lo ma me mi na ne no pa ra re ri ro sa se ta ti va ve",
    "cyrillic": "ба бе бо да де до фа фи га ка ке ла ле ли ло ма ме ми на не но па ра ре ри ро са се та ти ва ве",
    "greek": "βα βε βο δα δε δο φα φι γα κα κε λα λε λι λο μα με μι να νε νο πα ρα ρε ρι ρο σα σε τα τι ζα ζε",
}
ENDINGS = {
    "latin": {"f": "lia ria na", "m": "lan ron mir", "n": "len rin mel", "s": "son berg mann"},
    "cyrillic": {"f": "лия рия на", "m": "лан рон мир", "n": "лен рин мел", "s": "ский енко ович"},
    "greek": {"f": "λια ρια να", "m": "λος ρος νος", "n": "λις ρις νις", "s": "ίδης όπουλος άκης"},
}

def _branched(names: list[str]) -> str:
    """Pattern of any of ``names``, told apart by their first letters, so that a
    word is tried against few of them; longer ones first."""
    heads: dict[str, list[str]] = {}
    for name in sorted(set(names), key=lambda name: (-len(name), name)):
        heads.setdefault(name[:1], []).append(name[1:])
    if len(names) < 5:
        return "(?:" + "|".join(sorted(set(names), key=lambda name: (-len(name), name))) + ")"
    return "(?:" + "|".join(head + _branched(rests) for head, rests in sorted(heads.items())) + ")"


# What an entity looks like.  Order decides where two would start
# at the same place.
# Patterns read forwards only: looking back from every character is slow.  A label
# or title is matched with what it announces, and told apart afterwards.
# A possessive ending is no part of a name.
_NAME = r"\p{Lu}(?:\p{L}|-(?=\p{L})|['’](?!s\b)(?=\p{L})){1,30}"
_TITLE = "(?:" + "|".join([*TITLES.values(), *map(str.upper, TITLES.values())]) + ")"
# Most titles in small letters are words; these are not, before a full stop.
_LOWER_TITLE = r"(?:mr|mrs|ms)\. "
_FIRST = _branched("|".join(GIVEN.values()).split("|"))
_LABEL = r"(?i:password|passwd|pwd|secret|token|api_?key) ?[=:] ?[\"']?"
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63})+",
    # Marks alone are a form to fill in or a rule, not a secret.
    "secret": rf"\b{_LABEL}(?=[+/_.~-]*[A-Za-z0-9])[A-Za-z0-9+/_.~-]{{5,}}[A-Za-z0-9+/_~-]"
    r"|\bAKIA[0-9A-Z]{16}\b|\b(?=[a-f]*\d)[0-9a-f]{32,64}\b",
    "iban": r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?\b",
    "phone": r"(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]\d{3,4}\b|\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}\b"
    r"|\b\d{3}[.-]\d{3}[.-]\d{4}\b",
    "ip": r"\b(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)\b",
    "ssn": r"\b\d{3}-\d{2}-\d{4}\b",
    "card": r"\b\d(?:[ -]?\d){12,18}\b",
    "name": rf"\b{_TITLE}\.? {_NAME}(?: {_NAME})?|\b{_FIRST} {_NAME}|\b{_LOWER_TITLE}(?!and\b)\p{{Ll}}{{2,31}}",
}
PATTERN = "|".join(PATTERNS.values())

# The country calling codes of one and two digits; all others have three.
CALLING_CODE = r"^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"

# Turns after which a surrogate gets characters more, one each turn: few shapes
# have many values, and some have none but the entity's own.
LONGER = 4

_ROW = ["doc_id", "sig"]


def _is(kind: str, hit: Column) -> Column:
    return hit.rlike(f"^(?:{PATTERNS[kind]})$")


def _lead(hit: Column) -> Column:
    """The label or title that an entity was matched with, or nothing."""
    return F.regexp_extract(hit, rf"^(?:{_LABEL}|{_TITLE}\.? (?=\p{{Lu}})|{_LOWER_TITLE}(?=\p{{Ll}}))", 0)


def _kind(hit: Column, lead: Column, first: Column, alone: Column) -> Column:
    """Kind of an entity, names by gender and script as ``name_f_latin``.

    ``hit`` comes without its ``lead``; of a name it is one of its words, the
    ``first`` or another.  A name ``alone`` after a title is a surname, unless it
    is a known first name."""
    script = (
        F.when(hit.rlike(r"\p{IsCyrillic}"), "cyrillic").when(hit.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")
    )
    written = F.initcap(hit)
    surname = ~(hit.rlike(f"^{_FIRST}$") | written.rlike(f"^{_FIRST}$")) & (~first | alone)
    gender = F.lit("n")
    for g in ("f", "m"):
        given = rf"^(?:{GIVEN[g]})$"
        named = hit.rlike(given) | written.rlike(given) | lead.rlike(rf"^(?iu:{TITLES[g]})\.? $")
        gender = F.when(named, g).otherwise(gender)
    name = F.concat_ws("_", F.lit("name"), F.when(surname, "s").otherwise(gender), script)
    return (
        F.when(lead.rlike("[=:]"), "secret")
        .when(hit.contains("@"), "email")
        .when(hit.rlike(r"^(?:AKIA[0-9A-Z]{16}|(?=[a-f]*\d)[0-9a-f]{32,64})$"), "secret")
        .when(_is("iban", hit), "iban")
        .when(_is("ip", hit), "ip")
        .when(_is("ssn", hit), "ssn")
        .when(_is("phone", hit), "phone")
        .when(_is("card", hit), "card")
        .otherwise(name)
    )


def _normal(kind: Column, hit: Column) -> Column:
    """One spelling for all ways an entity is written."""
    digits = F.regexp_replace(hit, r"\D", "")
    return (
        F.when(kind == "email", F.lower(hit))
        # The same number with and without its country code.
        .when(kind == "phone", F.when(hit.startswith("+"), F.regexp_replace(digits, CALLING_CODE, "")).otherwise(digits))
        .when(kind.isin("ssn", "card"), digits)
        .when(kind == "iban", F.replace(hit, F.lit(" "), F.lit("")))
        .when(kind.startswith("name"), F.lower(hit))
        .otherwise(hit)
    )


def _number(digest: Column, at: Column, below: int) -> Column:
    """Number from two places of a hex digest, repeating after 62 places."""
    return (F.conv(F.substr(digest, at % 62 * 2 + F.lit(1), F.lit(4)), 16, 10).cast("int") % below).cast("int")


def _letters(digest: Column, plain: Column) -> Column:
    """Each letter becomes one of its script and case, each digit a digit."""
    hexed = plain.rlike("^[0-9a-f]+$")

    def one(at: Column) -> Column:
        c = F.substr(plain, at, F.lit(1))

        def shifted(first: str, count: int) -> Column:
            return F.substr(
                F.lit("".join(chr(ord(first) + i) for i in range(count))),
                _number(digest, at, count) + F.lit(1),
                F.lit(1),
            )

        return (
            F.when(c.rlike("[0-9]"), shifted("0", 10))
            .when(hexed & c.rlike("[a-f]"), shifted("a", 6))
            .when(c.rlike("[a-z]"), shifted("a", 26))
            .when(c.rlike("[A-Z]"), shifted("A", 26))
            .otherwise(c)
        )

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(plain)), one), "")


def _luhn(digits: Column) -> Column:
    """The last digit made the check digit of the others."""

    def worth(at: Column) -> Column:
        digit = F.substr(digits, at, F.lit(1)).cast("int")
        twice = digit * 2
        odd = (F.length(digits) - at) % 2 == 1
        return F.when(odd, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(digit)

    total = F.aggregate(
        F.sequence(F.lit(1), F.length(digits) - 1), F.lit(0), lambda sum_, at: sum_ + worth(at)
    )
    return F.concat(F.substr(digits, F.lit(1), F.length(digits) - 1), ((10 - total % 10) % 10).cast("string"))


def _iban(country: Column, account: Column) -> Column:
    """An IBAN with its check digits: 98 less the remainder by 97 of the account, the
    country and two zeros, letters counting from 10."""

    def read(rest: Column, at: Column) -> Column:
        code = F.ascii(F.substr(tail, at, F.lit(1)))
        return F.when(code < 58, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97).cast("int")

    tail = F.concat(account, country, F.lit("00"))
    rest = F.aggregate(F.sequence(F.lit(1), F.length(tail)), F.lit(0), read)
    return F.concat(country, F.lpad((98 - rest).cast("string"), 2, "0"), account)


def _made_name(digest: Column, kind: Column, turn: Column) -> Column:
    """Syllables and an ending; more syllables the more often a name was taken."""

    def pick(values: str, at: Column) -> Column:
        words = values.split()
        return F.element_at(F.array(*map(F.lit, words)), _number(digest, at, len(words)) + 1)

    def body_of(syllables: str) -> Column:
        return F.array_join(F.transform(F.sequence(F.lit(1), turn + 3), lambda i: pick(syllables, i)), "")

    made = F.lit(None).cast("string")
    for script, syllables in SYLLABLES.items():
        body = body_of(syllables)
        for part, endings in ENDINGS[script].items():
            name = F.concat(body, pick(endings, F.lit(0)))
            made = F.when(kind == f"name_{part}_{script}", name).otherwise(made)
    return made


def surrogate(key: str, kind: Column, normal: Column, turn: Column) -> Column:
    """Keyed replacement of a normal spelling; another one for each ``turn``, and a
    longer one from turn ``LONGER`` on.  What is added comes last, but first in an
    e-mail address."""
    message = F.concat_ws("|", kind, turn.cast("string"), normal)
    inner = F.sha2(F.concat(F.lit(key + "|"), message), 512)
    digest = F.sha2(F.concat(F.lit(key + "|"), inner), 512)
    octets = F.array_join(
        F.transform(F.sequence(F.lit(1), F.lit(4)), lambda i: (_number(digest, i * 3, 254) + 1).cast("string")), "."
    )
    changed = _letters(digest, normal)
    more = F.right(digest, F.greatest(turn - LONGER + 1, F.lit(0)))
    more = F.when(kind.isin("ip", "ssn", "phone", "card", "iban"), F.translate(more, "abcdef", "012345")).otherwise(more)
    return (
        # The last label of a host, the country of an account and the first letters of a
        # key stay.
        F.when(
            kind == "email",
            F.concat(
                more, F.regexp_replace(changed, r"\.[^.]*$", ""), F.regexp_extract(normal, r"(\.[^.]*)$", 1)
            ),
        )
        .when(kind == "ip", F.concat(octets, more))
        .when(kind == "card", _luhn(F.concat(changed, more)))
        .when(kind == "iban", _iban(F.left(normal, F.lit(2)), F.concat(F.substr(changed, F.lit(5)), more)))
        .when(kind.startswith("name"), _made_name(digest, kind, turn))
        .when(normal.startswith("AKIA"), F.concat(F.lit("AKIA"), F.substr(changed, F.lit(5)), more))
        .otherwise(F.concat(changed, more))
    )


def _written(kind: Column, hit: Column, old: Column, made: Column) -> Column:
    """A surrogate ``made`` in the format of the entity it replaces, whose normal
    spelling is ``old``.  What it has more follows."""
    placed = kind.isin("phone", "ssn", "card", "iban")
    normal = F.when(placed, F.left(made, F.length(old))).otherwise(made)
    more = F.substr(made, F.length(old) + 1)
    count = F.length(F.regexp_replace(hit, r"\D", ""))

    def put(state: Column, at: Column) -> Column:
        c = F.substr(hit, at, F.lit(1))
        seen = state["seen"]
        # Digits line up from the right: a country code stays.
        mine = seen - count + F.length(normal) + 1
        digit = c.rlike("[0-9]")
        new = F.when(digit & (mine > 0), F.substr(normal, mine, F.lit(1))).otherwise(c)
        return F.struct(
            F.concat(state["text"], new).alias("text"), (seen + digit.cast("int")).alias("seen")
        )

    places = F.sequence(F.lit(1), F.length(hit))
    numbers = F.aggregate(
        places, F.struct(F.lit("").alias("text"), F.lit(0).alias("seen")), put, lambda state: state["text"]
    )
    spaced = F.aggregate(
        places,
        F.struct(F.lit("").alias("text"), F.lit(0).alias("seen")),
        lambda state, at: F.struct(
            F.concat(
                state["text"],
                F.when(F.substr(hit, at, F.lit(1)) == " ", " ").otherwise(F.substr(normal, at - state["seen"], F.lit(1))),
            ).alias("text"),
            (state["seen"] + (F.substr(hit, at, F.lit(1)) == " ").cast("int")).alias("seen"),
        ),
        lambda state: state["text"],
    )
    capital = F.concat(F.upper(F.left(normal, F.lit(1))), F.substr(normal, F.lit(2)))
    cased = F.array_join(
        F.transform(
            F.sequence(F.lit(1), F.length(normal)),
            lambda at: F.when(F.substr(hit, at, F.lit(1)).rlike("[A-Z]"), F.upper(F.substr(normal, at, F.lit(1)))).otherwise(
                F.substr(normal, at, F.lit(1))
            ),
        ),
        "",
    )
    return (
        F.when(kind.isin("phone", "ssn", "card"), F.concat(numbers, more))
        .when(kind == "iban", F.concat(spaced, more))
        .when(kind == "email", cased)
        .when(
            kind.startswith("name"),
            F.when((hit == F.upper(hit)) & (F.length(hit) > 1), F.upper(normal))
            .when(hit == F.lower(hit), normal)
            .otherwise(capital),
        )
        .otherwise(normal)
    )


def find_entities(docs: DataFrame) -> DataFrame:
    """(doc_id, sig, place, part, lead, hit, kind, normal) of each entity of
    ``docs`` (doc_id, text, sig), ``place`` counting the matches of a text and
    ``part`` the words of a name."""
    # Most texts hold nothing that could start an entity; those are told apart by
    # cheaper passes.
    likely = F.col("text").rlike("[0-9@=:]|AKIA[A-Z]{16}") | F.col("text").rlike(rf"\b(?:{_TITLE}|{_FIRST}|{_LOWER_TITLE.strip()})(?:\b| )")
    found = docs.where(likely).select(
        *_ROW, F.posexplode(F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))).alias("place", "whole")
    )
    bare = found.withColumn("lead", _lead(F.col("whole"))).withColumn(
        "rest", F.substr("whole", F.length("lead") + 1)
    )
    is_name = (F.length("lead") > 0) & ~F.col("lead").rlike("[=:]") | F.col("rest").rlike(rf"^{_FIRST} ")
    words = F.when(is_name, F.split("rest", " ")).otherwise(F.array("rest"))
    parts = bare.withColumn("words", words).select(
        *_ROW, "place", "lead", F.size("words").alias("n"), F.posexplode("words").alias("part", "hit")
    )
    kind = _kind(F.col("hit"), F.col("lead"), F.col("part") == 0, F.col("n") == 1)
    return parts.withColumn("kind", kind).select(
        *_ROW, "place", "part", "lead", "hit", "kind", _normal(F.col("kind"), F.col("hit")).alias("normal")
    )


def make_surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, normal, surrogate) for the distinct ``entities`` (kind, normal).

    Of entities with one surrogate the first (fewest turns, then smallest) keeps
    it, and none may keep one that is itself an entity of its kind; the others
    take another turn, until all differ.  From turn ``LONGER`` on there are ever
    more values of any shape, so that comes to an end.
    """
    # By count, not by bytes: the rows are short, but each takes long.  Not by both
    # columns, as Spark then takes the shuffle of distinct() for it and merges that.
    parts = int(entities.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = entities.select("kind", "normal").distinct().repartition(parts, "normal")
    rows = names.withColumn("turn", F.lit(0))
    while True:
        made = rows.select(
            "kind", "normal", "turn", surrogate(key, F.col("kind"), F.col("normal"), F.col("turn")).alias("surrogate")
        )
        made = stored(made, "surrogates")
        first = made.groupBy("kind", "surrogate").agg(F.min(F.struct("turn", "normal")).alias("first"))
        real = made.select("kind", F.col("normal").alias("surrogate"), F.lit(True).alias("real"))
        judged = (
            made.join(first, ["kind", "surrogate"])
            .join(real, ["kind", "surrogate"], "left")
            .withColumn("again", (F.col("first.normal") != F.col("normal")) | F.col("real").isNotNull())
        )
        judged = stored(judged.select("kind", "normal", "turn", "surrogate", "again"), "judged")
        if judged.where("again").isEmpty():
            return judged.select("kind", "normal", "surrogate")
        rows = judged.select("kind", "normal", (F.col("turn") + F.col("again").cast("int")).alias("turn"))


def _again(named: DataFrame) -> DataFrame:
    """(doc_id, sig, forms, news, again) of the names of each text: how they may be
    written, what that becomes, and a pattern of where they stand alone.

    A known name counts with a capital or in capitals, in small letters after a title
    only, as many names are words."""
    hit = F.col("hit")
    forms = F.array_distinct(F.array(hit, F.upper(hit), F.initcap(hit), F.lower(hit)))
    forms = named.where(F.col("kind").startswith("name")).select("*", F.explode(forms).alias("form"))
    new = _written(F.col("kind"), F.col("form"), F.col("normal"), F.col("surrogate"))
    # One entity to a form, should a word be first name and surname in one text.
    by_form = forms.groupBy(*_ROW, "form").agg(F.min(F.struct("kind", new.alias("new"))).getField("new").alias("new"))
    lists = by_form.groupBy(*_ROW).agg(F.sort_array(F.collect_list(F.struct("form", "new"))).alias("known"))
    small = F.filter("known.form", lambda form: form == F.lower(form))
    large = F.filter("known.form", lambda form: form != F.lower(form))
    return lists.select(
        *_ROW,
        F.col("known.form").alias("_forms"),
        F.col("known.new").alias("_news"),
        F.concat(
            F.lit(r"(?<![\p{L}\p{N}_@])(?:"),
            F.array_join(large, "|"),
            F.lit(r")(?![\p{L}\p{N}_@])|(?<=\b(?:mr|mrs|ms|dr|prof)\.? )(?:"),
            F.array_join(small, "|"),
            F.lit(r")(?!\p{L})"),
        ).alias("_again"),
    )


def replace_entities(docs: DataFrame, key: str, count: str = "n_entities") -> DataFrame:
    """``docs`` (doc_id, text, and any others) with each entity of ``text``
    replaced, and their number as ``count``.

    Kinds: e-mail addresses, passwords and keys, IBANs, telephone, card and
    social security numbers, IPv4 addresses, names after a title or with a known
    first name.  A name found in a text is an entity wherever else it stands in it,
    alone, or in capitals.  A surrogate has the kind, script, gender, punctuation and case of
    what it replaces; cards and IBANs have valid check digits, IBANs keep their
    country, telephone numbers their country code: a number with it and one without
    are the same.  First names and surnames are
    entities of their own, so a name stays recognisable where only a part of it
    is used.

    Only entities are shuffled and compared; texts move once, to meet their
    surrogates.  Texts without entities, empty and null texts are unchanged.
    Rows that repeat are replaced alike; rows without doc_id too.  Columns of
    ``docs`` may have any names but that of ``count``, which is replaced.
    """
    columns = [c for c in docs.columns if c != count]
    own = F.struct(*[F.col(f"`{c}`") for c in columns if c != "text"]).alias("row")
    rows = docs.select(
        own,
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.xxhash64("text").alias("sig"),
    )
    found = stored(
        find_entities(rows)
        .groupBy(*_ROW, "place", "part")
        .agg(*[F.first(c).alias(c) for c in ("lead", "hit", "kind", "normal")]),
        "entities",
    )
    named = found.join(make_surrogates(found, key), ["kind", "normal"])
    written = _written(F.col("kind"), F.col("hit"), F.col("normal"), F.col("surrogate"))
    by_row = (
        named.select(*_ROW, "place", "lead", F.struct("part", written.alias("new")).alias("word"))
        .groupBy(*_ROW, "place", "lead")
        .agg(F.sort_array(F.collect_list("word")).alias("words"))
        .select(*_ROW, "place", F.concat("lead", F.array_join("words.new", " ")).alias("new"), F.size("words").alias("n"))
        .groupBy(*_ROW)
        .agg(F.sort_array(F.collect_list(F.struct("place", "new"))).alias("_new"), F.sum("n").alias("_count"))
    )
    by_row = by_row.join(_again(named), _ROW, "left")

    def known(gap: Column) -> Column:
        """What stands around known names in a gap between entities, and what they become."""
        hits = F.regexp_extract_all(gap, F.col("_again"), F.lit(0))
        news = F.transform(hits, lambda hit: F.get("_news", F.array_position("_forms", hit).cast("int") - 1))
        return F.when(F.col("_again").isNull(), F.struct(F.array(gap).alias("around"), none.alias("news"))).otherwise(
            F.struct(F.split(gap, F.col("_again"), -1).alias("around"), news.alias("news"))
        )

    none = F.array().cast("array<string>")
    gaps = F.transform(F.split("text", PATTERN, -1), known)
    # A column of its own, as it is used twice.
    done = rows.join(by_row, _ROW, "left").withColumn("_gaps", F.when(F.col("_new").isNotNull(), gaps))

    def joined(around: Column, news: Column) -> Column:
        return F.array_join(F.zip_with(around, news, lambda gap, new: F.concat(gap, F.coalesce(new, F.lit("")))), "")

    around = F.transform("_gaps", lambda gap: joined(gap["around"], gap["news"]))
    text = F.when(F.col("_new").isNotNull(), joined(around, F.col("_new.new"))).otherwise(F.col("text"))
    more = F.aggregate("_gaps", F.lit(0).cast("long"), lambda total, gap: total + F.size(gap["news"]))
    return done.select(
        *[text.alias(c) if c == "text" else F.col("row").getField(c).alias(c) for c in columns],
        (F.coalesce("_count", F.lit(0)) + F.coalesce(more, F.lit(0))).cast("long").alias(count),
    )
