r"""Surrogate generation for personal data and secrets.

Entities are found by patterns (e-mail, phone, card, social security number, IPv4 address,
cloud access key, labelled secret, person after a title or with a known first name). Every
distinct entity of the corpus gets one surrogate of its own type, drawn from a keyed digest:

* e-mail: letters become letters and digits digits, the last label of the domain stays;
* phone, card, SSN: digits change, the number's own punctuation, country code and card network
  stay, and a card that passes the check-digit test still does;
* IPv4: another public (or private, as before) address;
* keys: letters become letters and digits digits;
* secrets: every character is replaced, digits and ASCII letters inside their class, other letters by ASCII
  letters and all else by symbols; the label stays;
* persons: first name of the same gender and script, family name of the same script and
  about the same length; the title stays.

*Coreference*: spellings of one entity (``(339) 555-8607``, ``339-555-8607``; letter case of
e-mails) share a canonical form, and the surrogate belongs to that form, so all mentions
in all documents agree. Of a person the family name (by script; Slavic feminine endings go with the masculine form) and
the first name (by gender) have surrogates of their own, so ``Peter Miller``, ``Mr. Miller`` and ``Paula Miller`` share a family, and
a family name that stands alone is replaced too in a document that names it with a title or first name.
*Distinctness*: after each draw, surrogates that two entities share, and
surrogates that are a real entity of the corpus, are found by grouping, and all but one
holder draw again until none is left. (A first name alone names nobody: its surrogate may be another's real first name, but
no two first names share one.)

Only built-in column functions are used. Texts without entities are never shuffled; entities travel
without their texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickforge.llm.common import ROW, packed, stored

#: First names by script and gender, and syllables of family names by script.
FIRST = {
    "latin_m": "James John Robert Michael William David Richard Thomas Charles Daniel Matthew Anthony Peter Paul "
               "Hans Klaus Stefan Pierre Jean Antoine Carlos Juan Miguel Pedro",
    "latin_f": "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Nancy Anna Laura Emma "
               "Ursula Sabine Monika Claire Sophie Camille Carmen Lucia Isabel Marta",
    "cyrillic_m": "Иван Пётр Сергей Алексей Дмитрий Николай Михаил Андрей",
    "cyrillic_f": "Анна Мария Елена Ольга Наталья Татьяна Ирина Светлана",
    "greek_m": "Γιώργος Νίκος Δημήτρης Κώστας Παύλος Ανδρέας",
    "greek_f": "Μαρία Ελένη Αικατερίνη Σοφία Άννα Ιωάννα",
}
SYLLABLES = {
    "latin": "bar ben cor dal den far gan hol kel lan mar mil nor pel ran sel tan tor val wen".split(),
    "cyrillic": "бар вол гор дан жар зим кал лен мор нов пол рат сел тур хол чер".split(),
    "greek": "βαρ γαλ δημ ζαχ καλ λαμ μαρ νικ παπ ραφ σταυ τσακ φιλ χαλ".split(),
}
FAMILY_END = {"latin": "s", "cyrillic": "ов", "greek": "ης"}
#: Titles that show a person's gender.
TITLES = {
    "m": ["Mr", "Herr", "Monsieur", "Señor", "г-н", "κ."],
    "f": ["Mrs", "Ms", "Miss", "Frau", "Madame", "Mme", "Señora", "г-жа", "κα"],
}
LABELS = "token|secret|password|passwd|pwd|api[_-]?key|access[_-]?key"
_STRICT = "token|secret|api[_-]?key|access[_-]?key"
#: A label and what assigns. ``token: word`` may be prose: behind a colon, without quotes, a value of letters alone is only taken
#: for a secret after a word for passwords.
_LABELLED = (r"(?:(?:password|passwd|pwd)['\"]?\s{0,3}[=:]\s{0,3}['\"]?"
             rf"|(?:{_STRICT})['\"]?\s{{0,3}}(?:=\s{{0,3}}['\"]?|:\s{{0,3}}['\"]|:\s{{0,3}}(?!\p{{L}}++(?![^\s'\",;]))))")

_NAME = r"\p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)?"
_FIRST_ALL = "|".join(n for names in FIRST.values() for n in names.split())
_TITLE_ALL = "|".join(t.replace(".", r"\.") for ts in TITLES.values() for t in sorted(ts, key=len, reverse=True))
#: First characters of names and titles: Latin, Greek and Cyrillic capitals, two small title letters.
_INITIALS = r"A-Z\u0386-\u03AB\u0401-\u042F\u0433\u03BA"
#: Seven digits of a number, written out as look-behinds take no repeated groups.
_SEVEN = r"[0-9][ .()-]{0,3}" * 7
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

#: Patterns, in the order in which they are tried at a place. Each begins with a test of one
#: character, as most places fail there; the test of what stands before comes after it
#: (``x(?<![ab].)``: an x that no a or b precedes). Possessive quantifiers keep the search linear
#: on long runs of one kind of character.
PATTERNS = {
    "secret": rf"(?=[AaPpSsTt])(?i:(?<![a-z0-9]){_LABELLED})[^\s'\",;]{{6,}}",
    "email": r"[A-Za-z0-9._%+-](?<![A-Za-z0-9._%+-].)[A-Za-z0-9._%+-]*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+",
    "key": r"A(?<![A-Za-z0-9].)[KS]IA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "card": r"[3-6](?<![0-9.+-].)(?:[0-9]{3}(?:[ -]?[0-9]{4}){3}|(?<=3)[47][0-9]{2}[ -]?[0-9]{6}[ -]?[0-9]{5})(?![0-9-])",
    "ssn": r"[0-9](?<![0-9-].)[0-9]{2}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?=[0-9+(])(?<![0-9+])(?:(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
             rf"|\+[1-9][0-9]{{0,2}}(?:[ .-]?\(?[0-9]{{1,4}}\)?){{2,5}}(?![0-9])(?<={_SEVEN}))",
    "ip": rf"(?=[0-9])(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?![0-9]|\.[0-9])",
    "person": rf"(?=[{_INITIALS}])(?<![\p{{L}}])"
              rf"(?:(?:{_TITLE_ALL})\.? {_NAME}(?: {_NAME})?|(?:{_FIRST_ALL}) {_NAME})(?![\p{{L}}])",
}
PATTERN = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: For texts without an at sign, where looking for e-mails at every word is lost time.
PATTERN_NO_MAIL = "|".join(f"(?:{p})" for k, p in PATTERNS.items() if k != "email")
_DIGIT_TYPES = ["card", "ssn", "phone"]


def _kind(v: Column) -> Column:
    """Type of a matched string: the first pattern that matches all of it.

    Look-arounds were decided in the text and hold at the ends of the string.
    """
    out = F.lit(None).cast("string")
    for name, p in reversed(PATTERNS.items()):
        out = F.when(v.rlike(rf"\A(?:{p})\z"), F.lit(name)).otherwise(out)
    return out


def _prefix(kind: Column, v: Column) -> Column:
    """What stays in front of the entity: label of a secret, title of a person."""
    label = F.regexp_extract(v, rf"\A(?i:(?:{LABELS})['\"]?\s{{0,3}}[=:]\s{{0,3}}['\"]?)", 0)
    title = F.regexp_extract(v, rf"\A(?:(?:{_TITLE_ALL})\.? )?", 0)
    return F.when(kind == "secret", label).when(kind == "person", title).otherwise("")


def _gender(title: Column, name: Column) -> Column:
    m = F.array(*[F.lit(n) for k, ns in FIRST.items() if k.endswith("_m") for n in ns.split()])
    f = F.array(*[F.lit(n) for k, ns in FIRST.items() if k.endswith("_f") for n in ns.split()])
    bare = F.trim(F.regexp_replace(title, r"(?<=\p{L})\.? $", ""))
    first = F.substring_index(name, " ", 1)
    return (F.when(bare.isin(TITLES["f"]) | F.array_contains(f, first), "f")
            .when(bare.isin([t.rstrip(".") for t in TITLES["m"]]) | F.array_contains(m, first), "m").otherwise("f"))


#: The ending of a feminine Slavic family name, and what stays in the masculine form.
_FEMININE = r"((?:ов|ев|ёв|ин|ын))а\z"


def _script(v: Column) -> Column:
    return F.when(v.rlike(r"\p{IsCyrillic}"), "cyrillic").when(v.rlike(r"\p{IsGreek}"), "greek").otherwise("latin")


def _mentions(matches: DataFrame) -> DataFrame:
    """``id, pos, v`` to ``id, pos, v, kind, prefix, body, canon, first``; canon is shared by spellings.

    Of a person ``canon`` is the family name, and ``first`` the first name (null: none, or no person).
    """
    m = matches.withColumn("kind", _kind(F.col("v")))
    m = m.withColumn("prefix", _prefix(F.col("kind"), F.col("v")))
    m = m.withColumn("body", F.expr("substr(v, length(prefix) + 1)"))
    digits = F.regexp_replace("body", "[^0-9]", "")
    phone = F.when((F.length(digits) == 11) & digits.startswith("1"), F.expr("substr(regexp_replace(body, '[^0-9]', ''), 2)")
                   ).otherwise(digits)
    family = F.element_at(F.split("body", " "), -1)
    person = F.concat_ws("|", _script(F.col("body")), F.regexp_replace(family, _FEMININE, "$1"))
    first = F.when((F.col("kind") == "person") & (F.instr("body", " ") > 0), F.concat_ws(
        "|", _script(F.col("body")), _gender(F.col("prefix"), F.col("body")), F.substring_index("body", " ", 1)))
    canon = (F.when(F.col("kind") == "email", F.lower("body")).when(F.col("kind") == "phone", phone)
             .when(F.col("kind").isin("card", "ssn"), digits).when(F.col("kind") == "person", person)
             .otherwise(F.col("body")))
    return m.withColumn("canon", canon).withColumn("first", first)


def _draw(kind: Column, canon: Column, secret: str, attempt: Column) -> Column:
    """Surrogate of a canonical form (a canonical form itself), from a keyed digest."""
    seed = F.concat_ws("\x1f", F.lit(secret), kind, canon, attempt.cast("string"))

    def number(salt: Column, below: int) -> Column:
        """A uniform number from 48 bits of the keyed digest."""
        hexa = F.substring(F.sha2(F.concat_ws("\x1f", seed, salt.cast("string")), 256), 1, 12)
        return F.pmod(F.conv(hexa, 16, 10).cast("long"), F.lit(below))

    def more(text: Column, every: int, chars: str = "abcdefghijklmnopqrstuvwxyz0123456789") -> Column:
        """``text`` and one more character after each ``every`` draws: there are always enough values."""
        pick = lambda i: F.substring(F.lit(chars), (number(F.concat(F.lit("m"), i.cast("string")), len(chars)) + 1).cast("int"), F.lit(1))  # noqa: E731,E501
        places = F.slice(F.array(*map(F.lit, range(1, 17))), F.lit(1), F.floor(attempt / every).cast("int"))
        return F.concat(text, F.array_join(F.transform(places, pick), ""))

    def spread(text: Column, rest: bool = False) -> Column:
        """Every letter and digit replaced inside its class, the rest kept (or replaced too)."""
        def one(c: Column, i: Column) -> Column:
            pick = lambda chars: F.substring(F.lit(chars), (number(i, len(chars)) + 1).cast("int"), F.lit(1))
            return (F.when(c.rlike("[0-9]"), pick("0123456789"))
                    .when(c.rlike("[a-z]"), pick("abcdefghijklmnopqrstuvwxyz"))
                    .when(c.rlike("[A-Z]"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
                    .when(F.lit(rest) & c.rlike(r"\p{Lu}"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
                    .when(F.lit(rest) & c.rlike(r"\p{L}"), pick("abcdefghijklmnopqrstuvwxyz"))
                    .when(F.lit(rest), pick("-_.~!*+")).otherwise(c))
        return F.array_join(F.transform(F.split(text, ""), one), "")

    def hexes(text: Column) -> Column:
        one = lambda c, i: F.substring(F.lit("0123456789abcdef"), (number(i, 16) + 1).cast("int"), F.lit(1))
        return F.array_join(F.transform(F.split(text, ""), one), "")

    cut = F.length(canon) - F.length(F.substring_index(canon, ".", -1))
    email = F.concat(more(F.lit(""), 4), spread(canon.substr(F.lit(1), cut)), F.substring_index(canon, ".", -1))

    def tail(start: int) -> Column:
        return spread(canon.substr(F.lit(start), F.length(canon)))

    # North American numbers start their two first groups with 2 to 9.
    ten = F.concat((number(F.lit("a"), 8) + 2).cast("string"), tail(2).substr(1, 2),
                   (number(F.lit("b"), 8) + 2).cast("string"), tail(5))
    phone = F.when(F.length(canon) == 10, ten).otherwise(more(F.concat(canon.substr(1, 2), tail(3)), 4, "0123456789"))
    ssn = F.concat(F.lpad((number(F.lit("a"), 664) + 1).cast("string"), 3, "0"),
                   F.lpad((number(F.lit("b"), 99) + 1).cast("string"), 2, "0"),
                   F.lpad((number(F.lit("c"), 9999) + 1).cast("string"), 4, "0"))
    body = F.concat(canon.substr(1, 1), spread(canon.substr(F.lit(2), F.length(canon) - 2)))
    card = F.when(_luhn(canon) == 0, F.concat(body, F.pmod(-_luhn(F.concat(body, F.lit("0"))), F.lit(10)).cast("string"))
                  ).otherwise(F.concat(canon.substr(1, 1), tail(2)))
    # A small private range that runs full goes over to 10.0.0.0/8, and that to public addresses.
    private = F.regexp_extract(canon, r"\A(?:10|127|192\.168|172\.(?:1[6-9]|2[0-9]|3[01]))(?=\.)", 0)
    private = F.when((private == "") | (attempt < 8), private).when(attempt < 24, "10").otherwise("")
    octet = lambda s, lo, n: (number(F.lit(s), n) + lo).cast("string")
    public = F.when(number(F.lit("o"), 2) == 0, octet("p", 11, 116)).otherwise(octet("p", 128, 41))
    ip = F.when(private == "", F.concat_ws(".", public, octet("q", 0, 256), octet("r", 0, 256), octet("s", 1, 254))
                ).when(F.instr(private, ".") > 0, F.concat_ws(".", private, octet("r", 0, 256), octet("s", 1, 254))
                       ).otherwise(F.concat_ws(".", private, octet("q", 0, 256), octet("r", 0, 256), octet("s", 1, 254)))
    key = F.concat(canon.substr(1, 4), tail(5))
    parts = F.split(canon, r"\|")
    person, first = F.lit(None).cast("string"), F.lit(None).cast("string")
    for script, syllables in SYLLABLES.items():
        syl = lambda i: F.get(F.array(*map(F.lit, syllables)), number(i, len(syllables)).cast("int"))  # noqa: E731,B023
        n = F.greatest(F.lit(2), F.round(F.length(parts[1]) / 3).cast("int"))
        # Draws after the first few may use longer names: there are always enough.
        n = n + F.floor(attempt / 4).cast("int")
        family = F.concat(F.initcap(F.array_join(F.transform(F.sequence(F.lit(1), n), syl), "")), F.lit(FAMILY_END[script]))
        person = F.when(parts[0] == script, F.concat_ws("|", F.lit(script), family)).otherwise(person)
        for g in "mf":
            names = FIRST[f"{script}_{g}"].split()
            pick = lambda i: F.get(F.array(*map(F.lit, names)), number(F.concat(F.lit("f"), i.cast("string")), len(names)).cast("int"))  # noqa: E731,E501,B023
            # Then double names, and longer ones.
            several = F.slice(F.array(*map(F.lit, range(16))), F.lit(1), F.floor(attempt / 6).cast("int") + 1)
            drawn = F.concat_ws("|", F.lit(script), F.lit(g), F.array_join(F.transform(several, pick), "-"))
            first = F.when((parts[0] == script) & (parts[1] == g), drawn).otherwise(first)
    return (F.when(kind == "email", email).when(kind == "phone", phone).when(kind == "ssn", ssn)
            .when(kind == "card", card).when(kind == "ip", ip).when(kind == "key", key)
            .when(kind == "person", person).when(kind == "first", first)
            .otherwise(F.when(canon.rlike(r"\A[0-9a-f]+\z"), more(hexes(canon), 4, "0123456789abcdef"))
                       .otherwise(more(spread(canon, rest=True), 4))))


def _luhn(digits: Column) -> Column:
    """Check sum (mod 10) of a string of digits, the last digit counted once."""
    def one(c: Column, i: Column) -> Column:
        d = c.cast("int") * F.when(F.pmod(i, F.lit(2)) == 1, 2).otherwise(1)
        return d - F.when(d > 9, 9).otherwise(0)
    return F.pmod(F.aggregate(F.transform(F.split(F.reverse(digits), ""), one), F.lit(0), lambda a, x: a + x), F.lit(10))


def surrogates(entities: DataFrame, secret: str, max_draws: int = 60) -> DataFrame:
    """``kind, canon`` (distinct) to ``kind, canon, surrogate``: distinct, and no real entity.

    Draws until no two entities of a kind share a surrogate and no surrogate is an entity of
    the corpus (of first names: none is its own). Formats with few values are widened as the draws rise: longer secrets, e-mails and
    international numbers, other private ranges, longer names. Numbers of fixed length (card, SSN, ten-digit phone,
    key) and public addresses are not; more of them than half of their values (330 million SSNs, 1.3 billion
    addresses, 3.2 billion phones) end in an error after ``max_draws``.
    """
    now = stored(entities.withColumn("attempt", F.lit(0)), "pii-entities")
    done = None
    for _ in range(max_draws):
        drawn = now.withColumn("surrogate", _draw(F.col("kind"), F.col("canon"), secret, F.col("attempt")))
        # Real entities hold their own value, earlier surrogates theirs; of new holders the first wins.
        claims = drawn.select("kind", F.col("surrogate").alias("value"), F.lit(1).alias("level"), "canon")
        claims = claims.union(entities.filter("kind != 'first'").select("kind", F.col("canon").alias("value"), F.lit(0), "canon"))
        if done is not None:
            claims = claims.union(done.select("kind", F.col("surrogate").alias("value"), F.lit(0), "canon"))
        owner = claims.groupBy(F.col("kind").alias("ok"), "value").agg(
            F.min(F.struct("level", "canon")).alias("own"))
        judged = stored(drawn.join(owner, (F.col("kind") == F.col("ok")) & (F.col("surrogate") == F.col("value")))
                        .withColumn("wins", (F.col("own.level") == 1) & (F.col("own.canon") == F.col("canon"))
                                    & (F.col("surrogate") != F.col("canon")))
                        .select("kind", "canon", "attempt", "surrogate", "wins"), "pii-draw")
        won = judged.filter("wins").select("kind", "canon", "surrogate")
        done = won if done is None else done.union(won)
        now = judged.filter("not wins").select("kind", "canon", (F.col("attempt") + 1).alias("attempt"))
        if now.isEmpty():
            return done
    raise ValueError("some formats have too few values for distinct surrogates")


def _rendered(m: DataFrame) -> Column:
    """The surrogate in the format of the mention."""
    body, s = F.col("body"), F.col("surrogate")
    chars = F.split(body, "")
    n_digits = F.length(F.regexp_replace(body, "[^0-9]", ""))
    # Digits are dealt from the right: a country code that the canonical form lacks stays. What a longer
    # number has more stands at its end.
    lead = F.greatest(n_digits - F.length(s), F.lit(0))
    def digit(c: Column, i: Column) -> Column:
        before = F.length(F.regexp_replace(body.substr(F.lit(1), i + 1), "[^0-9]", ""))
        return F.when(c.rlike("[0-9]") & (before > lead), s.substr(before - lead, F.lit(1))).otherwise(c)
    digits = F.concat(F.array_join(F.transform(chars, digit), ""), s.substr(n_digits + 1, F.length(s)))
    feminine = F.when(body.rlike(_FEMININE) & s.rlike(r"ов\z"), "а").otherwise("")
    family = F.concat(F.substring_index(s, "|", -1), feminine)
    name = F.concat_ws(" ", F.substring_index("first_surrogate", "|", -1), family)
    return F.concat("prefix", F.when(F.col("kind").isin(_DIGIT_TYPES), digits)
                    .when(F.col("kind") == "person", name)
                    .when((F.col("kind") == "email") & (body == F.upper(body)) & (body != F.lower(body)), F.upper(s))
                    .otherwise(s))


def replace_pii(docs: DataFrame, secret: str, text: str = "text") -> DataFrame:
    """All rows of ``docs`` with entities replaced in ``text``, plus ``n_entities`` (long).

    ``secret`` keys the draws: without it surrogates cannot be recomputed. Row order is not
    kept. Null and empty texts stay as they are with 0 entities; equal rows get equal texts; an
    empty table gives an empty result; other columns pass through whatever their names.
    """
    names = docs.columns
    spot = names.index(text)
    rows = packed(docs, t=lambda c: c(text))
    has = F.coalesce(F.when(F.contains(F.col("t"), F.lit("@")), F.col("t").rlike(PATTERN))
                     .otherwise(F.col("t").rlike(PATTERN_NO_MAIL)), F.lit(False))
    clean = rows.filter(~has).select(ROW, F.col("t"), F.lit(0).cast("long").alias("n_entities"))
    # A written table: the ids stay what they are even if a task runs again.
    hit = stored(rows.filter(has).withColumn("found", F.regexp_extract_all("t", F.lit(PATTERN), F.lit(0)))
                 .withColumn("id", F.monotonically_increasing_id()), "pii-hits")
    mentions = stored(_mentions(hit.select("id", F.posexplode("found").alias("pos", "v"))), "pii-mentions")
    entities = mentions.select("kind", "canon").union(
        mentions.filter("first is not null").select(F.lit("first"), F.col("first"))).distinct()
    table = surrogates(entities, secret).select(F.col("kind").alias("tk"), F.col("canon").alias("tc"), "surrogate")
    firsts = table.filter("tk = 'first'").select(F.col("tc").alias("fc"), F.col("surrogate").alias("first_surrogate"))
    named = mentions.join(table, (F.col("kind") == F.col("tk")) & (F.col("canon") == F.col("tc")))
    named = named.join(firsts, F.col("first") == F.col("fc"), "left").withColumn("s", _rendered(named))
    # Family names of the document, as written, and what stands for them.
    alone = F.when(F.col("kind") == "person", F.struct(F.element_at(F.split("body", " "), -1).alias("real"),
                                                       F.element_at(F.split("s", " "), -1).alias("drawn")))
    new = (named.select(F.col("id").alias("nid"), F.struct("pos", "s").alias("x"), alone.alias("y"))
           .groupBy("nid").agg(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["s"]).alias("new"),
                               F.sort_array(F.collect_set("y")).alias("families")))
    done = hit.join(new, F.col("id") == F.col("nid"))

    def bare(piece: Column, name: Column) -> Column:
        return F.regexp_replace(piece, F.concat(F.lit(r"(?<![\p{L}-])"), name["real"], F.lit(r"(?![\p{L}-])")), name["drawn"])

    # The text between matches, with the surrogates between its pieces; a family name that stands alone is replaced as well.
    pieces = F.split("t", PATTERN, -1)
    pieces = F.when(F.size("families") == 0, pieces).otherwise(
        F.transform(pieces, lambda p: F.aggregate("families", p, bare)))
    text2 = F.array_join(F.transform(F.arrays_zip(pieces.alias("a"), F.col("new").alias("b")),
                                     lambda z: F.concat(z["a"], F.coalesce(z["b"], F.lit("")))), "")
    done = done.select(ROW, text2.alias("t"), F.size("new").cast("long").alias("n_entities"))
    both = clean.union(done)
    cols = [F.col("t").alias(n) if i == spot else F.col(f"{ROW}.c{i}").alias(n) for i, n in enumerate(names)]
    return both.select(*cols, "n_entities")
