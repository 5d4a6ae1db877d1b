"""Surrogates for personal data, in DataFrame functions only.

One pattern finds the entities. An entity is its type and its normal form (letter case, separators and titles taken
off), so all its mentions, in whatever format, get one surrogate (coreference). Names are entities by the word: given
names, which have a gender (that of the title, else that of a listed name), and family names, so that a person keeps one
surrogate with any title or none. A document that names a person with a title is searched again for the full and family
name without one, and so is every other document for the full name and, where it stands, the family name. Names that are
ordinary words of the corpus too (Long, Young; by grouped counts of words in small letters) are not looked for alone. A
surrogate is made from a keyed SHA-512 of type, normal form and attempt: of the same type, with the
same kinds of characters in the same script, for names the same gender and number of words, for cards and account
numbers check digits that are valid where the entity's are.

The distinct entities of the corpus are checked for collisions: of those that share a surrogate the smallest keeps it,
and none may get a value that occurs as a real entity; the others try again, `ATTEMPTS` times. What still collides then
is of a format whose values nearly all occur (every address of a private network, say). Such entities of one format get
each other's values, each the next one's in a keyed order: distinct again, though no longer values that occur nowhere.

Surrogates of first attempt follow from the entity alone and are written in place, without a join. Only entities
that needed more are looked up; the rows that hold them are few, counted, and broadcast up to `MAX_BROADCAST_ROWS`,
else joined by shuffle.

Defined cases: a null or empty text stays as it is; a very long text is searched whole; equal rows get equal texts;
letters outside the listed alphabets become Latin ones; a given name whose gender is unknown takes that of its other
mentions in the corpus, if these agree; other columns are kept; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import checkpoint, free_name

MAX_BROADCAST_ROWS = 20_000
#: A part of a name is an ordinary word too if it occurs in small letters so many times as often as in titled names.
COMMON = 2
#: Keyed draws of an entity, and the entities of one format that one task then turns round.
ATTEMPTS, ROUND = 12, 100_000

# fixed values: titles by gender, given names by gender and parts of further ones, syllables of family names
MALE_TITLES = "Mr|Mister|Sir|Herr|Monsieur|Señor|Senhor"
FEMALE_TITLES = "Mrs|Ms|Miss|Madam|Frau|Madame|Mademoiselle|Señora|Señorita|Senhora"
OTHER_TITLES = "Dr|Prof|Professor"
MALE_NAMES = ["adam", "bruno", "carl", "david", "emil", "felix", "georg", "hugo", "ivan", "jonas", "karel", "louis", "marco", "nils", "oscar", "paul", "ralf", "simon", "theo", "victor"]
FEMALE_NAMES = ["alice", "bella", "clara", "diana", "elena", "fiona", "greta", "helen", "irene", "julia", "karin", "laura", "maria", "nora", "olga", "paula", "rosa", "sofia", "tessa", "vera"]
HEADS = ["adal", "al", "ans", "arn", "bern", "diet", "eber", "eck", "egin", "engel", "ermen", "fried", "ger", "gott", "hart", "heim", "hel", "her", "hum", "ing", "kun", "lam", "land", "lud", "mark", "mein", "nor", "ort", "os", "rein", "rich", "rod", "ru", "sieg", "tank", "theo", "ul", "vol", "wal", "wern", "wil", "win", "wolf"]
MALE_NAMES += [a + b for a in HEADS for b in ("bald", "bert", "brand", "fried", "ger", "hard", "helm", "mar", "mund", "ram", "rich", "win")]
FEMALE_NAMES += [a + b for a in HEADS for b in ("berta", "burga", "gard", "gunde", "heide", "hild", "linde", "lotte", "run", "traud", "trude", "wina")]
ANY_NAMES = ["alex", "andrea", "chris", "dominique", "eden", "jamie", "kim", "luca", "noel", "robin", "sasha", "toni"]
SYLLABLES = ["ba", "be", "bo", "da", "de", "do", "fa", "fe", "ga", "go", "ha", "he", "ka", "ke", "ko", "la", "le", "lo", "ma", "me", "mo", "na", "ne", "no", "pa", "po", "ra", "re", "ro", "sa", "se", "so", "ta", "te", "to", "va", "ve", "vo", "wa", "za"]
ALPHABETS = ["0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "àáâäåçèéêëìíîïñòóôöùúûü", "ÀÁÂÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÖÙÚÛÜ", "ąćčďđęěğıłńňőøřśşšţťůűýźżž", "ĄĆČĎĐĘĚĞİŁŃŇŐØŘŚŞŠŢŤŮŰÝŹŻŽ", "абвгдежзийклмнопрстуфхцчшщъыьэюя", "АБВГДЕЖЗИЙКЛМНОПРСТУФХЦЧШЩЪЫЬЭЮЯ", "αβγδεζηθικλμνξοπρστυφχψω", "ΑΒΓΔΕΖΗΘΙΚΛΜΝΞΟΠΡΣΤΥΦΧΨΩ"]

TITLE = rf"(?:{MALE_TITLES}|{FEMALE_TITLES}|{OTHER_TITLES})(?:\. ?| )"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_END = r"(?![\p{L}\p{N}])"
PATTERNS = {
    "email": r"[\p{L}\p{N}._%+-]{1,64}+@[\p{L}\p{N}-]++(?:\.[\p{L}\p{N}-]++)+(?<!-)",
    "secret": rf"(?:[0-9a-f]{{32,128}}|[0-9A-F]{{32,128}}|AKIA[0-9A-Z]{{16}}|gh[pousr]_[A-Za-z0-9]{{20,255}}|sk-[A-Za-z0-9]{{20,128}})(?!_){_END}",
    "iban": rf"[A-Z]{{2}}\d{{2}}(?: ?[A-Z0-9]{{4}}){{3,7}}(?: ?[A-Z0-9]{{1,3}})?{_END}",
    "ip": rf"(?<!\.)(?:{_OCTET}\.){{3}}{_OCTET}(?!\.\d){_END}",
    "phone": rf"(?:\+\d{{1,3}}[ .-]?(?:\(\d{{1,4}}\)[ .-]?)?\d{{2,4}}(?:[ .-]?\d{{2,4}}){{1,4}}|(?<![+.-])(?:\(\d{{3}}\) ?|\d{{3}}[ .-])\d{{3}}[ .-]\d{{4}}){_END}",
    "card": rf"(?:\d{{4}}[ -]\d{{4}}[ -]\d{{4}}[ -]\d{{4}}|\d{{13,19}}){_END}",
    "ssn": rf"(?<!-)\d{{3}}-\d{{2}}-\d{{4}}(?!-){_END}",
    "name": rf"(?=[DFHMPS]){TITLE}\p{{Lu}}\p{{Ll}}+(?:[ -]\p{{Lu}}\p{{Ll}}+){{0,2}}",
}
NAME_WORD = r"\p{Lu}\p{Ll}+(?:-\p{Lu}\p{Ll}+)*"
TITLED = rf"(?=[DFHMPS])(?:{MALE_TITLES}|{FEMALE_TITLES}|{OTHER_TITLES})[. ]"
#: A word in small letters that is no part of an address or a compound.
SMALL_WORD = r"(?<![\p{L}\p{N}.@/_-])\p{Ll}{2,}+(?![\p{L}\p{N}@/_-]|\.[\p{L}\p{N}])"
_any = lambda *kinds: "|".join(f"(?:{PATTERNS[k]})" for k in kinds)
#: An entity begins where no letter or digit stands before; then its first character decides what it can be.
ENTITY = rf"(?<![\p{{L}}\p{{N}}])(?:(?=\p{{L}})(?:{_any('email', 'secret', 'iban', 'name')})|(?=[\d+(])(?:{_any('email', 'secret', 'ip', 'phone', 'card', 'ssn')}))"
#: Every entity has a digit, an @, a title, the start of a key or 32 hex letters: texts without any are not searched further.
SIGN = rf"[\d@]|AKIA|gh[pousr]_|sk-|[a-f]{{32}}|[A-F]{{32}}|{TITLED}"


def digits_of(c: Column) -> Column:
    return F.regexp_replace(c, r"[^0-9]", "")


def type_of(found: Column) -> Column:
    kinds = F.when(found.contains("@"), "email").when(found.rlike(f"^(?:{PATTERNS['secret']})$"), "secret").when(found.rlike(f"^(?:{PATTERNS['iban']})$"), "iban")
    kinds = kinds.when(found.rlike(r"^\d{1,3}(?:\.\d{1,3}){3}$"), "ip").when(found.rlike(r"^\d{3}-\d{2}-\d{4}$"), "ssn")
    return kinds.when(found.rlike(f"^(?:{PATTERNS['card']})$"), "card").when(found.rlike(r"^[+(0-9]"), "phone").otherwise("name")


def normal_form(kind: Column, found: Column) -> Column:
    """What all mentions of an entity have in common."""
    form = F.when(kind == "email", F.lower(found)).when(kind == "phone", F.concat(F.when(found.startswith("+"), "+").otherwise(""), digits_of(found)))
    return form.when(kind.isin("card", "ssn"), digits_of(found)).when(kind == "iban", F.regexp_replace(found, " ", "")).otherwise(found)


def entities_of(kind: Column, found: Column) -> Column:
    """The entities (kind, form) of a mention: itself, or each word of a name. A given name's form begins with its gender."""
    titled = F.when(found.rlike(rf"^(?:{MALE_TITLES})[. ]"), "m:").when(found.rlike(rf"^(?:{FEMALE_TITLES})[. ]"), "f:")
    gender = lambda w: F.coalesce(titled, F.when(F.array_contains(listed(MALE_NAMES), w), "m:"), F.when(F.array_contains(listed(FEMALE_NAMES), w), "f:"), F.lit("n:"))
    words = F.split(F.lower(F.regexp_replace(found, f"^{TITLE}", "")), " ")
    given = lambda w: F.struct(F.lit("given").alias("kind"), F.concat(gender(w), w).alias("form"))
    name = F.transform(words, lambda w, i: F.when(i < F.size(words) - 1, given(w)).otherwise(F.struct(F.lit("family").alias("kind"), w.alias("form"))))
    return F.when(kind == "name", name).otherwise(F.array(F.struct(kind.alias("kind"), normal_form(kind, found).alias("form"))))


def keyed(key: str, kind: Column, form: Column, attempt: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), kind, form, attempt.cast("string")), 512)


def byte(digest: Column, i: Column | int) -> Column:
    at = (i if isinstance(i, Column) else F.lit(i)) % 64
    return F.conv(F.substring(digest, at * 2 + 1, F.lit(2)), 16, 10).cast("int")


def pick(choices: list[str], n: Column) -> Column:
    return F.element_at(listed(choices), (n % len(choices) + 1).cast("int"))


def listed(choices: list[str]) -> Column:
    """An array literal, after constant folding: one literal is planned much faster than one for each choice."""
    return F.split(F.lit(",".join(choices)), ",")


def like(c: Column, n: Column) -> Column:
    """A character of the kind, case and script of c."""
    own = F.get(F.filter(listed(ALPHABETS), lambda a: F.contains(a, c)), 0)
    own = F.coalesce(own, F.when(c.rlike(r"^\p{Lu}"), ALPHABETS[2]).when(c.rlike(r"^\p{L}"), ALPHABETS[1]))
    return F.coalesce(F.substring(own, (n % F.length(own) + 1).cast("int"), F.lit(1)), c)


def per_character(text: Column, change: Callable[[Column, Column], Column]) -> Column:
    return F.array_join(F.transform(F.split(text, ""), change), "")


def luhn_sum(digits: Column) -> Column:
    def add(total: Column, c: Column, even: Column) -> Column:
        n = c.cast("int") * F.when(even, 2).otherwise(1)
        return total + F.when(n > 9, n - 9).otherwise(n)

    zero = F.struct(F.lit(0).alias("total"), F.lit(False).alias("even"))
    return F.aggregate(F.split(F.reverse(digits), ""), zero, lambda s, c: F.struct(add(s["total"], c, s["even"]).alias("total"), (~s["even"]).alias("even")))["total"]


def rest_97(account: Column) -> Column:
    """An account number modulo 97 as its check digits are counted: the first four characters last, letters as 10 to 35."""
    turned = F.split(F.concat(F.substring(account, F.lit(5), F.length(account)), F.substring(account, 1, 4)), "")
    step = lambda n, c: F.when(c.rlike("[0-9]"), (n * 10 + c.cast("int")) % 97).otherwise((n * 100 + F.ascii(c) - 55) % 97)
    return F.aggregate(turned, F.lit(0), step)


def private_head(form: Column) -> Column:
    return F.regexp_extract(form, r"^(?:10|127|192\.168|172\.(?:1[6-9]|2\d|3[01]))\.", 0)


def surrogate(kind: Column, form: Column, digest: Column, host_digest: Column, again: bool = False) -> Column:
    """The normal form of an entity's surrogate. Given names are listed ones first, `again` made up."""
    same_kind = lambda c, i: like(c, byte(digest, i))
    local, host = F.substring_index(form, "@", 1), F.substring_index(form, "@", -1)
    ending = F.regexp_extract(host, r"\.[^.]*$", 0)
    body = F.substring(host, F.lit(1), F.length(host) - F.length(ending))
    email = F.concat(per_character(local, same_kind), F.lit("@"), per_character(body, lambda c, i: like(c, byte(host_digest, i))), ending)
    hexes = "0123456789abcdef"
    is_hex = form.rlike("^(?:[0-9a-f]+|[0-9A-F]+)$")
    one_hex = lambda c, i: F.substring(F.when(form.rlike("[A-F]"), hexes.upper()).otherwise(hexes), byte(digest, i) % 16 + 1, F.lit(1))
    start = F.length(F.regexp_extract(form, r"^(?:AKIA|gh[pousr]_|sk-)", 0))
    secret = F.when(is_hex, per_character(form, one_hex)).otherwise(per_character(form, lambda c, i: F.when(i < start, c).otherwise(like(c, byte(digest, i)))))
    account = per_character(form, lambda c, i: F.when(i < 2, c).otherwise(like(c, byte(digest, i))))
    country, number = F.substring(form, 1, 2), F.substring(account, F.lit(5), F.length(form))
    checked = F.concat(country, F.lpad((98 - rest_97(F.concat(country, F.lit("00"), number))).cast("string"), 2, "0"), number)
    iban = F.when(rest_97(form) == 1, checked).otherwise(account)
    private = private_head(form)
    left = 4 - (F.length(private) - F.length(F.replace(private, F.lit("."))))
    octet = lambda i: F.when((i == 1) & (left == 4), F.lit(11) + byte(digest, i) % 100 + F.when(byte(digest, i) % 100 >= 80, 48).otherwise(0)).otherwise(byte(digest, i) % 254 + 1).cast("string")
    ip = F.concat(private, F.array_join(F.transform(F.sequence(F.lit(1), left), octet), "."))
    keeps = F.when(form.startswith("+"), 2).otherwise(0)
    phone = per_character(form, lambda c, i: F.when(i < keeps, c).when(i == keeps, (byte(digest, i) % 8 + 2).cast("string")).otherwise((byte(digest, i) % 10).cast("string")))
    ssn = per_character(form, same_kind)
    drawn = per_character(form, lambda c, i: F.when(i == 0, c).otherwise((byte(digest, i) % 10).cast("string")))
    head = F.substring(drawn, F.lit(1), F.length(form) - 1)
    valid = F.concat(head, ((F.lit(10) - luhn_sum(F.concat(head, F.lit("0"))) % 10) % 10).cast("string"))
    card = F.when(luhn_sum(form) % 10 == 0, valid).otherwise(drawn)
    syllables = F.concat(*[pick(SYLLABLES, byte(digest, k)) for k in range(3)], F.when(byte(digest, 3) % 2 == 0, pick(SYLLABLES, byte(digest, 4))).otherwise(""))
    two = byte(digest, 5) * 256 + byte(digest, 6)
    by_gender = lambda m, f, n: F.when(form.startswith("m:"), pick(m, two)).when(form.startswith("f:"), pick(f, two)).otherwise(pick(n, two))
    given = F.concat(syllables, by_gender(["us", "o", "an", "ik"], ["a", "ia", "ine", "ette"], ["i", "en", "ey", "on"])) if again else by_gender(MALE_NAMES, FEMALE_NAMES, ANY_NAMES)
    family = F.concat(syllables, pick(["n", "r", "rn", "ck", "ld", "nt", "sk", "tz"], byte(digest, 7)))
    word = F.when(kind == "given", F.substring(form, F.lit(3), F.length(form))).otherwise(form)
    spelt = per_character(word, same_kind)
    gender = F.when(kind == "given", F.substring(form, 1, 2)).otherwise("")
    name = F.concat(gender, F.when(word.rlike(r"[^\x00-ɏ]"), spelt).when(kind == "given", given).otherwise(family))
    return F.when(kind == "email", email).when(kind == "secret", secret).when(kind == "iban", iban).when(kind == "ip", ip).when(kind == "phone", phone).when(kind == "ssn", ssn).when(kind == "card", card).otherwise(name)


def in_format(kind: Column, found: Column, news: Column) -> Column:
    """The surrogates' normal forms in the format of a mention."""
    new = news[0]
    figures = digits_of(new)
    step = lambda s, c: F.when(c.rlike("[0-9]"), F.struct(F.concat(s["text"], F.substring(figures, s["at"] + 1, F.lit(1))).alias("text"), (s["at"] + 1).alias("at"))).otherwise(F.struct(F.concat(s["text"], c).alias("text"), s["at"].alias("at")))
    laid = F.aggregate(F.split(found, ""), F.struct(F.lit("").alias("text"), F.lit(0).alias("at")), step)["text"]
    spaced = F.aggregate(F.split(found, ""), F.struct(F.lit("").alias("text"), F.lit(0).alias("at")), lambda s, c: F.when(c == " ", F.struct(F.concat(s["text"], c).alias("text"), s["at"].alias("at"))).otherwise(F.struct(F.concat(s["text"], F.substring(new, s["at"] + 1, F.lit(1))).alias("text"), (s["at"] + 1).alias("at"))))["text"]
    name = F.concat(F.regexp_extract(found, f"^{TITLE}", 0), F.initcap(F.array_join(F.transform(news, shown), " ")))
    cased = F.when(F.upper(found) == found, F.upper(new)).otherwise(new)
    return F.when(kind.isin("phone", "card", "ssn"), laid).when(kind == "iban", spaced).when(kind == "name", name).when(kind == "email", cased).otherwise(new)


def shown(form: Column) -> Column:
    """A normal form without the gender of a given name."""
    return F.regexp_replace(form, "^[mfn]:", "")


def common_words(docs: DataFrame, text: str, words: DataFrame) -> DataFrame:
    """Those of `words` (word in small letters, n titled names that hold it) that are ordinary words of the corpus too:
    it has them in small letters at least `COMMON` times as often. Counts are summed before they are shuffled."""
    seen = docs.select(F.explode(F.regexp_extract_all(text, F.lit(SMALL_WORD), F.lit(0))).alias("word")).groupBy("word").agg(F.count("*").alias("seen"))
    return words.join(seen, "word").where(F.col("seen") >= COMMON * F.col("n")).select("word")


def names_again(docs: DataFrame, text: str) -> DataFrame | None:
    """(row, pattern) by the hash of a text: a pattern of the names to look for in it without a title; None without any.

    Looked for are the full and the family names that the text has with a title, and full names that any other text has
    with a title, together with their family names. A family name that is an ordinary word too (`common_words`) is not
    looked for alone, and a full name whose given name is one only in texts that have it with a title.
    """
    row = F.xxhash64(text).alias("row")
    mentions = F.regexp_extract_all(text, F.lit(rf"(?<![\p{{L}}\p{{N}}]){PATTERNS['name']}"), F.lit(0))
    titled = docs.where(F.col(text).rlike(TITLED)).select(row, F.explode(mentions).alias("name")).withColumn("name", F.regexp_replace("name", f"^{TITLE}", ""))
    titled = checkpoint(titled.groupBy("row", "name").agg(F.count("*").alias("n")))
    if titled.isEmpty():
        return None
    names = titled.groupBy("name").agg(F.sum("n").alias("n"))
    words = names.select(F.explode(F.split(F.lower("name"), " ")).alias("word"), "n").groupBy("word").agg(F.sum("n").alias("n"))
    common = checkpoint(common_words(docs, text, words))
    pair = F.regexp_extract("name", rf"{NAME_WORD} {NAME_WORD}$", 0)
    pairs = names.select(pair.alias("name")).where("name <> ''").distinct().withColumn("word", F.lower(F.substring_index("name", " ", 1)))
    pairs = checkpoint(pairs.join(common, "word", "left_anti").select("name"))
    # overlapping: the first of "Today Anna Schmidt" must not hide the second
    places = F.regexp_extract_all(text, F.lit(rf"(?<![\p{{L}}\p{{N}}])(?=({NAME_WORD} {NAME_WORD}){_END})"), F.lit(1))
    untitled = docs.select(row, F.explode(F.array_distinct(places)).alias("name"))
    untitled = untitled.join(F.broadcast(pairs) if pairs.count() <= MAX_BROADCAST_ROWS else pairs, "name").select("row", "name")
    full = checkpoint(titled.select("row", "name").unionByName(untitled).distinct())
    last = F.substring_index("name", " ", -1)
    family = full.where((F.length(last) > 2) | (last == F.col("name"))).select("row", last.alias("name"), F.lower(last).alias("word"))
    family = family.join(common, "word", "left_anti").select("row", "name")
    each = full.where(F.col("name").contains(" ")).unionByName(family).groupBy("row").agg(F.collect_set(F.struct((-F.length("name")).alias("n"), "name")).alias("names"))
    longest_first = F.array_join(F.transform(F.array_sort("names"), lambda x: x["name"]), "|")
    return checkpoint(each.select("row", F.concat(F.lit(rf"{ENTITY}|(?<![\p{{L}}\p{{N}}])(?:"), longest_first, F.lit(f"){_END}")).alias("pattern")))


def by_row(docs: DataFrame, text: str, rows: DataFrame, row: str) -> DataFrame:
    """docs with the columns of `rows`, found by the hash of the text; broadcast if they are few."""
    n = rows.count()
    return docs.withColumn(row, F.xxhash64(text)).join(F.broadcast(rows) if n <= MAX_BROADCAST_ROWS else rows, row, "left").drop(row)


def shape(kind: Column, form: Column) -> Column:
    """What a surrogate has in common with its entity: entities of a shape can stand for each other."""
    plain = form
    for a, b in ((r"[0-9]", "0"), (r"[а-я]", "я"), (r"[А-Я]", "Я"), (r"[α-ω]", "ω"), (r"[Α-Ω]", "Ω"), (r"\p{Ll}", "a"), (r"\p{Lu}", "A")):
        plain = F.regexp_replace(plain, a, b)
    name = F.concat(F.regexp_extract(form, "^[mfn]:", 0), F.when(form.rlike(r"[^\x00-ɏ]"), plain).otherwise(""))
    out = F.when(kind.isin("given", "family"), name).when(kind == "ip", private_head(form)).when(kind == "card", F.concat(plain, (luhn_sum(form) % 10 == 0).cast("string")))
    out = out.when(kind == "iban", F.concat(F.substring(form, 1, 2), plain, (rest_97(form) == 1).cast("string"))).when(kind == "phone", F.concat(F.substring(form, 1, 2), plain))
    return out.when(kind == "email", F.concat(plain, F.regexp_extract(form, r"\.[^.]*$", 0))).otherwise(plain)


def tried_surrogates(entities: DataFrame, key: str, attempt: int) -> DataFrame:
    host = F.substring_index("form", "@", -1)
    made = entities.withColumn("digest", keyed(key, F.col("kind"), F.col("form"), F.lit(attempt))).withColumn("host_digest", keyed(key, F.lit("host"), host, F.lit(0)))
    return made.withColumn("new", surrogate(F.col("kind"), F.col("form"), F.col("digest"), F.col("host_digest"), attempt > 0)).drop("digest", "host_digest").withColumn("shown", shown(F.col("new")))


def turned_round(left: DataFrame, entities: DataFrame, key: str) -> DataFrame:
    """(kind, form, new) of entities that no draw was free for: each has the form of the next one of its shape.

    A single one has that of another entity of its shape, whose own surrogate is none of the forms that occur.
    """
    left = left.withColumn("shape", shape(F.col("kind"), F.col("form")))
    sizes = left.groupBy("kind", "shape").count().withColumnsRenamed({"kind": "_kind", "shape": "_shape"})
    left = left.join(sizes, (F.col("kind") == F.col("_kind")) & (F.col("shape") == F.col("_shape")))
    left = left.withColumns({"part": F.pmod(F.xxhash64("form"), F.ceil(F.col("count") / ROUND)), "turn": keyed(key, F.col("kind"), F.col("form"), F.lit(-1))})
    ring = Window.partitionBy("kind", "shape", "part").orderBy("turn", "form")
    next_one = F.coalesce(F.lead("form").over(ring), F.first("form").over(ring))
    left = checkpoint(left.select("kind", "shape", "form", next_one.alias("new")))
    alone = left.where("form = new").select("kind", "shape", "form")
    known = entities.select("kind", shape(F.col("kind"), F.col("form")).alias("shape"), F.col("form").alias("other"))
    others = known.join(alone, ["kind", "shape"]).where("form <> other").groupBy("kind", "form").agg(F.min("other").alias("other"))
    made = tried_surrogates(alone.select("kind", "form"), key, ATTEMPTS).join(others, ["kind", "form"], "left")
    return left.where("form <> new").select("kind", "form", "new").unionByName(made.select("kind", "form", F.coalesce("other", "new").alias("new")))


def looked_up(entities: DataFrame, key: str) -> DataFrame:
    """(kind, form, new) of the distinct entities whose surrogate is not that of their first attempt."""
    # a given name of unknown gender is the one with a gender, if there is one alone
    bare = F.substring("form", F.lit(3), F.length("form"))
    gendered = entities.where("kind = 'given' and form not like 'n:%'").groupBy(bare.alias("bare")).agg(F.min("form").alias("of"), F.count("*").alias("n")).where("n = 1").drop("n")
    same = checkpoint(entities.where("kind = 'given' and form like 'n:%'").withColumn("bare", bare).join(gendered, "bare").select("kind", "form", "of"))
    taken = entities.select("kind", shown(F.col("form")).alias("shown")).distinct()  # what occurs is no surrogate
    todo, moved, settled = entities.join(same, ["kind", "form"], "left_anti"), None, None
    for attempt in range(ATTEMPTS):
        tried = tried_surrogates(todo.select("kind", "form"), key, attempt)
        used = taken if settled is None else taken.unionByName(settled)
        won = tried.join(used, ["kind", "shown"], "left_anti").groupBy("kind", "shown").agg(F.min(F.struct("form", "new")).alias("x"))
        won = checkpoint(won.select("kind", "shown", "x.*"))
        todo = checkpoint(tried.select("kind", "form").join(won, ["kind", "form"], "left_anti"))
        settled = won.select("kind", "shown") if settled is None else settled.unionByName(won.select("kind", "shown"))
        step = won.select("kind", "form", "new")
        moved = step.limit(0) if moved is None else moved.unionByName(step)
        if todo.isEmpty():
            break
    else:
        moved = moved.unionByName(checkpoint(turned_round(todo, entities, key)))
    first = tried_surrogates(same.select("kind", F.col("of").alias("form"), F.col("form").alias("mention")), key, 0).select("kind", F.col("form").alias("of"), "mention", F.col("new").alias("first"))
    other = first.join(moved.select("kind", F.col("form").alias("of"), "new"), ["kind", "of"], "left").select("kind", F.col("mention").alias("form"), F.coalesce("new", "first").alias("new"))
    return moved.unionByName(other)


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """The same rows and columns with surrogates in `text`, and the long `n_entities`, the number of mentions."""
    name = free_name(docs, "n_entities")
    found, row, moved, pattern = (free_name(docs, x) for x in ("_found", "_row", "_moved", "_pattern"))
    typed = lambda found: F.transform(found, lambda m: F.struct(m.alias("found"), type_of(m).alias("kind")))
    parts = lambda typed: F.transform(typed, lambda x: F.struct(x["found"].alias("found"), x["kind"].alias("kind"), entities_of(x["kind"], x["found"]).alias("parts")))
    first = F.when(F.col(text).rlike(SIGN), F.regexp_extract_all(text, F.lit(ENTITY), F.lit(0)))
    again = names_again(docs, text)
    if again is None:
        marked = docs.withColumn(found, first).withColumn(pattern, F.lit(None).cast("string"))
    else:
        marked = by_row(docs, text, again.withColumnsRenamed({"row": row, "pattern": pattern}), row)
        marked = marked.withColumn(found, F.when(F.col(pattern).isNotNull(), F.regexp_extract_all(text, F.col(pattern), F.lit(0))).otherwise(first))
    hits = marked.where(F.size(found) > 0).select(F.xxhash64(text).alias("row"), F.explode(F.array_distinct(F.flatten(F.transform(parts(typed(F.col(found))), lambda x: x["parts"])))).alias("m"))
    hits = checkpoint(hits.select("row", "m.kind", "m.form").distinct())
    late = checkpoint(looked_up(hits.select("kind", "form").distinct(), key))
    rows = hits.join(late, ["kind", "form"]).groupBy("row").agg(F.map_from_entries(F.collect_set(F.struct(F.concat("kind", F.lit("|"), "form"), "new"))).alias(moved))
    rows = checkpoint(rows.withColumnRenamed("row", row))
    if not rows.isEmpty():
        marked = by_row(marked, text, rows, row)
        known = lambda e: F.try_element_at(F.col(moved), F.concat(e["kind"], F.lit("|"), e["form"]))
    else:
        known = lambda e: F.lit(None).cast("string")
    host = lambda e: F.substring_index(e["form"], "@", -1)
    digests = lambda e: F.struct(e["kind"].alias("kind"), e["form"].alias("form"), known(e).alias("known"), keyed(key, e["kind"], e["form"], F.lit(0)).alias("digest"), keyed(key, F.lit("host"), host(e), F.lit(0)).alias("host_digest"))
    new = lambda e: F.coalesce(e["known"], surrogate(e["kind"], e["form"], e["digest"], e["host_digest"]))
    written = F.transform(parts(typed(F.col(found))), lambda x: in_format(x["kind"], x["found"], F.transform(F.transform(x["parts"], digests), new)))
    between = F.when(F.col(pattern).isNotNull(), F.split(F.col(text), F.col(pattern), -1)).otherwise(F.split(F.col(text), ENTITY, -1))
    joined = F.array_join(F.zip_with(between, F.concat(written, F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    out = marked.withColumn(text, F.when(F.size(found) > 0, joined).otherwise(F.col(text))).withColumn(name, F.coalesce(F.size(found), F.lit(0)).cast("long"))
    return out.select(*docs.columns, name)
