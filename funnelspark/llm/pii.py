"""Surrogates for personal data, with DataFrame functions only.

Entities are found by one ordered pattern (e-mail, secret token, IP address, social security number, phone, card number, titled
name). An entity's core (digits, lower-case address or name) and a key give a keyed hash; from it a replacement of the same type and format is
made: separators, length, letter case and country code stay, card numbers keep issuer digit and checksum validity, names keep
gender, script and number of words. Equal cores get equal replacements everywhere (coreference).

*Collision check.* All distinct cores of the corpus are gathered by a grouped aggregate; where a replacement is shared by two cores, or is
itself a core of the corpus, the later ones (in key order) are given another attempt, until none is left. Such attempts are rare;
texts with one are told by a join on the text's hash (its small side is a written table, so Spark knows its size). All other texts
are replaced where the scan put them.

Defined results: NULL stays NULL; texts without entities are unchanged; overlapping candidates go to the earlier, then to the earlier
type in the list; repeated rows get equal results; other columns stay as they are (``n_chars`` follows the text).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from funnelspark.session import materialise

_MALE = "Mr|Herr|Señor|Monsieur|Господин"
_FEMALE = "Mrs|Ms|Miss|Frau|Señora|Señorita|Madame|Mademoiselle|Госпожа"
#: Types in order of precedence, each with its pattern.
PATTERNS = {
    "email": r"[\p{L}\p{N}._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "secret": r"(?<![0-9A-Za-z])(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})(?![0-9A-Za-z])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "phone": r"(?:\+\d{1,3}[ .-]?)(?:\(\d{2,4}\)|\d{2,4})[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<!\d)\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d-])\d{3}-\d{3}-\d{4}(?![\d-])",
    "card": r"(?<!\d)\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,7}(?!\d)",
    "name": rf"(?<!\p{{L}})(?:{_MALE}|{_FEMALE})\.? \p{{Lu}}[\p{{L}}'-]+(?: \p{{Lu}}[\p{{L}}'-]+)?",
}
_ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
#: A cheap test that every text with an entity passes.
_MAYBE = rf"@|[0-9A-Fa-f]{{32}}|\d[\d ().-]{{5,}}\d|(?:{_MALE}|{_FEMALE})\.? \p{{Lu}}"
# Syllables of made-up names (fixed values, not a list of real names).
_LATIN = "ba be bi bo da de di do fa fe fi ga go ka ke ki la le li lo ma me mi mo na ne ni no pa pe ra ri ro sa se ta te to va ve vi za".split()
_CYRILLIC = "ба бе би бо да де ди до фа фе га го ка ке ки ла ле ли ло ма ме ми мо на не ни но па пе ра ри ро са се та те то ва ве ви за".split()


def kind_of(raw: Column) -> Column:
    """Type of a whole entity."""
    out = F.when(F.lit(False), F.lit(""))
    for name, p in PATTERNS.items():
        out = out.when(raw.rlike(rf"^(?:{p})$"), F.lit(name))
    return out.otherwise(F.lit("card"))


def core_of(kind: Column, raw: Column) -> Column:
    """What makes two mentions the same entity."""
    plain = F.lower(F.trim(raw))
    return (
        F.when(kind.isin("phone", "card", "ssn"), F.regexp_replace(raw, "[^0-9]", ""))
        .when(kind == "name", F.regexp_replace(F.regexp_replace(plain, rf"(?i)^(?:{_MALE}|{_FEMALE})\.? ", ""), r"\s+", " "))
        .otherwise(plain)
    )


def gender_of(kind: Column, raw: Column) -> Column:
    return F.when(kind == "name", F.when(raw.rlike(rf"^(?:{_FEMALE})(?![\p{{L}}])"), F.lit("f")).otherwise(F.lit("m"))).otherwise(F.lit(""))


def _digits(h: Column) -> Column:
    """48 decimal digits of a hex hash."""
    part = lambda k: F.substring(F.lpad(F.conv(F.substring(h, 1 + 15 * k, 15), 16, 10), 18, "0"), 3, 16)
    return F.concat(part(0), part(1), part(2))


def _luhn(digits: Column) -> Column:
    """Checksum of a digit string, counted from its right end."""
    chars = F.split(F.reverse(digits), "")
    value = F.transform(F.filter(chars, lambda c: c != ""), lambda c, i: F.when(i % 2 == 1, F.element_at(F.array(*map(F.lit, (0, 2, 4, 6, 8, 1, 3, 5, 7, 9))), c.cast("int") + 1)).otherwise(c.cast("int")))
    return F.aggregate(value, F.lit(0), lambda a, b: a + b) % 10


def _fill(raw: Column, digits: Column) -> Column:
    """``raw`` with its digits replaced in turn."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))
    step = lambda s, c: F.when(
        c.between("0", "9") & (F.length(c) == 1), F.struct(F.concat(s.out, F.substring(digits, s.k, F.lit(1))).alias("out"), (s.k + 1).alias("k"))
    ).otherwise(F.struct(F.concat(s.out, c).alias("out"), s.k.alias("k")))
    return F.aggregate(F.filter(F.split(raw, ""), lambda c: c != ""), start, step, lambda s: s.out)


def _name(h: Column, gender: Column, script: Column, words: Column, attempt: Column) -> Column:
    """A made-up name: given name with an ending by gender, then a family name, where the original has two words.

    Each further attempt has a syllable more, so there are more made-up names than any corpus has names.
    """
    def syllable(digits: Column) -> Column:
        i = F.conv(digits, 16, 10).cast("int") % len(_LATIN) + 1
        return F.when(script == "cyrillic", F.element_at(F.array(*map(F.lit, _CYRILLIC)), i)).otherwise(F.element_at(F.array(*map(F.lit, _LATIN)), i))

    def pick(k: int) -> Column:
        return syllable(F.substring(h, 1 + 4 * k, 4))

    ending = F.when(script == "cyrillic", F.when(gender == "f", F.lit("на")).otherwise(F.lit("н"))).otherwise(F.when(gender == "f", F.lit("na")).otherwise(F.lit("n")))
    family_end = F.when(script == "cyrillic", F.when(gender == "f", F.lit("ва")).otherwise(F.lit("в"))).otherwise(F.when((gender == "f") & (words == 1), F.lit("ra")).otherwise(F.lit("r")))
    further = F.transform(F.sequence(F.lit(1), attempt), lambda k: syllable(F.substring(F.sha2(F.concat_ws("|", h, k.cast("string")), 256), 1, 4)))
    more = F.when(attempt > 0, F.array_join(further, "")).otherwise(F.lit(""))
    given, family = F.concat(pick(0), pick(1), ending), F.concat(pick(2), pick(3), pick(4), more, family_end)
    return F.when(words > 1, F.concat(given, F.lit(" "), family)).otherwise(family)


def keyed_hash(kind: Column, core: Column, attempt: Column, key: str) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), kind, core, attempt.cast("string")), 256)


def surrogate_core(kind: Column, core: Column, gender: Column, h: Column, attempt: Column) -> Column:
    """Replacement of a core, made from its keyed hash; the same for every mention of it."""
    d = _digits(h)
    n = F.length(core)
    first = F.substring(core, 1, 1)
    # Card: issuer digit, new digits, and the last digit that leaves the checksum as it was.
    body = F.concat(first, F.substring(d, F.lit(1), n - 2))
    off = (_luhn(core) - _luhn(F.concat(body, F.lit("0"))) + 10) % 10
    octet = lambda k, low, size: (F.conv(F.substring(h, 1 + 4 * k, 4), 16, 10).cast("int") % size + low).cast("string")
    letters = F.translate(F.substring(h, 1, 16), "0123456789", "ghijklmnop")
    tail = F.regexp_extract(core, r"([._+-]?\d*)@", 1)
    tld = F.regexp_extract(core, r"\.(com|org|net)$", 1)
    email = F.concat(letters, F.regexp_replace(F.substring(tail, 1, 1), "[0-9]", ""), F.substring(d, F.lit(1), F.length(F.regexp_replace(tail, "[^0-9]", ""))), F.lit("@mail"), F.substring(d, 41, 2), F.lit(".example."), F.when(tld == "", F.lit("com")).otherwise(tld))
    script = F.when(core.rlike(r"\p{IsCyrillic}"), F.lit("cyrillic")).otherwise(F.lit("latin"))
    return (
        F.when(kind == "email", email)
        .when(kind == "secret", F.substring(F.concat(h, F.sha2(h, 256)), F.lit(1), n))
        .when(kind == "ip", F.concat_ws(".", octet(0, 1, 223), octet(1, 0, 256), octet(2, 0, 256), octet(3, 1, 254)))
        .when(kind == "card", F.concat(body, off.cast("string")))
        .when(kind == "name", _name(h, gender, script, F.size(F.split(core, " ")), attempt))
        .otherwise(F.substring(d, F.lit(1), n))
    )


def _shown(kind: Column, raw: Column, new: Column) -> Column:
    """A replacement in the format of one mention: separators, letter case, title and country code of the original."""
    country = F.regexp_extract(raw, r"^\+(\d{1,3})(?=[ .(-])", 1)
    digits = F.concat(country, F.substring(new, F.length(country) + 1, F.length(new)))
    title = F.regexp_extract(raw, rf"^((?:{_MALE}|{_FEMALE})\.? )", 1)
    upper = (raw == F.upper(raw)) & (raw != F.lower(raw))
    return (
        F.when(kind == "phone", _fill(raw, digits))
        .when(kind.isin("card", "ssn"), _fill(raw, new))
        .when(kind == "name", F.concat(title, F.initcap(new)))
        .when(upper, F.upper(new))
        .otherwise(new)
    )


def mentions(text: Column) -> Column:
    """The entities of a text, in order."""
    return F.when(text.rlike(_MAYBE), F.regexp_extract_all(text, F.lit(f"({_ANY})"), 1)).otherwise(F.array().cast("array<string>"))


def _phone_core(kind: Column, raw: Column, core: Column) -> Column:
    """Phone cores remember the length of their country code, which their replacement keeps."""
    country = F.length(F.regexp_extract(raw, r"^\+(\d{1,3})(?=[ .(-])", 1))
    return F.when(kind == "phone", F.concat(F.lit("+"), country.cast("string"), F.lit(":"), core)).otherwise(core)


def _final(kind: Column, core: Column, gender: Column, h: Column, attempt: Column) -> Column:
    """Replacement as compared by the collision check: phones with their country code as it stays."""
    plain = F.regexp_replace(core, r"^\+\d:", "")
    code = F.when(kind == "phone", F.substring(core, 2, 1).cast("int")).otherwise(F.lit(0))
    new = surrogate_core(kind, plain, gender, h, attempt)
    return F.when(kind == "phone", F.concat(F.substring(core, 1, 3), F.substring(plain, F.lit(1), code), F.substring(new, code + 1, F.length(new)))).otherwise(new)


def attempts(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """(th, attempt by core): the entities that need another attempt, with the hash of every text that mentions one."""
    raw = F.col("_m")
    found = docs.where(F.col(text).isNotNull() & F.col(text).rlike(_MAYBE)).select(F.xxhash64(text).alias("th"), F.explode(F.array_distinct(mentions(F.col(text)))).alias("_m"))
    found = found.withColumn("kind", kind_of(raw)).withColumn("gender", gender_of(F.col("kind"), raw)).withColumn("core", _phone_core(F.col("kind"), raw, core_of(F.col("kind"), raw)))
    found = materialise(found.select("th", "kind", "core", "gender").distinct(), "pii-mentions")
    # A name met under both titles is one entity; it is given the gender met first in the alphabet.
    cores = found.groupBy("kind", "core").agg(F.min("gender").alias("gender"))
    hashed = lambda df: df.withColumn("_h", keyed_hash(F.col("kind"), F.col("core"), F.col("attempt"), key))
    final = _final(F.col("kind"), F.col("core"), F.col("gender"), F.col("_h"), F.col("attempt"))
    state = materialise(hashed(cores.withColumn("attempt", F.lit(0))).withColumn("new", final).drop("_h"), "pii-cores")
    known = cores.select("kind", F.col("core").alias("new")).withColumn("real", F.lit(True))
    while True:
        # Of the cores that share a replacement the one with the most attempts behind it, then the least, keeps it.
        order = Window.partitionBy("kind", "new").orderBy(F.desc("attempt"), "core")
        checked = state.withColumn("_n", F.row_number().over(order)).join(known, ["kind", "new"], "left")
        again = (F.col("_n") > 1) | (F.col("real") & (F.col("new") != F.col("core"))) | ((F.col("new") == F.col("core")) & (F.col("attempt") < 8))
        checked = checked.select("kind", "core", "gender", "attempt", "new", F.coalesce(again, F.lit(False)).alias("again"))
        if checked.where("again").isEmpty():
            break
        attempt = F.col("attempt") + F.col("again").cast("int")
        state = materialise(
            hashed(checked.withColumn("attempt", attempt)).withColumn("new", F.when(F.col("again"), final).otherwise(F.col("new"))).drop("again", "_h"),
            "pii-cores",
        )
    tried = state.where((F.col("attempt") > 0) | (F.col("kind") == "name")).select("kind", "core", "gender", "attempt")
    return materialise(found.select("th", "kind", "core").join(tried, ["kind", "core"]).groupBy("th").agg(
        F.map_from_entries(F.collect_set(F.struct(F.concat_ws("|", "kind", "core").alias("k"), F.struct("gender", "attempt").alias("v")))).alias("tried")
    ), "pii-attempts")


def replace(docs: DataFrame, key: str, text: str = "text", count: str | None = None) -> DataFrame:
    """``docs`` with entities replaced; with ``count``, a column of that name (new to ``docs``) tells how many there were."""
    fixes = attempts(docs, key, text)
    held = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("_row"), F.xxhash64(docs[text]).alias("th"), docs[text].alias("_text")).join(fixes, "th", "left")
    held = held.withColumn("_found", F.coalesce(mentions(F.col("_text")), F.array().cast("array<string>")))

    # Each step computes once, per mention, what the next ones use.
    seen = F.transform("_found", lambda r: F.struct(r.alias("raw"), kind_of(r).alias("kind")))
    seen = F.transform(seen, lambda x: F.struct(x.raw.alias("raw"), x.kind.alias("kind"), _phone_core(x.kind, x.raw, core_of(x.kind, x.raw)).alias("core")))
    seen = F.transform(seen, lambda x: F.struct(x.raw.alias("raw"), x.kind.alias("kind"), x.core.alias("core"), F.try_element_at(F.col("tried"), F.concat_ws("|", x.kind, x.core)).alias("tried")))
    seen = F.transform(seen, lambda x: F.struct(
        x.raw.alias("raw"), x.kind.alias("kind"), F.regexp_replace(x.core, r"^\+\d:", "").alias("core"), F.coalesce(x.tried.gender, gender_of(x.kind, x.raw)).alias("gender"),
        keyed_hash(x.kind, x.core, F.coalesce(x.tried.attempt, F.lit(0)), key).alias("h"), F.coalesce(x.tried.attempt, F.lit(0)).alias("attempt"),
    ))
    seen = F.transform(seen, lambda x: F.struct(x.raw.alias("raw"), x.kind.alias("kind"), surrogate_core(x.kind, x.core, x.gender, x.h, x.attempt).alias("new")))
    new = F.transform(seen, lambda x: _shown(x.kind, x.raw, x.new))
    pieces = F.zip_with(F.split("_text", _ANY, -1), F.concat(new, F.array(F.lit(""))), lambda a, b: F.concat(F.coalesce(a, F.lit("")), F.coalesce(b, F.lit(""))))
    out = held.withColumn("_new", F.when(F.size("_found") > 0, F.array_join(pieces, "")).otherwise(F.col("_text")))
    cols = []
    for f in docs.schema.fields:
        if f.name == text:
            cols.append(F.col("_new").alias(text))
        elif f.name.lower() == "n_chars":
            cols.append(F.when(F.size("_found") > 0, F.length("_new")).otherwise(F.col(f"_row.`{f.name}`")).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col(f"_row.`{f.name}`").alias(f.name))
    return out.select(*cols, *([F.size("_found").cast("long").alias(count)] if count else []))


def surrogates(docs: DataFrame, key: str = "public-example-key", text: str = "text") -> DataFrame:
    """doc_id, n_entities and the new text of every row."""
    return replace(docs.select("doc_id", F.col(text).alias("text")), key, count="n_entities").select("doc_id", "n_entities", "text")
