"""Surrogates for personal data, in DataFrame and SQL functions only.

Entities are e-mail addresses, IP addresses, card numbers (valid Luhn sums),
phone numbers, social security numbers, IBANs, cloud keys, assigned passwords
and tokens, and names (after a title, or a listed first name before a
capitalised word). Every entity gets a replacement of its type, drawn from
SHA-256 over a secret key, the type, its normal form and an attempt number:

* letters, digits and separators keep their places and kinds; cards keep the
  first digit and a valid Luhn sum, IBANs the country and valid check digits,
  phones the country code, addresses the top-level domain, IP octets their
  number of digits;
* first names keep gender and script, surnames the script and a feminine
  ending;
* the normal form (digits only, lower-case address, ...) makes the forms of one
  entity one entity: it gets the same replacement in every form and document,
  and a domain or a name part keeps its replacement across addresses and names;
* collision checks: replacements that two entities of a type share, or that are
  an entity of the corpus themselves, are drawn again with the next attempt, in
  rounds over those alone, until all are distinct.

Entities are cut out with one pattern (pieces between matches, matches), the
distinct forms become a table, are normalised, replaced, checked and joined back
by form; a form in a third of all documents is a skewed join key, not a group. Only texts
that hold an entity are shuffled; all others pass as they are.

Null texts stay null with 0 entities, empty and clean texts stay as they are.
Repeated rows give repeated results; null keys are kept; an empty table gives
no row; other columns are kept as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trackwise.llm.batches import documents, drop_path, through_table, write_table

KEY = "surrogate-key"
#: after so many attempts an address or name part may change its length
LONGER = 4
#: attempts after which a type is taken to have no free replacement left
MOST_ATTEMPTS = 200

# First names by gender and script, titles, parts of made-up names.
FIRST = {
    "first_f": "Mary Anna Emma Laura Julia Sophie Claire Maria Elena Carmen Lucia Ingrid Greta Alice Helen Nora".split(),
    "first_m": "John James Peter Paul Thomas Michael David Hans Karl Jean Pierre Carlos Miguel Juan Robert Henry".split(),
    "first_f_cyr": "Анна Мария Елена Ольга Ирина Наталья Татьяна Светлана".split(),
    "first_m_cyr": "Иван Петр Сергей Николай Дмитрий Андрей Михаил Алексей".split(),
}
TITLES = "Mr Mrs Ms Dr Prof Herr Frau Monsieur Madame Mme Señor Señora Sra".split()
PARTS = {"lat": "bar den for gal hol ker lan mor nel per ros sel tal ver wil zan".split(),
         "cyr": "бар вол гор дан зим кал лес мир нов пол рус сав тур хол чер яр".split()}

_first = "|".join(n for ns in FIRST.values() for n in ns)
_title = "|".join(TITLES)
_word = r"\p{Lu}\p{Ll}{1,24}+"
_keys = "password|passwd|pwd|secret|token|api_key|apikey"
_edge = r"(?<![\w.@+-])"
# guards, bounds and possessive repeats keep the patterns linear on long texts
_email = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}+\.){1,8}+(?<=\.)[A-Za-z]{2,24}+(?![A-Za-z0-9-])"
_address = _edge + r"(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?![\w-]|\.\d)"
# Country codes of one and two digits (all others have three), and codes
# whose numbers have one length, by that length.
CODES = {1: "[17]", 2: "2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]"}
PLANS = {8: "45|47|65", 9: "27|31|32|33|34|41|48|61", 10: "1|7|44|91", 11: "86"}
#: the most digits of a phone number with its country code (E.164)
PHONE_DIGITS = 15
# a phone does not go on into what begins after a blank: an address, a number that is
# another entity or too long for a part of a phone, a date
_four = "[0-9]{4}(?:[ -][0-9]{4}){3}"
_gap = (rf"(?: (?!{_email}|{_address}|[0-9]{{13}}|{_four}(?:[ -]{_four})*+(?![ -][0-9]{{4}}(?![0-9]))|[0-9]{{4}}[ -][0-9]{{6}}[ -][0-9]{{5}}"
        r"|[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])|[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![\w-])|[0-9]{4}-[0-9]{2}-[0-9]{2}(?![\w-]))|[.-])?")
_digit = r"(?:[0-9](?=[0-9])|(?<=[0-9])[0-9])"       # not a digit alone


def _phone(code: str, least: int, most: int, area: tuple) -> str:
    """A country code and ``least`` to ``most`` digits, some of them an area in brackets."""
    return "|".join(rf"(?:{code})[ .-]?\([0-9]{{{a}}}\)(?:{_gap}{_digit}){{{max(least - a, 1)},{most - a}}}" for a in area if a) + (
        rf"|(?:{code})(?:[ .-]?\(0\))?{_gap}[0-9](?:{_gap}{_digit}){{{max(least - 1, 1)},{most - 1}}}")


_codes = {**CODES, 3: f"(?!{CODES[1]}|{CODES[2]})[0-9]{{3}}"}
_phones = (
    # of a length that is known: what follows is no part of it
    _edge + r"\+(?:" + "|".join(_phone(c, n, n, (2, 3, 4)) for n, c in PLANS.items()) + r")(?!\w|[.-]\d)",
    _edge + r"(?=\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)[ .-]?)?[0-9]{2,4}[ .-]?[0-9]{2,4})\+(?:"
    + "|".join(_phone(c, 5 - n, PHONE_DIGITS - n, (2, 3, 4)) for n, c in _codes.items()) + r")(?!\w)",
)
_numbers = (
    _email,
    _edge + r"AKIA[0-9A-Z]{16}(?![0-9A-Za-z])",
    _address,
    _edge + r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    _edge + r"[0-9](?:[ -]?[0-9]){12,18}(?![\w-]|\.\d)",
    *_phones,
    r"(?<![\w)+-])\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}(?![\w])",
    _edge + r"[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![\w-])",
    _edge + r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-])",
)
# an assigned value: 8 characters or more with a letter or digit, up to the closing quote or
# white space; after '=' a quoted one may hold blanks. Punctuation that ends it stays as it is.
_ends = r".,;:!?)\]}>"
_least = rf"(?=[^\s\"'\p{{L}}\p{{N}}]*+[\p{{L}}\p{{N}}])(?=\S{{7,}}[^\s\"'{_ends}])"
_assign = rf"(?i:{_keys}) {{0,2}}"
_value = "|".join((
    *(rf"= {{0,2}}{q}(?=[^\r\n{q}]{{8,256}}{q})(?=[^\r\n{q}\p{{L}}\p{{N}}]*+[\p{{L}}\p{{N}}])[^\r\n{q}]++" for q in "\"'"),
    rf"[=:] {{0,2}}\"(?=[^\s\"]{{8}}){_least}[^\s\"]++",
    rf"[=:] {{0,2}}'(?=[^\s']{{8}}){_least}[^\s']++",
    # a quote inside a bare value goes on before a letter or digit
    rf"[=:] {{0,2}}(?=(?:[^\s\"']|[\"'](?=[\p{{L}}\p{{N}}])){{8}}){_least}[^\s\"']++(?:[\"'](?=[\p{{L}}\p{{N}}])[^\s\"']++){{0,8}}+"))
#: spans of a text
SPANS = "|".join((
    *_numbers,
    rf"(?<![A-Za-z0-9_]){_assign}(?:{_value})",
    rf"(?<!\p{{L}})(?:{_title})[.]? {_word}(?: {_word})?(?!\p{{L}})",
    rf"(?<!\p{{L}})(?:{_first}) {_word}(?!\p{{L}})",
))
#: entities of a span
PATTERN = "|".join((
    rf"(?<=^{_assign}[=:] {{0,2}}[\"']?)[^\s\"'](?s:.*)(?<![\s\"'{_ends}])",
    *_numbers,
    rf"(?<=^(?:{_title})[.]? ){_word}(?!\p{{L}})",
    rf"(?<=^(?:{_title})[.]? \p{{Lu}}\p{{Ll}}{{1,24}} ){_word}(?!\p{{L}})",
    rf"(?<=^(?:{_first}) ){_word}(?!\p{{L}})",
    rf"^(?:{_first})(?= \p{{Lu}}\p{{Ll}})",
))
#: a span of an assigned value
ASSIGNED = rf"^{_assign}[=:]"
#: what every text with a span holds
CANDIDATE = " OR ".join((
    "contains(text, '@')", "text rlike '[0-9]'", "contains(text, 'AKIA')",
    f"text rlike '(?i:{_keys})'",
    rf"text rlike '(?<!\\p{{L}})(?=\\p{{Lu}})(?:{_title}|{_first})[.]? \\p{{Lu}}'"))


def _luhn(digits: str) -> str:
    """Luhn sum of a string of digits."""
    return (f"aggregate(sequence(1, length({digits})), 0, (s, i) -> s + "
            f"CASE WHEN i % 2 = 1 THEN cast(substr({digits}, -i, 1) AS int) "
            f"ELSE element_at(array(0, 2, 4, 6, 8, 1, 3, 5, 7, 9), cast(substr({digits}, -i, 1) AS int) + 1) END)")


_digits = "regexp_replace(form, '[^0-9]', '')"
_names = " ".join(f"WHEN form IN ({', '.join(repr(n) for n in ns)}) THEN '{kind}'" for kind, ns in FIRST.items())
#: type of a form; null: not an entity after all (a number without a Luhn sum)
KIND = f"""CASE
    WHEN instr(form, '@') > 0 THEN 'email'
    WHEN form rlike '^[0-9]+([.][0-9]+){{3}}$' AND length({_digits}) <= 12 THEN 'ip'
    {_names}
    WHEN form rlike '^\\\\p{{Lu}}\\\\p{{Ll}}+$' THEN CASE WHEN form rlike '^\\\\p{{IsCyrillic}}+$' THEN 'last_cyr' ELSE 'last' END
    WHEN form rlike '^AKIA[0-9A-Z]{{16}}$' THEN 'cloud_key'
    WHEN form rlike '^[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}$' THEN 'ssn'
    WHEN form rlike '^[+(]' OR form rlike '^[0-9]{{3}}[.-][0-9]{{3}}[.-][0-9]{{4}}$' THEN 'phone'
    WHEN form rlike '^[A-Z]{{2}}[0-9]{{2}}( ?[A-Z0-9]{{4}})+( ?[A-Z0-9]{{1,3}})?$' THEN 'iban'
    WHEN form rlike '^[0-9]([ -]?[0-9])+$' AND length({_digits}) BETWEEN 13 AND 19
        THEN CASE WHEN {_luhn(_digits)} % 10 = 0 THEN 'card' END
    ELSE 'secret' END"""
#: an assigned value is a secret unless the whole of it is another entity
KIND_ASSIGNED = f"CASE WHEN whole THEN coalesce({KIND}, 'secret') ELSE 'secret' END"
NORM = f"""CASE WHEN kind IN ('card', 'ssn') THEN {_digits} WHEN kind = 'phone' THEN regexp_replace(form, '[^0-9+]', '') WHEN kind = 'email'
    OR kind = 'secret' AND form rlike '^[0-9A-F]+$' THEN lower(form)
    WHEN kind = 'iban' THEN replace(form, ' ', '') ELSE form END"""


def _byte(seed: str, i: str) -> str:
    """The i-th pseudo-random number (0 to 65535) of a seed."""
    return f"cast(conv(substr(sha2(concat({seed}, '/', cast({i} div 16 AS string)), 256), 4 * ({i} % 16) + 1, 4), 16, 10) AS int)"


def _like(text: str, seed: str) -> str:
    """Text of the same shape: digits, lower- and upper-case ASCII letters drawn anew."""
    c, r = f"substr({text}, i + 1, 1)", _byte(seed, "i")
    hexa = f"(CASE WHEN {text} rlike '^[0-9a-f]+$' THEN 6 ELSE 26 END)"
    return (f"array_join(transform(sequence(0, length({text}) - 1), i -> CASE "
            f"WHEN {c} BETWEEN '0' AND '9' THEN cast({r} % 10 AS string) "
            f"WHEN {c} BETWEEN 'a' AND 'z' THEN char(97 + {r} % {hexa}) "
            f"WHEN {c} BETWEEN 'A' AND 'Z' THEN char(65 + {r} % 26) ELSE {c} END), '')")


def _made_up(parts: list[str], seed: str, count: str) -> str:
    words = "array(" + ", ".join(f"'{p}'" for p in parts) + ")"
    return f"initcap(array_join(transform(sequence(1, {count}), i -> element_at({words}, 1 + {_byte(seed, 'i')} % {len(parts)})), ''))"


def _first_name(kind: str, names: list[str]) -> str:
    listed = "array(" + ", ".join(f"'{n}'" for n in names) + ")"
    parts = PARTS["cyr" if kind.endswith("cyr") else "lat"]
    ending = ("а" if kind.endswith("cyr") else "a") if "_f" in kind else ""
    return (f"WHEN kind = '{kind}' THEN CASE WHEN attempt < {LONGER} THEN element_at({listed}, 1 + {_byte('seed', '0')} % {len(names)}) "
            f"ELSE concat({_made_up(parts, 'seed', f'attempt div {LONGER} + 1')}, '{ending}') END")


_octet = _byte("seed", "k")
_part = "element_at(split(norm, '[.]'), k + 1)"
_ip = (f"array_join(transform(sequence(0, 3), k -> cast(CASE WHEN attempt >= {LONGER} THEN 1 + {_octet} % 254 "
       f"WHEN length({_part}) = 1 THEN 1 + {_octet} % 9 WHEN length({_part}) = 2 THEN 10 + {_octet} % 90 "
       f"ELSE 100 + {_octet} % 124 END AS string)), '.')")
_local, _domain = "substring_index(norm, '@', 1)", "substring_index(norm, '@', -1)"
_longer = f"CASE WHEN attempt >= {LONGER} THEN char(97 + {_byte('seed', '99')} % 26) ELSE '' END"
_body = _like("substr(norm, 2, length(norm) - 2)", "seed")
_card = f"concat(substr(norm, 1, 1), {_body})"
#: characters of a phone that are kept: '+' and the country code after it (where six digits are left to be drawn)
_country = (f"(CASE WHEN norm NOT LIKE '+%' THEN 0 ELSE least(greatest(length(norm) - 7, 1), CASE WHEN norm rlike '^[+](?:{CODES[1]})' THEN 2 "
            f"WHEN norm rlike '^[+](?:{CODES[2]})' THEN 3 ELSE 4 END) END)")
_iban = _like("substr(norm, 5)", "seed")
_mod97 = ("aggregate(split(concat({body}, substr(norm, 1, 2), '00'), ''), 0, (s, c) -> CASE WHEN c = '' THEN s "
          "WHEN c BETWEEN '0' AND '9' THEN (s * 10 + cast(c AS int)) % 97 ELSE (s * 100 + ascii(c) - 55) % 97 END)")
# of any length: one pass over the characters; letters of other scripts are drawn as ASCII ones
_drawn = _byte("seed", "i")
_secret = (f"concat(array_join(transform(split(norm, ''), (c, i) -> CASE WHEN c rlike '^[0-9]$' THEN cast({_drawn} % 10 AS string) "
           f"WHEN c rlike '^[A-Z]$' THEN char(65 + {_drawn} % 26) WHEN c rlike '^[a-z]$' THEN char(97 + {_drawn} % letters) "
           f"WHEN c rlike '^\\\\p{{N}}$' THEN cast({_drawn} % 10 AS string) WHEN c rlike '^\\\\p{{L}}$' THEN char(97 + {_drawn} % letters) "
           f"ELSE c END), ''), CASE WHEN attempt >= {LONGER} THEN substr(sha2(seed, 256), 1, attempt) ELSE '' END)")
SURROGATE = f"""CASE
    WHEN kind = 'email' THEN concat({_like(_local, 'seed')}, {_longer}, '@', {_like(f"regexp_replace({_domain}, '[^.]+$', '')", "concat(secret, 'domain', " + _domain + ")")},
        substring_index(norm, '.', -1))
    WHEN kind = 'ip' THEN {_ip}
    WHEN kind = 'cloud_key' THEN concat('AKIA', {_like("substr(norm, 5)", "seed")})
    WHEN kind = 'card' THEN concat(body, cast((10 - {_luhn("concat(body, '0')")} % 10) % 10 AS string))
    WHEN kind = 'phone' THEN concat(substr(norm, 1, {_country}), cast(2 + {_byte('seed', '98')} % 8 AS string),
        {_like(f"substr(norm, {_country} + 2)", "seed")})
    WHEN kind = 'iban' THEN concat(substr(norm, 1, 2), lpad(cast(98 - {_mod97.format(body='body')} AS string), 2, '0'), body)
    {' '.join(_first_name(k, ns) for k, ns in FIRST.items())}
    WHEN kind = 'last' THEN {_made_up(PARTS['lat'], 'seed', f'3 + attempt div {LONGER}')}
    WHEN kind = 'last_cyr' THEN concat({_made_up(PARTS['cyr'], 'seed', f'2 + attempt div {LONGER}')}, CASE WHEN norm rlike 'а[яа]?$' THEN 'ова' ELSE 'ов' END)
    ELSE {_secret} END"""
#: a form's replacement: the digits of the surrogate in the places of the form's own
_nth = "length(regexp_replace(substr(form, 1, i + 1), '[^0-9]', ''))"
_iban_nth = "length(replace(substr(form, 1, i + 1), ' ', ''))"
RENDER = f"""CASE
    WHEN kind IN ('card', 'phone', 'ssn') THEN array_join(transform(sequence(0, length(form) - 1), i ->
        CASE WHEN substr(form, i + 1, 1) BETWEEN '0' AND '9' THEN substr(replace(surrogate, '+', ''), {_nth}, 1) ELSE substr(form, i + 1, 1) END), '')
    WHEN kind = 'iban' THEN array_join(transform(sequence(0, length(form) - 1), i ->
        CASE WHEN substr(form, i + 1, 1) = ' ' THEN ' ' ELSE substr(surrogate, {_iban_nth}, 1) END), '')
    WHEN kind = 'email' AND form = upper(form) OR kind = 'secret' AND form rlike '^[0-9A-F]+$' THEN upper(surrogate) ELSE surrogate END"""


def draw(entities: DataFrame, secret: str) -> DataFrame:
    """(kind, norm, attempt) with its surrogate."""
    return (entities.withColumn("secret", F.lit(secret))
            .withColumn("seed", F.concat_ws("|", "secret", "kind", F.expr("IF(length(norm) > 128, sha2(norm, 256), norm)"),
                                            F.col("attempt").cast("string")))
            .withColumn("letters", F.expr("IF(norm rlike '^[0-9a-f]+$', 6, 26)"))
            .withColumn("body", F.expr(f"CASE WHEN kind = 'card' THEN {_card} WHEN kind = 'iban' THEN {_iban} END"))
            .select("kind", "norm", "attempt", F.expr(SURROGATE).alias("surrogate")))


def distinct_surrogates(entities: DataFrame, secret: str = KEY) -> DataFrame:
    """(kind, norm, surrogate) with distinct surrogates within a kind, none of
    which is an entity of the corpus. ``entities`` is (kind, norm), distinct."""
    spark = entities.sparkSession
    open_path = write_table(entities.withColumn("attempt", F.lit(0)), "entities")
    done = None                                       # tables of settled entities
    for _ in range(MOST_ATTEMPTS):
        to_draw = spark.read.schema(f"{_fields(entities)}, attempt int").parquet(open_path)
        drawn = draw(to_draw, secret)
        real = entities.select("kind", F.col("norm").alias("surrogate"), F.lit(True).alias("real"))
        taken = real if done is None else real.unionByName(done.select("kind", "surrogate", F.lit(True).alias("real")))
        first = drawn.groupBy("kind", "surrogate").agg(F.min("norm").alias("winner"))
        first = first.join(taken.distinct(), ["kind", "surrogate"], "left")
        judged = drawn.join(first, ["kind", "surrogate"]).withColumn(
            "ok", (F.col("norm") == F.col("winner")) & F.col("real").isNull())
        judged = through_table(judged.select("kind", "norm", "attempt", "surrogate", "ok"), "drawn")
        settled = judged.where("ok").select("kind", "norm", "surrogate")
        done = settled if done is None else done.unionByName(settled)
        left = judged.where("NOT ok").select("kind", "norm", (F.col("attempt") + 1).alias("attempt"))
        last, open_path = open_path, None
        drop_path(spark, last)
        if left.isEmpty():
            return done
        open_path = write_table(left, "entities")
    raise ValueError("a kind of entity has no free surrogates left")


def _fields(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def pseudonymise(docs: DataFrame, key: str = "doc_id", text: str = "text", secret: str = KEY,
                 count: str = "n_entities") -> DataFrame:
    """All columns of every row with surrogates in ``text``, and the number of its entities in ``count``."""
    columns = [c for c in docs.columns if c != count]
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.struct(*columns).alias("row"))
    candidate = F.coalesce(F.expr(CANDIDATE), F.lit(False))
    found = through_table(rows.where(candidate).select(
        "key", F.xxhash64("text").alias("th"), F.regexp_extract_all("text", F.lit(SPANS), F.lit(0)).alias("spans"), "row"),
        "entity_texts")
    spans = through_table(found.select(F.explode("spans").alias("span")).distinct().select(
        "span", F.regexp_extract_all("span", F.lit(PATTERN), F.lit(0)).alias("forms"),
        F.split("span", PATTERN, -1).alias("pieces"), F.col("span").rlike(ASSIGNED).alias("assigned")), "spans")
    forms = through_table(spans.select(F.explode("forms").alias("form"), "assigned").distinct()
                          .withColumn("whole", F.col("form").rlike(f"^(?:{'|'.join(_numbers)})$"))
                          .withColumn("kind", F.expr(f"CASE WHEN assigned THEN {KIND_ASSIGNED} ELSE {KIND} END"))
                          .where("kind IS NOT NULL").withColumn("norm", F.expr(NORM)).drop("whole"), "forms")
    surrogates = distinct_surrogates(forms.select("kind", "norm").distinct(), secret)
    rendered = forms.join(surrogates, ["kind", "norm"]).select("form", "assigned", F.expr(RENDER).alias("new"))
    parts = (spans.select("span", "assigned", F.posexplode("forms").alias("at", "form")).join(rendered, ["form", "assigned"])
             .groupBy("span").agg(F.map_from_entries(F.collect_set(F.struct("at", "new"))).alias("new")))
    renewed = through_table(spans.join(parts, "span").select("span", F.struct(F.expr(
        "concat(pieces[0], array_join(transform(forms, (f, i) -> concat(coalesce(new[i], f), pieces[i + 1])), ''))").alias("text"),
        F.size("new").alias("n")).alias("new")), "renewed")
    places = found.select("key", "th", F.posexplode("spans").alias("at", "span")).join(renewed, "span")
    new = places.groupBy("key", "th").agg(F.map_from_entries(F.collect_set(F.struct("at", "new"))).alias("new"))
    new = new.select(F.col("key").alias("new_key"), F.col("th").alias("new_th"), "new")
    joined = found.join(new, (F.col("th") == F.col("new_th")) & F.col("key").eqNullSafe(F.col("new_key")), "left")
    # without a replacement the text is not cut again
    replaced = joined.withColumn("pieces", F.when(F.col("new").isNotNull(), F.split(F.col("row")[text], SPANS, -1))).withColumn(
        "text", F.when(F.col("new").isNotNull(), F.expr("concat(pieces[0], array_join(transform(spans, "
                       "(s, i) -> concat(coalesce(new[i].text, s), pieces[i + 1])), ''))")).otherwise(F.col("row")[text])).select(
        *((F.col("text") if c == text else F.col("row")[c]).alias(c) for c in columns),
        F.coalesce(F.expr("aggregate(map_values(new), 0, (s, x) -> s + x.n)"), F.lit(0)).cast("long").alias(count))
    clean = rows.where(~candidate).select(*(F.col("row")[c].alias(c) for c in columns), F.lit(0).cast("long").alias(count))
    return replaced.unionByName(clean)


def op7_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(documents(spark, sf_dir)).select("doc_id", "text", "n_entities")
