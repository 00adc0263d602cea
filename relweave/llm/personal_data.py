"""Format-preserving pseudonyms for personal data, in DataFrame functions only.

Card numbers (Luhn), phone numbers, IPv4 addresses, dates and e-mail addresses are found by one pattern and
replaced by a value of the same format. Digits go through a keyed Feistel permutation of the numbers of
their length, so a value has the same pseudonym in every document and two values never share one. A card
number keeps a right check digit, an address four octets, a date is permuted among the days of 400
years (their number is 189 x 773, so the Feistel halves are days modulo these, and no date falls outside).
E-mail addresses take one of two forms. ``permuted``: the letters and digits of the local part, lower-cased, go through a
Feistel permutation of the texts of their length by shifts of single characters; other characters and the domain stay,
so two people never share one. ``digest``: the local part becomes letters of a keyed digest, which shows less of its
form, but short names may come to share one.

Not found: phone numbers without a leading ``+``, IBANs and other national or account numbers, and names. Cards
are sought among whole digit groups, parted by one space or hyphen, not inside a longer unbroken row of digits.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from relweave.llm.exact_dedup import quoted

ROUNDS = 10
_ALPHABET, _PIECE = "0123456789abcdefghijklmnopqrstuvwxyz", 64
# The country codes of one and two digits; all others have three.
_COUNTRY = r"^\+(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3}|[0-9]{1,2})"
_OCTET = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@(?:[A-Za-z0-9-]++\.)+[A-Za-z]{2,}+"
IPV4 = rf"(?<![0-9.])(?:{_OCTET}\.){{3}}{_OCTET}(?![0-9]|\.[0-9])"
DATE = r"(?<![0-9/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})(?![0-9]|[/.-][0-9])"
PHONE = r"(?<![0-9+])\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})(?:[ .-]?[0-9]{2,4}){2,3}(?![0-9])"
# a whole run of digit groups, up to where another kind begins; the cards in it are found by ``_values``
CARD = rf"(?<![0-9])[0-9](?:[ -]?(?!{EMAIL}|{IPV4}|{DATE})[0-9]){{12,}}+(?![0-9])"
PATTERN = "|".join((EMAIL, IPV4, DATE, PHONE, CARD))
KINDS = ("email", "ip", "date", "phone", "card")
_FIRST_DAY, _RADIX = "1800-01-01", (189, 773)


def digest(key: Column, *parts: Column) -> Column:
    """A keyed number below 2^52."""
    text = F.concat_ws("|", key, *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 13), 16, 10).cast("long")


def permute_digits(digits: Column, key: Column) -> Column:
    """Keyed permutation of the digit strings of each length from 2 to 36; shorter ones stay."""
    n = F.length(digits)
    half = (n / 2).cast("int")
    start = F.struct(F.substring(digits, F.lit(1), half).alias("a"), F.substring(digits, half + 1, n).alias("b"))

    def step(s, i):
        width = F.length(s["a"])
        limit = F.pow(F.lit(10), width).cast("decimal(20,0)")
        total = (s["a"].cast("decimal(20,0)") + digest(key, n, i, s["b"])) % limit
        return F.struct(s["b"].alias("a"), F.lpad(total.cast("decimal(20,0)").cast("string"), width, "0").alias("b"))

    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)
    return F.when(n < 2, digits).otherwise(F.concat(done["a"], done["b"]))


def permute_letters(text: Column, key: Column, tweak: Column) -> Column:
    """Keyed permutation of the texts of each length over ``_ALPHABET``, for each ``tweak`` another."""
    n, size = F.length(text), len(_ALPHABET)
    half = (n / 2).cast("int")
    start = F.struct(F.substring(text, F.lit(1), half).alias("a"), F.substring(text, half + 1, n).alias("b"))

    def step(s, i):
        width = F.length(s["a"])

        def moved(at):
            # three hexadecimal digits a character, 21 characters a digest
            stream = F.concat_ws("|", key, *[c.cast("string") for c in (tweak, n, i, F.floor((at - 1) / 21))], s["b"])
            shift = F.conv(F.substring(F.sha2(stream.cast("binary"), 256), (at - 1) % 21 * 3 + 1, F.lit(3)), 16, 10).cast("int")
            old = F.position(F.substring(s["a"], at, F.lit(1)), F.lit(_ALPHABET)) - 1
            return F.substring(F.lit(_ALPHABET), (old + shift) % size + 1, F.lit(1))

        shifted = F.array_join(F.transform(F.sequence(F.lit(1), width), moved), "")
        return F.struct(s["b"].alias("a"), F.when(width == 0, F.lit("")).otherwise(shifted).alias("b"))

    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)
    return F.concat(done["a"], done["b"])


def permute_pair(a: Column, b: Column, radix: tuple[int, int], key: Column) -> tuple[Column, Column]:
    """Keyed permutation of the pairs of numbers below ``radix``, by an alternating Feistel network."""
    start = F.struct(a.cast("long").alias("a"), b.cast("long").alias("b"))

    def step(s, i):
        first = F.struct(((s["a"] + digest(key, i, s["b"])) % radix[0]).alias("a"), s["b"].alias("b"))
        second = F.struct(s["a"].alias("a"), ((s["b"] + digest(key, i, s["a"])) % radix[1]).alias("b"))
        return F.when(i % 2 == 0, first).otherwise(second)

    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step)
    return done["a"], done["b"]


def luhn_sum(digits: Column) -> Column:
    """Sum of the Luhn algorithm; a number is valid when it is a multiple of ten."""
    n = F.length(digits)

    def step(total, i):
        d = F.substring(digits, n - i + 1, F.lit(1)).cast("int")
        return total + F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step)


def _laid_out(layout: Column, digits: Column, kept: str = "0-9") -> Column:
    """``digits`` in the places of the digits (characters of ``kept``) of ``layout``."""
    def place(i):
        c = F.substring(layout, i, F.lit(1))
        before = F.length(F.regexp_replace(F.substring(layout, F.lit(1), i), f"[^{kept}]", ""))
        return F.when(c.rlike(f"[{kept}]"), F.substring(digits, before, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(layout)), place), "")


def _only_digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _date_of(value: Column) -> Column:
    iso = F.regexp_replace(value, r"^([0-9]{2})[/.]([0-9]{2})[/.]([0-9]{4})$", "$3-$2-$1")
    return F.translate(iso, "/", "-").try_cast("date")


def _kind(value: Column) -> Column:
    """The kind of a match, NULL for a number that is not valid."""
    days = F.datediff(_date_of(value), F.lit(_FIRST_DAY).cast("date"))
    return (
        F.when(value.contains("@"), "email").when(value.startswith("+"), "phone").when(value.rlike(f"^{IPV4}$"), "ip")
        .when(value.rlike(f"^(?:{DATE})$"), F.when(days.between(0, _RADIX[0] * _RADIX[1] - 1), "date"))
        .when(_is_card(_only_digits(value)), "card")
    )


def _is_card(digits: Column) -> Column:
    return F.when(F.length(digits).between(13, 19), luhn_sum(digits) % 10 == 0).otherwise(False)


def _values(value: Column) -> Column:
    """(value, kind) of the parts of a match: itself, or the cards among the digit groups of a run that is none as a whole.

    From each group on, the longest valid number that ends with a group is a card.
    """
    def inside(pieces: Column) -> Column:
        n = F.size(pieces)

        def joined(first: Column, last: Column) -> Column:
            return F.array_join(F.slice(pieces, first, last - first + 1), "")

        def longest(i: Column) -> Column:
            ends = F.filter(F.sequence(i, F.least(i + 18, n)), lambda e: _is_card(_only_digits(joined(i, e))))
            return F.struct(i.alias("first"), F.array_max(ends).alias("last"))

        def step(s, c):
            run = F.regexp_replace(joined(c["first"], c["last"]), "[ -]$", "")
            before = _part(joined(s["next"], c["first"] - 1), F.lit(None))
            after = F.substring(joined(c["first"], c["last"]), F.length(run) + 1, F.lit(1))
            parts = F.concat(s["parts"], F.array(before, _part(run, F.lit("card")), _part(after, F.lit(None))))
            return F.when(c["first"] < s["next"], s).otherwise(F.struct((c["last"] + 1).alias("next"), parts.alias("parts")))

        start = F.struct(F.lit(1).alias("next"), F.array().cast("array<struct<value:string,kind:string>>").alias("parts"))
        cards = F.filter(F.transform(F.sequence(F.lit(1), n), longest), lambda c: c["last"].isNotNull())
        return F.aggregate(cards, start, step, lambda s: F.concat(s["parts"], F.array(_part(joined(s["next"], n), F.lit(None)))))

    pieces = F.regexp_extract_all(value, F.lit("[0-9]+[ -]?"), F.lit(0))
    cut = F.transform(F.array(pieces), inside)[0]  # the groups are bound once
    kind = _kind(value)
    run = value.rlike("^[0-9](?:[ -]?[0-9]){12,}+$")
    return F.when(kind.isNull() & run, cut).otherwise(F.array(_part(value, kind)))


def _part(value: Column, kind: Column) -> Column:
    return F.struct(value.alias("value"), kind.cast("string").alias("kind"))


def _card(value: Column, key: Column) -> Column:
    digits = _only_digits(value)
    payload = permute_digits(F.substring(digits, F.lit(1), F.length(digits) - 1), key)
    check = (10 - luhn_sum(F.concat(payload, F.lit("0"))) % 10) % 10
    return _laid_out(value, F.concat(payload, check.cast("string")))


def _phone(value: Column, key: Column) -> Column:
    country = F.regexp_extract(value, _COUNTRY, 0)
    rest = F.substring(value, F.length(country) + 1, F.length(value))
    return F.concat(country, _laid_out(rest, permute_digits(_only_digits(rest), key)))


def _ip(value: Column, key: Column) -> Column:
    part = F.transform(F.split(value, r"\."), lambda x: x.cast("int"))
    a, b = permute_pair(part[0] * 256 + part[1], part[2] * 256 + part[3], (65536, 65536), key)
    return F.concat_ws(".", *[x.cast("long").cast("string") for x in (a / 256 - (a % 256) / 256, a % 256, b / 256 - (b % 256) / 256, b % 256)])


def _date(value: Column, key: Column) -> Column:
    days = F.datediff(_date_of(value), F.lit(_FIRST_DAY).cast("date"))
    a, b = permute_pair((days / _RADIX[1]).cast("int"), days % _RADIX[1], _RADIX, key)
    moved = F.date_add(F.lit(_FIRST_DAY).cast("date"), (a * _RADIX[1] + b).cast("int"))
    form = F.when(value.contains("-"), F.date_format(moved, "yyyy-MM-dd")).when(value.rlike("^[0-9]{4}/"), F.date_format(moved, "yyyy/MM/dd"))
    form = form.when(value.contains("/"), F.date_format(moved, "dd/MM/yyyy"))
    return form.otherwise(F.date_format(moved, "dd.MM.yyyy"))


def _email_digest(value: Column, key: Column) -> Column:
    local = F.substring_index(value, "@", 1)
    letters = F.translate(F.sha2(F.concat_ws("|", key, F.lit("email"), F.lower(value)).cast("binary"), 256), "0123456789", "ghijklmnop")
    return F.concat(F.rpad(F.substring(letters, F.lit(1), F.length(local)), F.length(local), "x"), F.lit("@"), F.substring_index(value, "@", -1))


def _email_permuted(value: Column, key: Column) -> Column:
    def moved(piece, k):
        letters = F.regexp_replace(piece, "[^a-z0-9]", "")
        return F.when(letters == "", piece).otherwise(_laid_out(piece, permute_letters(letters, key, k), "a-z0-9"))

    # an address has 64 characters at most before the sign; of a longer match every piece is permuted by itself
    pieces = F.regexp_extract_all(F.lower(F.substring_index(value, "@", 1)), F.lit(f".{{1,{_PIECE}}}"), F.lit(0))
    return F.concat(F.array_join(F.transform(pieces, moved), ""), F.lit("@"), F.substring_index(value, "@", -1))


EMAIL_FORMS = {"digest": _email_digest, "permuted": _email_permuted}


def pseudonym(value: Column, kind: Column, key: Column, emails: str = "digest") -> Column:
    forms = {"email": EMAIL_FORMS[emails], "phone": _phone, "ip": _ip, "date": _date, "card": _card}
    chosen = reduce(lambda rest, k: rest.when(kind == k, forms[k](value, key)), forms, F.when(F.lit(False), value))
    return chosen.otherwise(value)


def pseudonymise(
    docs: DataFrame, key: str, text: str = "text", carry: Sequence[str] = ("doc_id",), emails: str = "digest"
) -> DataFrame:
    """One row per document: ``row`` (struct of ``carry``), ``text`` with pseudonyms, ``kinds``.

    ``kinds`` has the kind of every replaced value in its order. NULL text stays NULL and has no kinds. Whole
    texts are searched; ``emails`` names the form of e-mail addresses; a text without a digit or ``@`` holds none of the formats and passes as it is.
    Invalid numbers and dates stay; of a run of digit groups the valid card numbers in it are replaced. Input columns stay inside ``row`` and cannot clash.
    """
    secret = F.lit(key)
    given = docs.select(F.struct(*[quoted(c) for c in carry]).alias("row"), quoted(text).cast("string").alias("text"))
    may = F.col("text").rlike("[0-9@]")
    found = F.when(may, F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0)))
    given = given.withColumn("found", F.coalesce(found, F.array().cast("array<string>")))
    given = given.withColumn("values", F.transform("found", _values))
    changed = F.transform("values", lambda m: F.array_join(F.transform(m, lambda v: pseudonym(v["value"], v["kind"], secret, emails)), ""))
    between = F.split("text", PATTERN, -1)
    whole = F.array_join(F.zip_with(between, F.concat(changed, F.array(F.lit(""))), lambda x, y: F.concat(x, y)), "")
    kinds = F.filter(F.transform(F.flatten("values"), lambda v: v["kind"]), lambda k: k.isNotNull())
    return given.select("row", F.when(F.size("found") > 0, whole).otherwise(F.col("text")).alias("text"), kinds.alias("kinds"))


def query(spark, folder: str, key: str = "a key for tests") -> DataFrame:
    """Every document with pseudonyms, and how many values of each kind were replaced."""
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")
    done = pseudonymise(docs, key, emails="permuted")

    def count(kind: str) -> Column:
        return F.size(F.filter("kinds", lambda k: k == kind)).alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return done.select("row.doc_id", *counts, "text")
