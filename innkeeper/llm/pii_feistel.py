"""Format-preserving pseudonyms for personal data, by keyed Feistel permutations.

Each value found in a text is replaced by another value of the same format, chosen by a
permutation of that format under a secret key: equal values get equal pseudonyms in every
document, different values different ones, and the holder of the key can invert it.

  card   13-19 digits, or groups of 4-4-4-4 or 4-6-5, that pass the Luhn check: all digits but the check
         digit are permuted, the check digit is made anew
  iban   country code, check digits, account, in one or printed in groups of four; valid modulo 97:
         the account's digits are permuted, the check digits are made anew
  ssn    ddd-dd-dddd in the issued ranges, permuted within them
  phone  an international number (+ and country code), (ddd) ddd-dddd or ddd-ddd-dddd: the digits
         after the country code are permuted
  ip     four octets of 0-255, permuted as 32 bits
  date   yyyy-mm-dd, dd.mm.yyyy or dd/mm/yyyy, a real day of 1800-2199: the day is permuted
         within these 400 years (146,097 days = 189 x 773, so no value needs a second try)
  email  the local part becomes "u" and a keyed hash (of the whole address, A-Z lower-cased);
         the domain (up to 127 labels, as DNS allows) stays

A Feistel network over a pair (a, b) in Z_m x Z_n adds, in turn, a keyed hash of b to a
modulo m and a keyed hash of a to b modulo n; each round can be undone, so the whole is a
permutation for any m and n. What looks like a value but fails its validation stays.

A text is cut at the matches of one pattern, the matches are replaced, and the pieces are
joined again: DataFrame functions on one row, without a shuffle.

Edge cases: a null text stays null and has no values; an empty text stays empty; equal rows
stay separate rows; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
KINDS = ["email", "iban", "card", "ssn", "phone", "ip", "date"]
# A value does not begin or end inside a longer run of the same characters.
PATTERNS = {
    # A local part begins where a run of its characters or the last match ends, so a run is read once; its parts are
    # possessive, as none can give way to the next.
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++){0,125}\.[A-Za-z]{2,}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?)(?![A-Za-z0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"
             r"|(?<![0-9A-Za-z+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])"
             r"|(?<![0-9A-Za-z.-])[0-9]{3}(?:-[0-9]{3}-|\.[0-9]{3}\.)[0-9]{4}(?![0-9]|[.-][0-9])",
    "date": r"(?<![0-9.])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}(?![0-9-])|[0-9]{2}\.[0-9]{2}\.[0-9]{4}(?![0-9])"
            r"|(?<!/)[0-9]{2}/[0-9]{2}/[0-9]{4}(?![0-9/]))",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
}
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
FIRST_DAY, N_DAYS = "1800-01-01", 146_097
DATE_FORMS = [("-", "yyyy-MM-dd"), (".", "dd.MM.yyyy"), ("/", "dd/MM/yyyy")]


def prf(key: str, tweak: Column, round_: Column, half: Column, modulus: Column) -> Column:
    digest = F.sha2(F.concat_ws("|", F.lit(key), tweak, round_.cast("string"), half.cast("string")), 256)
    return F.pmod(F.conv(F.substring(digest, 1, 15), 16, 10).cast("long"), modulus)


def permuted(a: Column, b: Column, m: Column, n: Column, key: str, tweak: Column) -> Column:
    """struct(a, b): the keyed permutation of (a, b) in Z_m x Z_n. All are bigint; m, n below 2^62."""
    a, b, m, n = (c.cast("long") for c in (a, b, m, n))
    step = lambda s, i: F.when(i % 2 == 0, F.struct(
        F.pmod(s["a"] + prf(key, tweak, i, s["b"], m), m).alias("a"), s["b"].alias("b"))).otherwise(F.struct(
            s["a"].alias("a"), F.pmod(s["b"] + prf(key, tweak, i, s["a"], n), n).alias("b")))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), F.struct(a.alias("a"), b.alias("b")), step)


def ten_to(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, F.lit("0")).cast("long")


def permuted_digits(digits: Column, key: str, tweak: Column) -> Column:
    """A string of 2 to 36 digits permuted among those of its length."""
    n = F.length(digits)
    u = F.floor(n / 2).cast("int")
    v = n - u
    p = permuted(F.substr(digits, F.lit(1), u), F.substr(digits, u + 1, v), ten_to(u), ten_to(v), key,
                 F.concat_ws(":", tweak, n.cast("string")))
    return F.concat(F.lpad(p["a"].cast("string"), u, F.lit("0")), F.lpad(p["b"].cast("string"), v, F.lit("0")))


def digits_of(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def laid_out(form: Column, digits: Column) -> Column:
    """``form`` with its digits replaced by ``digits`` in turn."""
    chars = F.transform(F.sequence(F.lit(1), F.length(form)), lambda i: F.substr(form, i, F.lit(1)))
    one = lambda s, c: F.when((c >= "0") & (c <= "9"), F.struct(
        F.concat(s["out"], F.substr(digits, s["at"], F.lit(1))).alias("out"), (s["at"] + 1).alias("at"))).otherwise(
            F.struct(F.concat(s["out"], c).alias("out"), s["at"].alias("at")))
    return F.aggregate(chars, F.struct(F.lit("").alias("out"), F.lit(1).alias("at")), one)["out"]


def luhn_digit(payload: Column) -> Column:
    """The check digit of a payload: from its right, digits count twice and once in turn."""
    at = F.sequence(F.lit(1), F.length(payload))
    total = F.aggregate(at, F.lit(0), lambda s, i: s + F.when(
        (F.length(payload) - i) % 2 == 0, F.get(F.array(*[F.lit(x) for x in (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)]),
                                                F.substr(payload, i, F.lit(1)).cast("int"))
    ).otherwise(F.substr(payload, i, F.lit(1)).cast("int")))
    return F.pmod(F.lit(10) - F.pmod(total, F.lit(10)), F.lit(10)).cast("string")


def mod97(s: Column) -> Column:
    """Letters count as 10 to 35; the number modulo 97, character by character."""
    return F.aggregate(F.sequence(F.lit(1), F.length(s)), F.lit(0), lambda r, i: F.when(
        F.substr(s, i, F.lit(1)) >= "A", (r * 100 + F.ascii(F.substr(s, i, F.lit(1))) - 55) % 97).otherwise(
            (r * 10 + F.ascii(F.substr(s, i, F.lit(1))) - 48) % 97))


def pseudonym(match: Column, key: str) -> Column:
    """struct(kind, value) for a match of ``ANY``; kind is null and value the match itself if it is not valid."""
    none = F.struct(F.lit(None).cast("string").alias("kind"), match.alias("value"))
    made = lambda kind, value: F.struct(F.lit(kind).alias("kind"), value.alias("value"))
    whole = lambda kind: F.rlike(match, F.lit(f"^(?:{PATTERNS[kind]})$"))
    digits = digits_of(match)
    n = F.length(digits)

    local_hash = F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.translate(
        match, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), 256)
    email = made("email", F.concat(F.lit("u"), F.substring(local_hash, 1, 16), F.regexp_extract(match, "(@.*)$", 1)))

    payload = F.substr(digits, F.lit(1), n - 1)
    card_payload = permuted_digits(payload, key, F.lit("card"))
    card = F.when((n >= 13) & (luhn_digit(payload) == F.substr(digits, n, F.lit(1))),
                  made("card", laid_out(match, F.concat(card_payload, luhn_digit(card_payload))))).otherwise(none)

    country, account = F.substring(match, 1, 2), F.substr(match, F.lit(5), F.length(match) - 4)
    account_digits = digits_of(account)
    other = F.when(F.length(account_digits) >= 2, laid_out(account, permuted_digits(
        account_digits, key, F.concat(F.lit("iban"), country)))).otherwise(account)
    joined = lambda c: F.replace(c, F.lit(" "))
    check = F.lpad((98 - mod97(F.concat(joined(other), country, F.lit("00")))).cast("string"), 2, "0")
    iban = F.when(mod97(F.concat(joined(account), F.substring(match, 1, 4))) == 1,
                  made("iban", F.concat(country, check, other))).otherwise(none)

    area, group, serial = (F.substring(match, p, w).cast("int") for p, w in ((1, 3), (5, 2), (8, 4)))
    issued = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    # 898 areas without 666, 99 groups x 9999 serials
    s = permuted(area - 1 - (area > 666).cast("int"), (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), key, F.lit("ssn"))
    new_area = s["a"] + 1 + (s["a"] >= 665).cast("int")
    pad = lambda c, w: F.lpad(c.cast("string"), w, "0")
    ssn = F.when(issued, made("ssn", F.concat_ws("-", pad(new_area, 3), pad(F.floor(s["b"] / 9999).cast("int") + 1, 2),
                                                 pad(s["b"] % 9999 + 1, 4)))).otherwise(none)

    code = F.regexp_extract(match, r"^(\+[0-9]{1,3}(?=[ .(-]))", 1)
    rest = F.substr(match, F.length(code) + 1, F.length(match) - F.length(code))
    rest_digits = digits_of(rest)
    phone = F.when(F.length(rest_digits).between(7, 15), made("phone", F.concat(
        code, laid_out(rest, permuted_digits(rest_digits, key, F.concat(F.lit("phone"), code)))))).otherwise(none)

    octets = F.transform(F.split(match, r"\."), lambda o: o.cast("int"))
    q = permuted(F.get(octets, F.lit(0)) * 256 + F.get(octets, F.lit(1)), F.get(octets, F.lit(2)) * 256 + F.get(octets, F.lit(3)),
                 F.lit(65536), F.lit(65536), key, F.lit("ip"))
    ip = F.when(F.forall(octets, lambda o: o <= 255), made("ip", F.concat_ws(
        ".", *[c.cast("string") for half in ("a", "b") for c in (F.floor(q[half] / 256).cast("int"), q[half] % 256)]))).otherwise(none)

    date = none
    for mark, form in DATE_FORMS:
        day = F.datediff(F.try_to_date(match, form), F.lit(FIRST_DAY).cast("date"))
        d = permuted(F.floor(day / 773), day % 773, F.lit(189), F.lit(773), key, F.lit("date"))
        new = F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), (d["a"] * 773 + d["b"]).cast("int")), form)
        date = F.when(F.contains(match, F.lit(mark)), F.when(
            day.between(0, N_DAYS - 1), made("date", new)).otherwise(none)).otherwise(date)

    return (F.when(F.contains(match, F.lit("@")), email).when(whole("iban"), iban).when(whole("phone"), phone)
            .when(whole("date"), date).when(whole("ssn"), ssn).when(whole("ip"), ip).otherwise(card))


def pseudonymize(docs: DataFrame, secret: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, text with pseudonyms, ``found`` (array<struct(kind, value)>: the pseudonyms in order)."""
    t = F.col(text)
    # Only texts with a digit or an @ can hold a value.
    has = F.rlike(t, F.lit("[0-9@]"))
    pieces = F.split(t, ANY, -1)
    matches = F.regexp_extract_all(t, F.lit(ANY), F.lit(0))
    empty = F.array().cast("array<struct<kind:string,value:string>>")
    rows = docs.select(F.col(key).alias("_key"), t.alias("_text"),
                       F.when(has, pieces).alias("_pieces"),
                       F.when(has, F.transform(matches, lambda m: pseudonym(m, secret))).otherwise(empty).alias("_found"))
    joined = F.concat(F.array_join(F.zip_with(
        F.slice("_pieces", 1, F.size("_found")), "_found", lambda p, f: F.concat(p, f["value"])), ""),
        F.element_at("_pieces", -1))
    return rows.select(F.col("_key").alias(key), F.when(F.size("_found") > 0, joined).otherwise(F.col("_text")).alias(text),
                       F.filter("_found", lambda f: f["kind"].isNotNull()).alias("found"))
