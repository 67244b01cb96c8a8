"""Personal data: format-preserving Feistel pseudonyms, in column expressions only.

Candidates are found with one regular expression, validated by kind, and
replaced by a keyed permutation of the values of the same format.  Equal
values get equal pseudonyms in every document, unequal ones stay unequal, and
who holds the key can turn them back.  What fails validation stays as it is.

kind    validation                              permuted
email   shape                                   local part, letters and digits each in their class
ipv4    four octets up to 255                   the 32-bit number
date    real calendar day, 1900 to 2099         the day's number
ssn     no reserved area, group or serial       the number among the valid ones
phone   7 to 15 digits                          digits after the country code
card    13 to 19 digits, Luhn check, from the   all but the check digit, which is computed anew
        begin to the end of numbers in a run
secret  16 or more characters after a key word  characters, each in its class (hex stays hex)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farelens.llm.feistel import permute

KEY = "pseudonym-key-1"
ROUNDS = 10

EMAIL = r"[A-Za-z0-9._%+-]*[A-Za-z0-9]@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
IPV4 = r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"
DATE = (r"(?<![0-9/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4})"
        r"(?![0-9]|[/.-][0-9])")
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
# Card numbers as they are usually written.
FORMED = (r"(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}(?:[ -][0-9]{3}(?![ -]?[0-9]))?|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})"
          r"(?![0-9A-Za-z])")
PHONE = (r"(?<![0-9A-Za-z])(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])"
         r"|(?<![0-9A-Za-z])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])"
         r"|(?<![0-9.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![0-9-])"
         # North American, also with spaces or a leading 1; with a trunk 0; French pairs.
         r"|(?<![0-9A-Za-z.-])(?:1[ .-]?)?[2-9][0-9]{2}[ .-][2-9][0-9]{2}[ .-][0-9]{4}(?![0-9]|-[0-9])"
         rf"|(?<![0-9A-Za-z.,-])(?!{FORMED})0[1-9][0-9]{{1,4}}[ /-](?!{FORMED})"
         rf"(?:[0-9]{{3,4}}(?:[ -](?!{FORMED})[0-9]{{2}}){{2}}(?![0-9])|[0-9]{{6,8}}|[0-9]{{3,5}}(?:[ -](?!{FORMED})[0-9]{{2,4}})?)"
         r"(?![0-9]|[.,-][0-9])"
         r"|(?<![0-9A-Za-z.,-])0[1-9](?:[ .-][0-9]{2}){4}(?![0-9]|[.,-][0-9])")
# A run of numbers as far as no other kind begins in it; the cards are looked
# for inside.  Possessive, so that a long run is matched without recursion.
_NUMBER = r"[0-9]++(?![0-9A-Za-z]|\.[0-9]|[A-Za-z0-9._%+-]{0,64}@)"
CARD = (rf"(?<![0-9A-Za-z.-])(?=[0-9](?:[ -]?[0-9]){{12}})(?:{FORMED}|{_NUMBER})"
        rf"(?:[ -](?:{FORMED}|(?!{DATE}|{SSN}|{PHONE}){_NUMBER}))*+")
SECRET = (r"(?i:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key)[\"']?\s*[=:]\s*[\"']?[A-Za-z0-9+/_-]{16,}"
          r"|[\"'][0-9a-fA-F]{32,}[\"']")
ANY = "|".join(f"(?:{p})" for p in (EMAIL, SECRET, IPV4, DATE, SSN, PHONE, CARD))
# A text without a digit or @ has no candidate.
HINT = "[0-9@]|(?i:token|secret|passw|key)"

_CLASSES = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_HEX = ("0123456789abcdef", "0123456789ABCDEF")


def _prf(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), *[p.cast("string") for p in parts]), 512)


def _shift(s: Column, stream: Column, classes, forward: bool = True) -> Column:
    """Adds the hex stream to the characters of ``s``, each within its class."""

    def one(j: Column) -> Column:
        ch = F.substr(s, j, F.lit(1))
        step = F.conv(F.substr(stream, F.pmod((j - 1) * 4, F.lit(128)) + 1, F.lit(4)), 16, 10).cast("int")
        out = ch
        for letters in classes:
            at = F.instr(F.lit(letters), ch)
            moved = F.pmod(at - 1 + step if forward else at - 1 - step, F.lit(len(letters))) + 1
            out = F.when(at > 0, F.substr(F.lit(letters), moved, F.lit(1))).otherwise(out)
        return out

    chars = F.transform(F.sequence(F.lit(1), F.length(s)), one)
    return F.when(F.length(s) == 0, F.lit("")).otherwise(F.concat_ws("", chars))


def permute_string(s: Column, key: str, kind: str, classes=_CLASSES) -> Column:
    """Feistel network on the halves of a string; positions keep their character class."""
    n = F.length(s)
    half = F.ceil(n / 2).cast("int")
    start = F.struct(F.substr(s, F.lit(1), half).alias("l"),
                     F.substr(s, half + 1, n - half).alias("r"))

    def step(acc: Column, i: Column) -> Column:
        l, r = acc["l"], acc["r"]
        even = i % 2 == 0
        return F.struct(F.when(even, _shift(l, _prf(key, F.lit(kind), i, n, r), classes)).otherwise(l).alias("l"),
                        F.when(even, r).otherwise(_shift(r, _prf(key, F.lit(kind), i, n, l), classes)).alias("r"))

    rounds = F.array(*[F.lit(i) for i in range(ROUNDS)])
    return F.aggregate(rounds, start, step, lambda acc: F.concat(acc["l"], acc["r"]))


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string whose last digit counts once."""
    n = F.length(digits)

    def add(total: Column, j: Column) -> Column:
        d = F.substr(digits, j, F.lit(1)).cast("int")
        twice = d * 2 - F.when(d > 4, 9).otherwise(0)
        return total + F.when((n - j) % 2 == 1, twice).otherwise(d)

    return F.when(n == 0, F.lit(0)).otherwise(F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add))


def _refill(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, in order, by ``digits``."""
    start = F.struct(F.lit("").alias("s"), F.lit(1).alias("i"))

    def add(acc: Column, j: Column) -> Column:
        ch = F.substr(shape, j, F.lit(1))
        digit = ch.rlike("[0-9]")
        return F.struct(F.concat(acc["s"], F.when(digit, F.substr(digits, acc["i"], F.lit(1))).otherwise(ch)).alias("s"),
                        F.when(digit, acc["i"] + 1).otherwise(acc["i"]).alias("i"))

    return F.aggregate(F.sequence(F.lit(1), F.length(shape)), start, add, lambda acc: acc["s"])


def _email(v: Column, key: str) -> Column:
    at = F.locate("@", v)
    return F.concat(permute_string(F.substr(v, F.lit(1), at - 1), key, "email"), F.substr(v, at))


def _ipv4(v: Column, key: str) -> tuple[Column, Column]:
    octets = F.transform(F.split(v, r"\."), lambda o: o.cast("long"))
    valid = F.forall(octets, lambda o: o <= 255)
    number = F.aggregate(octets, F.lit(0).cast("long"), lambda a, o: a * 256 + o)
    y = permute(number, F.lit(1 << 32), key, F.lit("ipv4"), secure=True)
    # The number is worked out once, then taken apart.
    parts = F.transform(F.array(y), lambda p: F.concat_ws(
        ".", *[F.shiftright(p, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)]))
    return valid, F.element_at(parts, 1)


_FIRST_DAY, _DAYS = "1900-01-01", 73049  # to 2099-12-31


def _date(v: Column, key: str) -> tuple[Column, Column]:
    def read(fmt: str) -> Column:
        return F.to_date(F.try_to_timestamp(v, F.lit(fmt)))

    def moved(day: Column, fmt: str) -> tuple[Column, Column]:
        number = F.datediff(day, F.lit(_FIRST_DAY).cast("date")).cast("long")
        inside = (number >= 0) & (number < _DAYS)
        y = permute(F.when(inside, number).otherwise(0), F.lit(_DAYS), key, F.lit("date"), secure=True)
        return F.coalesce(inside, F.lit(False)), F.date_format(F.date_add(F.lit(_FIRST_DAY).cast("date"), y.cast("int")), fmt)

    valid, out = F.lit(False), F.lit(None).cast("string")
    for shape, fmt in (("-", "yyyy-MM-dd"), (r"\.", "dd.MM.yyyy"), ("/", "dd/MM/yyyy"), ("/", "MM/dd/yyyy")):
        ok, text = moved(read(fmt), fmt)
        ok = v.rlike(shape) & ok
        valid, out = valid | ok, F.when(ok, text).otherwise(out)
    return valid, out


def _ssn(v: Column, key: str) -> tuple[Column, Column]:
    area, group, serial = (F.substr(v, F.lit(a), F.lit(n)).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    number = ((area - 1 - F.when(area > 666, 1).otherwise(0)) * 99 + group - 1) * 9999 + serial - 1
    y = permute(F.when(valid, number).otherwise(0), F.lit(898 * 99 * 9999), key, F.lit("ssn"), secure=True)

    def write(p: Column) -> Column:
        a = F.floor(p / (99 * 9999)) + 1
        a = a + F.when(a >= 666, 1).otherwise(0)
        return F.concat_ws("-", F.lpad(a.cast("string"), 3, "0"),
                           F.lpad((F.floor(p / 9999) % 99 + 1).cast("string"), 2, "0"),
                           F.lpad((p % 9999 + 1).cast("string"), 4, "0"))

    return valid, F.element_at(F.transform(F.array(y), write), 1)


def _phone(v: Column, key: str) -> tuple[Column, Column]:
    country = F.regexp_extract(v, r"^(?:\+[0-9]{1,3}|1)(?=[ .(-])", 0)
    rest = F.substr(v, F.length(country) + 1)
    digits = F.regexp_replace(rest, "[^0-9]", "")
    n = F.length(F.regexp_replace(v, "[^0-9]", ""))
    return n.between(7, 15), F.concat(country, _refill(rest, permute_string(digits, key, "phone")))


def _card(v: Column, key: str) -> Column:
    digits = F.regexp_replace(v, "[^0-9]", "")
    body = permute_string(F.substr(digits, F.lit(1), F.length(digits) - 1), key, "card")

    def close(b: Column) -> Column:
        check = F.pmod(-luhn_sum(F.concat(b, F.lit("0"))), F.lit(10))
        return _refill(v, F.concat(b, check.cast("string")))

    return F.element_at(F.transform(F.array(body), close), 1)


_LONGEST = 37  # 19 digits with a separator between any two


def _card_spans(v: Column) -> Column:
    """Valid cards in a run of numbers, disjoint: array of struct(at, upto), by place.

    A card begins and ends at an end of a number and has 13 to 19 digits.
    Usual forms go before others, then earlier before later, longer before shorter.
    """
    def digit(s: Column, at: Column) -> Column:
        return F.substr(s, at, F.lit(1)).rlike("[0-9]")

    def valid(w: Column, n: Column) -> Column:
        digits = F.regexp_replace(F.substr(w, F.lit(1), n), "[^0-9]", "")
        return F.when(F.length(digits).between(13, 19), luhn_sum(digits) % 10 == 0).otherwise(F.lit(False))

    def at_start(at: Column) -> Column:
        w = F.substr(v, at, F.lit(_LONGEST + 1))

        def inside(w: Column) -> Column:
            ends = F.filter(F.sequence(F.lit(13), F.lit(_LONGEST)),
                            lambda n: digit(w, n) & ~digit(w, n + 1) & valid(w, n))
            return F.transform(ends, lambda n: F.struct(
                F.when(F.substr(w, F.lit(1), n).rlike(f"^(?:{FORMED})$"), 0).otherwise(1).alias("unusual"),
                at.alias("at"), (-n).alias("less")))

        return F.element_at(F.transform(F.array(w), inside), 1)

    starts = F.filter(F.sequence(F.lit(1), F.length(v)),
                      lambda p: digit(v, p) & ((p == 1) | ~digit(v, F.greatest(p - 1, F.lit(1)))))
    spans = F.array_sort(F.flatten(F.transform(starts, at_start)))
    none = F.filter(F.transform(spans, lambda s: F.struct(s["at"].alias("at"), (s["at"] - s["less"]).alias("upto"))),
                    lambda s: F.lit(False))

    def take(acc: Column, s: Column) -> Column:
        upto = s["at"] - s["less"]
        taken = F.exists(acc, lambda t: (t["at"] < upto) & (s["at"] < t["upto"]))
        return F.when(taken, acc).otherwise(F.concat(acc, F.array(F.struct(s["at"].alias("at"), upto.alias("upto")))))

    return F.array_sort(F.aggregate(spans, none, take))


def _cards(v: Column, key: str) -> Column:
    """struct(text, n): a run of numbers with its n cards replaced; text is NULL if there are none."""

    def replace(spans: Column) -> Column:
        start = F.struct(F.lit("").alias("s"), F.lit(1).alias("i"))

        def add(acc: Column, c: Column) -> Column:
            card = _card(F.substr(v, c["at"], c["upto"] - c["at"]), key)
            return F.struct(F.concat(acc["s"], F.substr(v, acc["i"], c["at"] - acc["i"]), card).alias("s"),
                            c["upto"].alias("i"))

        text = F.aggregate(spans, start, add, lambda acc: F.concat(acc["s"], F.substr(v, acc["i"])))
        return F.struct(F.when(F.size(spans) > 0, text).alias("text"), F.size(spans).alias("n"))

    return F.element_at(F.transform(F.array(_card_spans(v)), replace), 1)


def _secret(v: Column, key: str) -> Column:
    head = F.regexp_extract(v, r"^((?i:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key)[\"']?\s*[=:]\s*[\"']?|[\"'])", 1)
    body = F.substr(v, F.length(head) + 1)
    lower, upper = body.rlike("^[0-9a-f]+[\"']?$"), body.rlike("^[0-9A-F]+[\"']?$")
    return F.concat(head, F.when(lower, permute_string(body, key, "hex", _HEX[:1]))
                    .when(upper, permute_string(body, key, "hex", _HEX[1:]))
                    .otherwise(permute_string(body, key, "secret")))


def pseudonym(v: Column, key: str = KEY) -> Column:
    """struct(text, n): one candidate with its n values replaced; text is NULL if none validates."""
    ip_ok, ip = _ipv4(v, key)
    date_ok, date = _date(v, key)
    ssn_ok, ssn = _ssn(v, key)
    phone_ok, phone = _phone(v, key)

    def whole(pattern: str) -> Column:
        return v.rlike(f"^(?:{pattern})$")

    def one(text: Column) -> Column:
        return F.element_at(F.transform(F.array(text), lambda t: F.struct(
            t.alias("text"), F.when(t.isNull(), 0).otherwise(1).alias("n"))), 1)

    return (F.when(whole(EMAIL), one(_email(v, key)))
            .when(whole(SECRET), one(_secret(v, key)))
            .when(whole(IPV4), one(F.when(ip_ok, ip)))
            .when(whole(DATE), one(F.when(date_ok, date)))
            .when(whole(SSN), one(F.when(ssn_ok, ssn)))
            .when(whole(PHONE), one(F.when(phone_ok, phone)))
            .otherwise(_cards(v, key)))


def pseudonymize(docs: DataFrame, text_col: str = "text", key: str = KEY, counts: bool = True) -> DataFrame:
    """``docs`` with validated personal data in ``text_col`` replaced.

    With ``counts``, adds pii_found (candidates) and pii_masked (replaced
    ones); columns of these names are replaced.  A NULL text stays NULL with
    counts 0.  Texts without a candidate are passed on untouched.  One narrow
    stage without shuffle or Python.
    """
    text, found, new = F.col(text_col), F.col("__pii_found"), F.col("__pii_new")
    searched = docs.withColumn("__pii_found", F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(ANY), F.lit(0))))
    searched = searched.withColumn("__pii_new", F.when(F.size(found) > 0,
                                                       F.transform(found, lambda v: pseudonym(v, key))))
    parts = F.split(text, ANY, -1)
    filled = F.concat(F.zip_with(found, new, lambda v, p: F.coalesce(p["text"], v)), F.array(F.lit("")))
    masked = F.concat_ws("", F.zip_with(parts, filled, lambda a, b: F.concat(a, b)))
    added = {text_col: F.when(F.size(new) > 0, masked).otherwise(text)}
    if counts:
        def total(least: int) -> Column:
            return F.when(new.isNull(), 0).otherwise(
                F.aggregate(new, F.lit(0), lambda n, p: n + F.greatest(p["n"], F.lit(least))))

        # A run of numbers is one candidate, or as many as it has cards.
        added["pii_found"], added["pii_masked"] = total(1), total(0)
    return searched.withColumns(added).drop("__pii_found", "__pii_new")
