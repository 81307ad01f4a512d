"""Format-preserving pseudonyms for personal data, in DataFrame expressions only.

Found values are validated and then permuted within their format by a keyed Feistel network, so
equal values get equal pseudonyms in every document, different values different ones, and the
key's owner can invert them:

- card numbers (13 to 19 digits, in one or in the usual groups, Luhn valid): payload permuted, check digit made anew
- IBANs (mod 97 valid, unbroken or in the printed groups of four): digits and letters of the account permuted, check digits made anew
- US social security numbers (valid area, group and serial): permuted among the valid ones
- dates (ISO, also before a time; day/month/year with / or ., one digit or two; month/day/year where the
  day can be no month; real days only): permuted within their century, month-first ones among themselves
- IPv4 addresses: permuted among the 32-bit numbers
- phone numbers (North American ones, +country numbers of 7 to 15 digits): the last ten digits, or all
  after two of a shorter international number, permuted, punctuation kept
- e-mail addresses (up to the standard's 320 characters): letters and digits permuted, case, punctuation and last label kept

The network adds keyed SHA-256 values to the two halves in turn, modulo their sizes ``a`` and
``b``; any ``a * b`` values are a domain, so formats that are no power of ten need no retries.

Cases: null text stays null; a text without personal data is returned as it is; numbers that fail
validation are left alone; repeated rows and ties get the same result. Extra columns are kept,
also such as are named like a column made here: results are put in by ``text_col`` alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .common import unused

CYCLES = 5      # each cycle changes both halves: ten rounds

# The formats. Every one holds a digit or an @; quantifiers are possessive where
# a long run could be tried again and again.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
#: The registry's lengths, which end an IBAN in groups.
IBAN_LENGTHS = {15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
                22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
                26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV", 29: "BR EG PS QA UA",
                30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}
GROUPED = "|".join(rf"(?:{'|'.join(lands.split())})\d{{2}}(?: [A-Z0-9]{{4}}){{{n // 4 - 1}}}" + (rf" [A-Z0-9]{{{n % 4}}}" if n % 4 else "")
                   for n, lands in IBAN_LENGTHS.items())
IBAN = rf"(?<!\w)(?:[A-Z]{{2}}\d{{2}}[A-Z0-9]{{11,30}}+|{GROUPED})(?!\w)"
SSN = r"(?<![\w-])(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}(?![\w-])"
DAY, MONTH, YEAR = r"(?:0[1-9]|[12]\d|3[01])", r"(?:0[1-9]|1[0-2])", r"[12]\d{3}"
ISO_DATE = rf"(?<![\w-]){YEAR}-{MONTH}-{DAY}(?!(?!T\d\d:?\d\d)[\w-])"
DAY1, MONTH1 = r"(?:0?[1-9]|[12]\d|3[01])", r"(?:0?[1-9]|1[0-2])"
DAY_DATE = rf"(?<![\w/.]){DAY1}(?:/{MONTH1}/|\.{MONTH1}\.){YEAR}(?![\w/])"
MONTH_DATE = rf"(?<![\w/.]){MONTH1}/(?:1[3-9]|2\d|3[01])/{YEAR}(?![\w/])"
OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
IP = rf"(?<![\w.]){OCTET}\.{OCTET}\.{OCTET}\.{OCTET}(?!\w|\.\d)"
PHONE = (r"(?<![\w+])\+\d{1,3}[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}(?!\d)"
         r"|(?<![\w(])\(\d{3}\) ?\d{3}-\d{4}(?!\d)|(?<![\w-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-])"
         r"|(?<![\w+])\+[1-9](?:[ .-]?\(?\d\)?){6,14}(?!\d)"
         r"|(?<![\w+-])1[ .-]\d{3}[ .-]\d{3}[ .-]\d{4}(?![\w-])|(?<![\w+-])\d{3} \d{3} \d{4}(?![\w-])")
CARD = r"(?<![\w+-])(?:\d{13,19}|\d{4}[ -]\d{4}[ -]\d{4}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{4,5})(?![\w-])"
KINDS = {"email": EMAIL, "iban": IBAN, "ssn": SSN, "date": f"{ISO_DATE}|{DAY_DATE}|{MONTH_DATE}", "ip": IP, "phone": PHONE, "card": CARD}
ANY = "|".join(KINDS.values())

lit = F.lit
EMAIL_LONGEST = 320     # fixed value: 64 before the @ and 255 after it; what is longer is no address
WALK = 64
DIGITS_EACH, LETTERS_EACH = 18, 12      # longest runs that are permuted as one value


def bind(x: Column, f) -> Column:
    """``f(x)`` with ``x`` evaluated once, however often ``f`` names it."""
    return F.element_at(F.transform(F.array(x), f), 1)


def _whole(x: Column, y) -> Column:
    """Whole division of numbers far below 2**53."""
    return F.floor(x / y).cast("bigint")


def permuted(left: Column, right: Column, a: Column, b: Column, key: str, tweak: Column) -> Column:
    """A keyed permutation of the pairs 0 <= left < a, 0 <= right < b: struct(l, r)."""
    def value(i: Column, half: Column, size: Column) -> Column:
        said = F.concat_ws("|", lit(key), tweak, i.cast("string"), half.cast("string"))
        return F.conv(F.substring(F.sha2(said.cast("binary"), 256), 1, 14), 16, 10).cast("bigint") % size

    def cycle(s: Column, i: Column) -> Column:
        return bind((s["l"] + value(i * 2, s["r"], a)) % a, lambda new: F.struct(
            new.cast("bigint").alias("l"), ((s["r"] + value(i * 2 + 1, new, b)) % b).cast("bigint").alias("r")))

    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))
    return F.aggregate(F.sequence(lit(1), lit(CYCLES)), start, cycle)


def _power(base: int, n: Column) -> Column:
    return F.element_at(F.array(*[lit(base ** i).cast("bigint") for i in range(10)]), n.cast("int") + 1)


def _runs(s: Column, each: int, one) -> Column:
    """``one(run, previous run)`` over consecutive runs of ``each`` characters, joined."""
    def over(t: Column) -> Column:
        starts = F.sequence(lit(1), F.length(t), lit(each))
        return F.when(F.length(t) == 0, t).otherwise(F.array_join(F.transform(starts, lambda j: bind(F.struct(
            F.substr(t, j, lit(each)).alias("run"), F.when(j == 1, lit("")).otherwise(F.substr(t, j - each, lit(each))).alias("before")),
            lambda x: one(x["run"], x["before"]))), ""))

    return bind(s, over)


def permuted_digits(s: Column, key: str, tweak: Column) -> Column:
    """A digit string permuted among those of its length; beyond 18 digits run by run, each under
    its predecessor's value, which keeps it invertible."""
    def one(run: Column, before: Column) -> Column:
        h = _whole(F.length(run), 2).cast("int")
        k = F.length(run) - h
        left = F.when(h > 0, F.substr(run, lit(1), h).cast("bigint")).otherwise(0)
        return bind(permuted(left, F.substr(run, h + 1, k), _power(10, h), _power(10, k), key,
                             F.concat_ws("/", tweak, F.length(run), before)),
                    lambda out: F.concat(F.when(h > 0, F.lpad(out["l"].cast("string"), h, "0")).otherwise(""),
                                         F.lpad(out["r"].cast("string"), k, "0")))

    return _runs(s, DIGITS_EACH, one)


def permuted_letters(s: Column, key: str, tweak: Column) -> Column:
    """A string of a-z permuted among those of its length, run by run like the digits."""
    def number(t: Column) -> Column:
        return F.aggregate(F.filter(F.split(t, ""), lambda c: c != ""), lit(0).cast("bigint"), lambda n, c: n * 26 + (F.ascii(c) - 97))

    def letters(x: Column, n: Column) -> Column:
        return F.when(n == 0, "").otherwise(F.array_join(F.transform(
            F.sequence(n - 1, lit(0), lit(-1)), lambda j: F.char((97 + _whole(x, _power(26, j)) % 26))), ""))

    def one(run: Column, before: Column) -> Column:
        h = _whole(F.length(run), 2).cast("int")
        k = F.length(run) - h
        return bind(permuted(number(F.substr(run, lit(1), h)), number(F.substr(run, h + 1, k)), _power(26, h), _power(26, k),
                             key, F.concat_ws("/", tweak, F.length(run), before)),
                    lambda out: F.concat(letters(out["l"], h), letters(out["r"], k)))

    return _runs(s, LETTERS_EACH, one)


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _letters(v: Column) -> Column:
    return F.lower(F.regexp_replace(v, "[^A-Za-z]", ""))


def refilled(v: Column, digits: Column, letters: Column | None = None) -> Column:
    """``v`` with its digits (and letters, case kept) taken in order from the given strings."""
    def fill(new: Column) -> Column:
        def at(i: Column) -> Column:
            c, so_far = F.substr(v, i, lit(1)), F.substr(v, lit(1), i)
            out = F.when(c.rlike("[0-9]"), F.substr(new["d"], F.length(_digits(so_far)), lit(1)))
            if letters is not None:
                letter = F.substr(new["l"], F.length(_letters(so_far)), lit(1))
                out = out.when(c.rlike("[A-Z]"), F.upper(letter)).when(c.rlike("[a-z]"), letter)
            return out.otherwise(c)

        return F.array_join(F.transform(F.sequence(lit(1), F.length(v)), at), "")

    return bind(F.struct(digits.alias("d"), (lit("") if letters is None else letters).alias("l")), fill)


def luhn_digit(payload: Column) -> Column:
    """The check digit after ``payload`` (a digit string)."""
    n = F.length(payload)
    total = F.aggregate(F.sequence(lit(1), n), lit(0), lambda t, i: t + F.when(
        (n - i) % 2 == 0, F.substr(payload, i, lit(1)).cast("int") * 2 - F.when(F.substr(payload, i, lit(1)).cast("int") > 4, 9).otherwise(0))
        .otherwise(F.substr(payload, i, lit(1)).cast("int")))
    return ((lit(10) - total % 10) % 10).cast("string")


def mod97(text: Column) -> Column:
    """Digits and letters (A = 10 .. Z = 35) read as a number, modulo 97."""
    return F.aggregate(F.filter(F.split(text, ""), lambda c: c != ""), lit(0), lambda r, c: F.when(
        c.rlike("[0-9]"), r * 10 + c.try_cast("int")).otherwise(r * 100 + F.ascii(c) - 55) % 97)


def _email(v: Column, key: str) -> Column:
    cut = F.length(v) - F.length(F.substring_index(v, ".", -1)) - 1
    new = F.concat(bind(F.substr(v, lit(1), cut), lambda body: refilled(
        body, permuted_digits(_digits(body), key, lit("email")), permuted_letters(_letters(body), key, lit("email")))),
        F.substr(v, cut + 1))
    return F.when(F.length(v) <= EMAIL_LONGEST, new).otherwise(v)


def _iban(v: Column, key: str) -> Column:
    def checked(x: Column) -> Column:
        land = F.substring(x, 1, 2)
        new = bind(F.substr(x, lit(5)), lambda account: refilled(
            account, permuted_digits(_digits(account), key, land), permuted_letters(_letters(account), key, land)))
        made = bind(new, lambda n: F.concat(land, F.lpad((98 - mod97(F.concat(n, land, lit("00")))).cast("string"), 2, "0"), n))
        return F.when(mod97(F.concat(F.substr(x, lit(5)), F.substring(x, 1, 4))) == 1,
                      bind(made, lambda m: refilled(v, _digits(m), _letters(m)))).otherwise(v)

    return bind(F.replace(v, lit(" "), lit("")), checked)


def _ssn(v: Column, key: str) -> Column:
    area, group, serial = (F.substring(v, i, n).cast("int") for i, n in ((1, 3), (5, 2), (8, 4)))
    place = area - F.when(area > 666, 2).otherwise(1)       # 898 areas: 1 to 899 without 666
    pad = lambda x, n: F.lpad(x.cast("string"), n, "0")
    return bind(permuted(place * 99 + group - 1, serial - 1, lit(898 * 99), lit(9999), key, lit("ssn")), lambda out: bind(
        _whole(out["l"], 99) + 1, lambda new: F.concat_ws("-", pad(new + F.when(new >= 666, 1).otherwise(0), 3),
                                                          pad(out["l"] % 99 + 1, 2), pad(out["r"] + 1, 4))))


def _date(v: Column, key: str) -> Column:
    iso = v.rlike("^[0-9]{4}-")
    part = [F.split_part(F.translate(v, ".", "/"), lit("/"), lit(i)) for i in (1, 2, 3)]
    american = ~iso & (F.when(iso, 0).otherwise(part[1].try_cast("int")) > 12)
    day, month = F.when(american, part[1]).otherwise(part[0]), F.when(american, part[0]).otherwise(part[1])
    text = F.when(iso, v).otherwise(F.concat_ws("-", part[2], F.lpad(month, 2, "0"), F.lpad(day, 2, "0")))

    def moved(x: Column) -> Column:
        a, b = F.when(x["full"], 75).otherwise(92), F.when(x["full"], 487).otherwise(397)   # 36525 days, or 36524
        tweak = F.concat(lit("date"), x["first"].cast("string"))

        def step(at: Column) -> Column:
            out = permuted(_whole(at, b), at % b, a, b, key, tweak)
            return bind(out, lambda o: (o["l"] * b + o["r"]).cast("int"))

        # Month-first values go on along their cycle to the next day that can be no month; WALK steps all but surely hold one.
        on = F.aggregate(F.sequence(lit(1), F.when(american, WALK).otherwise(1)), F.struct(x["at"].cast("int").alias("at"), lit(False).alias("done")),
                         lambda s, _: F.when(s["done"], s).otherwise(bind(step(s["at"]), lambda n: F.struct(
                             n.alias("at"), (F.dayofmonth(F.date_add(x["first"], n)) > 12).alias("done")))))
        return F.date_add(x["first"], on["at"])

    century = F.substring(text, 1, 2).cast("int")
    first = F.make_date(century * 100, lit(1), lit(1))
    new = bind(F.struct(F.datediff(text.try_cast("date"), first).alias("at"), first.alias("first"), (century % 4 == 0).alias("full")), moved)
    short = v.rlike(r"^[0-9][./]|[./][0-9][./]")

    mark = F.when(v.contains("/"), "/").otherwise(".")

    def layout(n: Column) -> Column:
        first, second = F.when(american, F.month(n)).otherwise(F.day(n)), F.when(american, F.day(n)).otherwise(F.month(n))
        pad = lambda x: F.when(short, x.cast("string")).otherwise(F.lpad(x.cast("string"), 2, "0"))
        return F.when(iso, F.date_format(n, "yyyy-MM-dd")).otherwise(F.concat(
            pad(first), mark, pad(second), mark, F.date_format(n, "yyyy")))

    shown = bind(new, layout)
    return F.when(text.try_cast("date").isNull(), v).otherwise(shown)


def _ip(v: Column, key: str) -> Column:
    o = [F.split_part(v, lit("."), lit(i)).cast("int") for i in (1, 2, 3, 4)]
    return bind(permuted(o[0] * 256 + o[1], o[2] * 256 + o[3], lit(65536), lit(65536), key, lit("ip")),
                lambda out: F.concat_ws(".", _whole(out["l"], 256), out["l"] % 256, _whole(out["r"], 256), out["r"] % 256))


def _phone(v: Column, key: str) -> Column:
    def moved(d: Column) -> Column:
        n = F.length(d)
        k = F.when(v.startswith("+1"), F.least(n - 1, lit(10))).when(v.startswith("+"), F.least(n - 2, lit(10))).otherwise(10)
        return bind(k, lambda k: refilled(v, F.concat(F.substr(d, lit(1), n - k), permuted_digits(F.substr(d, n - k + 1, k), key, lit("phone")))))

    return bind(_digits(v), moved)


def _card(v: Column, key: str) -> Column:
    def checked(d: Column) -> Column:
        payload = F.substr(d, lit(1), F.length(d) - 1)
        new = bind(permuted_digits(payload, key, lit("card")), lambda n: F.concat(n, luhn_digit(n)))
        return F.when(luhn_digit(payload) == F.substr(d, F.length(d), lit(1)), refilled(v, new)).otherwise(v)

    return bind(_digits(v), checked)


_MAKE = {"email": _email, "iban": _iban, "ssn": _ssn, "date": _date, "ip": _ip, "phone": _phone, "card": _card}


def pseudonym(value: Column, key: str) -> Column:
    """The pseudonym of one found value (the value itself if it fails validation)."""
    out = None
    for kind, pattern in KINDS.items():
        test = value.rlike(f"^(?:{pattern})$")
        out = F.when(test, _MAKE[kind](value, key)) if out is None else out.when(test, _MAKE[kind](value, key))
    return out.otherwise(value)


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with pseudonyms in ``text_col`` and, if named, the number of values replaced in
    ``count_col``. One pass over the rows: no shuffle, no Python. ``key`` is the caller's secret and must not
    be empty."""
    if not key:
        raise ValueError("pseudonyms need a key")
    text = F.col(text_col)
    found = F.when(text.rlike("[0-9@]"), F.regexp_extract_all(text, lit(f"({ANY})"), lit(1)))
    old, new = unused(docs, "__found"), unused(docs, "__new")
    work = docs.withColumn(old, F.when(F.size(found) > 0, found))
    work = work.withColumn(new, F.transform(old, lambda v: pseudonym(v, key)))
    gaps = F.split(text, ANY, -1)
    made = F.array_join(F.zip_with(gaps, F.concat(new, F.array(lit(""))), lambda g, v: F.concat(g, v)), "")
    changed = F.coalesce(F.size(F.filter(F.zip_with(old, new, lambda a, b: a != b), lambda x: x)), lit(0))
    out = {text_col: F.when(F.col(new).isNull(), text).otherwise(made)}
    if count_col:
        out[count_col] = F.greatest(changed, lit(0)).cast("bigint")
    return work.withColumns(out).drop(old, new)
