"""Format-preserving pseudonyms for personal numbers, dates and addresses.

Found values are validated and then permuted by a keyed Feistel network within
their own format, so that equal values get equal pseudonyms in all documents,
different values different ones, and the result still looks and validates like
the original. Everything is SQL functions on the rows; there is no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 10
MARK = "\u0001"     # separates found values from other text while a text is taken apart
CHUNK = 20          # characters of a mail name permuted together
CYCLE_START, CYCLE_DAYS = "1800-01-01", 146_097  # dates are permuted within one 400-year cycle = 189 * 773 days

# Fixed patterns; a neighbour is refused only where it continues the same token: a digit, or a digit behind the value's
# own separator. Commas, line ends and other marks stand between values, also in records without spaces.
EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]*@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
ISO_DATE, SLASH_DATE, POINT_DATE = r"\d{4}-\d{2}-\d{2}", r"\d{2}/\d{2}/\d{4}", r"\d{2}\.\d{2}\.\d{4}"
DATE = f"{ISO_DATE}|{SLASH_DATE}|{POINT_DATE}"
SSN = r"\d{3}-\d{2}-\d{4}"
IP = r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}"
CARD = r"\d{13,19}|\d{4} \d{4} \d{4} \d{4}|\d{4}-\d{4}-\d{4}-\d{4}|\d{4} \d{6} \d{5}|\d{4}-\d{6}-\d{5}"
TEN = r"\+\d{1,3}[ .-]?\(?\d{3}\)?[ .-]?\d{3}[ .-]?\d{4}|\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}"
# Any E.164 grouping of 7 to 15 digits; another value behind a space is not part of it.
E164 = rf"\+[1-9](?:(?! (?:{IP}|{DATE}|{SSN}|{CARD})(?!\d))(?:[ ./-]|[ .-]?\(|\)[ .-]?)?\d){{6,14}}"
# National groupings: 3-3-4; French pairs; German and British area codes; Spanish 3-3-3 and 3-2-2-2.
NATIONAL = (r"(?:1[ .-])?\d{3}-\d{3}-\d{4}|(?:1[ .-])?\d{3}\.\d{3}\.\d{4}|(?:1[ .-])?\d{3} \d{3} \d{4}"
            r"|0\d(?: \d{2}){4}|0\d(?:\.\d{2}){4}|0\d(?:-\d{2}){4}|0\d{9}"
            r"|0\d{1,4}[ /-]\d{3,4}[ -]\d{3,4}|0\d{1,4}[ /-]\d{5,8}|\(0\d{1,4}\) ?\d{3,4}[ -]?\d{3,4}"
            r"|[679]\d{2} \d{3} \d{3}|[679]\d{2} \d{2} \d{2} \d{2}")
PHONE = f"{TEN}|{E164}|{NATIONAL}"
FOUND = (rf"(?<![\w.%+@-])(?:{EMAIL})(?![\w@])|(?<![\w+])(?:{TEN}|{E164})(?!\d)"
         rf"|(?<!\d)(?<!\d\.)(?:{IP})(?!\d|\.\d)|(?<!\d)(?<!\d-)(?:{ISO_DATE}|{SSN})(?!\d|-\d)"
         rf"|(?<!\d)(?<!\d/)(?:{SLASH_DATE})(?!\d|/\d)|(?<!\d)(?<!\d\.)(?:{POINT_DATE})(?!\d|\.\d)"
         rf"|(?<!\w)(?<!\d[.-])(?:{CARD})(?!\w|[.-]\d)|(?<![\w+])(?<!\d[ ./-])(?:{NATIONAL})(?!\w|[./-]\d)")
KINDS = ("email", "phone", "ip", "date", "ssn", "card")


def _prf(key: str, kind: str, i: Column, *parts: Column) -> Column:
    """A keyed 60-bit pseudo-random number."""
    text = F.concat_ws("|", F.lit(key), F.lit(kind), *[p.cast("string") for p in (i, *parts)])
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def _rounds(a: Column, b: Column, step) -> Column:
    """ROUNDS Feistel rounds (a, b) -> (b, step(i, a, b))."""
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
        F.struct(a.cast("long").alias("a"), b.cast("long").alias("b")),
        lambda s, i: F.struct(s["b"].alias("a"), step(i, s["a"], s["b"]).alias("b")))


def feistel(x: Column, radix: int, key: str, kind: str) -> Column:
    """Keyed permutation of the strings of x's length over the digits of ``radix`` (10 or 36), up to 20 long."""
    n = F.length(x)
    u = F.floor(n / 2).cast("int")
    v = n - u
    number = lambda part: F.coalesce(F.conv(part, radix, 10).cast("long"), F.lit(0))
    done = _rounds(number(F.substring(x, F.lit(1), u)), number(F.substring(x, u + 1, v)),
                   lambda i, a, b: F.pmod(a + F.pmod(_prf(key, kind, i, n, b), F.pow(
                       F.lit(float(radix)), F.when(i % 2 == 0, u).otherwise(v)).cast("long")), F.pow(
                       F.lit(float(radix)), F.when(i % 2 == 0, u).otherwise(v)).cast("long")))
    text = lambda value, width: F.lpad(F.lower(F.conv(value.cast("string"), 10, radix)), width, F.lit("0"))
    return F.transform(F.array(done), lambda d: F.concat(text(d["a"], u), text(d["b"], v)))[0]


def _mixed(left: Column, right: Column, m: int, n: int, key: str, kind: str) -> Column:
    """Keyed permutation of pairs (left < m, right < n), by alternating additions."""
    return F.aggregate(
        F.sequence(F.lit(0), F.lit(ROUNDS - 1)),
        F.struct(left.cast("long").alias("l"), right.cast("long").alias("r")),
        lambda s, i: F.struct(
            F.when(i % 2 == 0, F.pmod(s["l"] + F.pmod(_prf(key, kind, i, s["r"]), F.lit(m)), F.lit(m)))
            .otherwise(s["l"]).cast("long").alias("l"),
            F.when(i % 2 == 1, F.pmod(s["r"] + F.pmod(_prf(key, kind, i, s["l"]), F.lit(n)), F.lit(n)))
            .otherwise(s["r"]).cast("long").alias("r")))


def _once(value: Column, use) -> Column:
    """use(value) with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _luhn(digits: Column) -> Column:
    """The Luhn sum of a digit string."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
        return total + F.when((n - i) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _digits(x: Column) -> Column:
    return F.regexp_replace(x, "[^0-9]", "")


def _refill(x: Column, symbols: Column, pattern: str) -> Column:
    """x with its characters of ``pattern`` replaced, in order, by those of ``symbols``."""

    def place(p: Column) -> Column:
        rank = F.length(F.regexp_replace(F.substring(x, F.lit(1), p), f"[^{pattern}]", ""))
        own = F.substring(x, p, F.lit(1))
        return F.when(own.rlike(f"[{pattern}]"), F.substring(symbols, rank, F.lit(1))).otherwise(own)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(x)), place), "")


def _day(x: Column) -> Column:
    """The date of a matched date (null if invalid or outside the permuted cycle)."""
    day = F.coalesce(F.when(x.rlike(r"^\d{4}-"), F.try_to_date(x, "yyyy-MM-dd")),
                     F.when(x.contains("/"), F.try_to_date(x, "dd/MM/yyyy")),
                     F.when(x.contains("."), F.try_to_date(x, "dd.MM.yyyy")))
    gap = F.datediff(day, F.lit(CYCLE_START).cast("date"))
    return F.when((gap >= 0) & (gap < CYCLE_DAYS), day)


def kind_of(x: Column) -> Column:
    """The kind of a matched value; null if it does not validate."""
    octets = F.split(x, r"\.")
    return (F.when(x.contains("@"), F.lit("email"))
            .when(x.rlike(rf"^(?:{PHONE})$"), F.lit("phone"))
            .when(x.rlike(rf"^{IP}$"), F.when(F.forall(octets, lambda o: o.cast("int") < 256), F.lit("ip")))
            .when(x.rlike(rf"^(?:{DATE})$"), F.when(_day(x).isNotNull(), F.lit("date")))
            .when(x.rlike(rf"^{SSN}$"),
                  F.when(x.rlike(r"^(?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4}$"), F.lit("ssn")))
            .when(_luhn(_digits(x)) % 10 == 0, F.lit("card")))


def _email(x: Column, key: str) -> Column:
    """The name part permuted over its letters and digits (case folded); the domain stays."""
    name = F.lower(F.substring_index(x, "@", 1))
    plain = F.regexp_replace(name, "[^a-z0-9]", "")
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.length(plain) - 1) / CHUNK).cast("int")),
                         lambda k: F.concat(feistel(F.substring(plain, k * CHUNK + 1, F.lit(CHUNK)), 36, key, "email")))
    return F.concat(_once(F.array_join(chunks, ""), lambda s: _refill(name, s, "a-z0-9")),
                    F.substring(x, F.instr(x, "@"), F.length(x)))


def _phone(x: Column, key: str) -> Column:
    """The last ten digits permuted, or all but the country code or the leading 0; these stay."""
    digits = _digits(x)
    n = F.length(digits)
    code = F.when(~x.startswith("+"), digits.startswith("0").cast("int")).when(digits.rlike("^[17]"), 1).otherwise(2)
    width = F.when(x.rlike(f"^(?:{TEN})$"), 10).otherwise(F.least(F.lit(10), n - code))
    new = F.concat(F.substring(digits, F.lit(1), n - width),
                   feistel(F.substring(digits, n - width + 1, width), 10, key, "phone"))
    return _once(new, lambda s: _refill(x, s, "0-9"))


def _ip(x: Column, key: str) -> Column:
    o = [F.split(x, r"\.")[i].cast("int") for i in range(4)]
    done = _mixed(o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536, key, "ip")
    return _once(done, lambda d: F.concat_ws(
        ".", *[p.cast("string") for c in ("l", "r") for p in (F.floor(d[c] / 256), d[c] % 256)]))


def _date(x: Column, key: str) -> Column:
    gap = F.datediff(_day(x), F.lit(CYCLE_START).cast("date"))
    done = _mixed(F.floor(gap / 773), gap % 773, 189, 773, key, "date")
    new = F.date_add(F.lit(CYCLE_START).cast("date"), (done["l"] * 773 + done["r"]).cast("int"))
    return _once(new, lambda d: F.when(x.contains("/"), F.date_format(d, "dd/MM/yyyy"))
                 .when(x.contains("."), F.date_format(d, "dd.MM.yyyy")).otherwise(F.date_format(d, "yyyy-MM-dd")))


def _ssn(x: Column, key: str) -> Column:
    """Permuted among the 898 x 99 x 9999 valid numbers."""
    area, rest = F.substring(x, 1, 3).cast("int"), F.split(x, "-")
    left = F.when(area > 666, area - 2).otherwise(area - 1)
    done = _mixed(left, (rest[1].cast("int") - 1) * 9999 + rest[2].cast("int") - 1, 898, 99 * 9999, key, "ssn")
    pad = lambda c, n: F.lpad(c.cast("string"), n, "0")
    return _once(done, lambda d: F.concat_ws(
        "-", pad(F.when(d["l"] >= 665, d["l"] + 2).otherwise(d["l"] + 1), 3),
        pad(F.floor(d["r"] / 9999) + 1, 2), pad(d["r"] % 9999 + 1, 4)))


def _card(x: Column, key: str) -> Column:
    """All digits but the last permuted; the last is the new check digit."""
    digits = _digits(x)
    body = feistel(F.substring(digits, F.lit(1), F.length(digits) - 1), 10, key, "card")
    whole = _once(body, lambda b: F.concat(b, F.pmod(-_luhn(F.concat(b, F.lit("0"))), F.lit(10)).cast("string")))
    return _once(whole, lambda s: _refill(x, s, "0-9"))


_MAKE = {"email": _email, "phone": _phone, "ip": _ip, "date": _date, "ssn": _ssn, "card": _card}


def pseudonymise(docs: DataFrame, keep: list[str], key: str, text_col: str = "text") -> DataFrame:
    """``keep`` columns, the pseudonymised text and n_email, n_phone, n_ip, n_date, n_ssn, n_card.

    Mail addresses keep their domain and punctuation, phones the country code
    or the leading 0, all values their length and separators. Numbers that do not validate
    (Luhn, octets, calendar, number ranges) and all other text stay as they
    are. The pseudonym depends on key and value only. A null text stays null
    with zero counts; the empty text stays empty; very long texts are
    processed whole. Kept columns called like a result are replaced.
    """
    made = ["text", *[f"n_{k}" for k in KINDS]]
    keep = [c for c in keep if c not in made]
    text = F.col(text_col)
    marked = F.regexp_replace(F.replace(text, F.lit(MARK), F.lit(MARK + MARK)), FOUND, f"{MARK}$0{MARK}")
    parts = F.when(text.rlike("[0-9@]"), F.split(marked, MARK, -1)).otherwise(F.array(F.coalesce(text, F.lit(""))))
    # Odd parts are found values; an empty one is a mark of the text itself.
    kinds = F.transform("panelkit_parts", lambda x, i: F.when((i % 2 == 1) & (x != ""), kind_of(x)))

    def renew(x: Column, kind: Column) -> Column:
        out = F.when(kind.isNull(), x)
        for name, make in _MAKE.items():
            out = out.when(kind == name, make(x, key))
        return out

    joined = F.array_join(F.transform(
        F.arrays_zip(F.col("panelkit_parts").alias("x"), F.col("panelkit_kinds").alias("k")),
        lambda p, i: F.when((i % 2 == 1) & (p["x"] == ""), F.lit(MARK)).otherwise(renew(p["x"], p["k"]))), "")
    def count(kind: str) -> Column:
        return F.size(F.filter("panelkit_kinds", lambda k: k == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    plain = docs.select(*keep, text.alias("panelkit_text"), parts.alias("panelkit_parts"))
    found = plain.withColumn("panelkit_kinds", kinds)
    return found.select(*keep, F.when(F.col("panelkit_text").isNotNull(), joined).alias("text"), *counts)
