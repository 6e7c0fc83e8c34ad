"""Personal data: format-preserving Feistel pseudonyms, built-in functions only.

Found and validated: payment cards (13 to 19 digits, Luhn), North American
phone numbers, E.164 numbers, US social security numbers, IPv4 addresses,
dates, and the local part of e-mail addresses. Numbers may be grouped by spaces,
dots or dashes, which do not count for the pseudonym; a +1 and ten digits are a
phone number however they are grouped, and so are ten digits alone with valid
area and exchange codes. Every value is replaced by a keyed permutation of
itself within its format:

* The value is a number in a domain a x b, or for e-mail a string of letters
  and digits in two halves. Each round adds to one half a SHA-256 of the key,
  the format, the round and the other half, modulo the size of that half. Every
  round can be undone, so the whole is a permutation of the format: equal values
  get equal pseudonyms in all documents, different values different ones.
* An e-mail's local part with characters beyond ASCII is not permuted but
  replaced by a keyed 128-bit token: equal values stay linked, the length does not.
* Pseudonyms are valid values again: cards get a new check digit, area and
  exchange codes begin with 2 to 9, dates stay in their century block (1930-2029
  and so on) and are real days. Separators, a leading +1, the e-mail's domain,
  letter case and anything that does not validate stay as they are.

Everything is computed inside the row, so there is no shuffle. Defined results:
NULL text stays NULL; empty text stays empty; equal rows get equal texts; an
empty table gives no rows; other columns, whatever their names, are not read.
Texts are processed whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
MIN_KEY = 16            # bytes

_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
PATTERNS = {         # in order of precedence at one place
    "email": (r"(?<![\p{L}\p{M}\p{N}._%+-])[\p{L}\p{M}\p{N}._%+-]++"
              r"@[\p{L}\p{M}\p{N}-]++(?:\.[\p{L}\p{M}\p{N}-]+){1,8}"),
    "ipv4": rf"(?<![0-9.]){_OCTET}(?:\.{_OCTET}){{3}}(?!\.?[0-9])",
    "date": (r"(?<![0-9])(?:1[89]|20)[0-9]{2}-[01][0-9]-[0-3][0-9](?![0-9])"
             r"|(?<![0-9.])[0-3][0-9]\.[01][0-9]\.(?:1[89]|20)[0-9]{2}(?![0-9])"
             r"|(?<![0-9/])[01][0-9]/[0-3][0-9]/(?:1[89]|20)[0-9]{2}(?![0-9])"),
    "ssn": r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
    "phone": (r"(?<![0-9A-Za-z])\+1 \([0-9]{3}\) [0-9]{3}-[0-9]{4}(?![0-9A-Za-z])"
              r"|(?<![0-9A-Za-z])(?:\+?1[-. ]?)?(?:\([2-9][0-9]{2}\) ?|[2-9][0-9]{2}[-. ])"
              r"[2-9][0-9]{2}[-. ][0-9]{4}(?![0-9A-Za-z])"
              r"|(?<![0-9A-Za-z+])\+1(?:[-. ]?[0-9]){10}(?![0-9A-Za-z])"
              r"|(?<![0-9A-Za-z.,/_+-])1?[2-9][0-9]{2}[2-9][0-9]{6}(?![0-9A-Za-z/_-]|[.,][0-9])"),
    "e164": (r"(?<![0-9A-Za-z+])\+[1-9][0-9]{7,14}(?![0-9A-Za-z])"
             r"|(?<![0-9A-Za-z+])\+[1-9][0-9]{0,2}[-. ](?:\([0-9]{1,4}\)[-. ]?)?"
             r"[0-9](?:[-. ]?[0-9]){6,11}(?![0-9A-Za-z/])"),
    "card": (r"(?<![0-9A-Za-z])(?:[0-9]{4}(?:-[0-9]{4}){3}|[0-9]{4}(?: [0-9]{4}){3}"
             r"|[0-9]{4}-[0-9]{6}-[0-9]{5}|[0-9]{4} [0-9]{6} [0-9]{5}|[0-9]{13,19})"
             r"(?![0-9A-Za-z])"),
}
ANY = "|".join(PATTERNS.values())


def _prf(key: str, kind: str, i: Column, other: Column) -> Column:
    """A 60-bit number from the key, the format, the round and the other half."""
    text = F.concat_ws(":", F.lit(f"{key}:{kind}"), i.cast("string"), other.cast("string"))
    return F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, a: Column | int, b: Column | int, key: str,
            kind: str) -> Column:
    """The pair (l, r) in a x b that (left, right) becomes."""
    a, b = (F.lit(x).cast("long") if isinstance(x, int) else x for x in (a, b))

    def step(s: Column, i: Column) -> Column:
        turn = i % 2 == 0
        return F.struct(
            F.when(turn, F.pmod(s["l"] + F.pmod(_prf(key, kind, i, s["r"]), a), a))
            .otherwise(s["l"]).alias("l"),
            F.when(turn, s["r"])
            .otherwise(F.pmod(s["r"] + F.pmod(_prf(key, kind, i, s["l"]), b), b)).alias("r"))

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _chars(m: Column) -> Column:
    return F.split(m, "")


def _padded(x: Column, width: Column | int) -> Column:
    return F.lpad(x.cast("string"), width, "0")


def _into(m: Column, digits: Column) -> Column:
    """``m`` with its digits replaced, in order, by ``digits``."""
    skip = F.length(_digits(m)) - F.length(digits)

    def char(c: Column, i: Column) -> Column:
        at = F.length(_digits(F.substring(m, F.lit(1), i + 1))) - skip
        return F.when(c.rlike("^[0-9]$") & (at > 0), F.substring(digits, at, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(_chars(m), char), "")


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string whose last digit counts once."""
    def add(acc: Column, x: Column) -> Column:
        v = x["d"] * F.when(x["twice"], F.lit(2)).otherwise(F.lit(1))
        return acc + F.when(v > 9, v - 9).otherwise(v)

    places = F.transform(_chars(F.reverse(digits)), lambda c, i: F.struct(
        c.cast("int").alias("d"), (i % 2 == 1).alias("twice")))
    return F.aggregate(places, F.lit(0), add)


def _card(m: Column, key: str) -> Column:
    def swap(d: Column) -> Column:
        n = F.length(d) - 1                      # the payload; the last digit checks it
        half = F.floor(n / 2).cast("int")
        rest = n - half
        ten = F.lit(10.0)
        p = feistel(F.substring(d, F.lit(1), half), F.substring(d, half + 1, rest),
                    F.pow(ten, half).cast("long"), F.pow(ten, rest).cast("long"), key, "card")

        def checked(payload: Column) -> Column:
            check = F.pmod(-luhn_sum(F.concat(payload, F.lit("0"))), F.lit(10))
            return F.concat(payload, check.cast("string"))

        new = _let(p, lambda x: F.concat(_padded(x["l"], half), _padded(x["r"], rest)))
        return F.when(luhn_sum(d) % 10 == 0, _into(m, _let(new, checked)))

    return _let(_digits(m), swap)


def _phone(m: Column, key: str) -> Column:
    """Area and exchange codes of 200 and above are permuted among themselves;
    a code that cannot be one stays, and the other parts are permuted."""
    def swap(d: Column) -> Column:
        area, office = (F.substring(d, at, 3).cast("long") for at in (1, 4))
        line = F.substring(d, 7, 4).cast("long")

        def free(code: Column) -> Column:
            return F.when(code >= 200, F.lit(800)).otherwise(F.lit(1)).cast("long")

        def low(code: Column) -> Column:
            return F.when(code >= 200, code - 200).otherwise(F.lit(0))

        p = feistel(low(area), low(office) * 10_000 + line, free(area), free(office) * 10_000, key,
                    "phone")

        def new(code: Column, x: Column) -> Column:
            return _padded(F.when(code >= 200, x + 200).otherwise(code), 3)

        return _into(m, _let(p, lambda x: F.concat(
            new(area, x["l"]), new(office, F.floor(x["r"] / 10_000)), _padded(x["r"] % 10_000, 4))))

    return _let(F.right(_digits(m), F.lit(10)), swap)


def _e164(m: Column, key: str) -> Column:
    def swap(d: Column) -> Column:               # the first three digits name the country
        n = F.length(d) - 3
        half = F.floor(n / 2).cast("int")
        rest = n - half
        p = feistel(F.substring(d, F.lit(4), half), F.substring(d, half + 4, rest),
                    F.pow(F.lit(10.0), half).cast("long"), F.pow(F.lit(10.0), rest).cast("long"),
                    key, "e164")
        return _into(m, _let(p, lambda x: F.concat(
            F.substring(d, 1, 3), _padded(x["l"], half), _padded(x["r"], rest))))

    return _let(_digits(m), swap)


def _ssn(m: Column, key: str) -> Column:
    def swap(d: Column) -> Column:
        area = F.substring(d, 1, 3).cast("long")
        area = area - F.when(area > 666, F.lit(2)).otherwise(F.lit(1))       # 001-899 without 666
        rest = (F.substring(d, 4, 2).cast("long") - 1) * 9999 + F.substring(d, 6, 4).cast("long") - 1
        p = feistel(area, rest, 898, 99 * 9999, key, "ssn")
        return _let(p, lambda x: F.concat_ws(
            "-", _padded(x["l"] + F.when(x["l"] >= 665, F.lit(2)).otherwise(F.lit(1)), 3),
            _padded(F.floor(x["r"] / 9999) + 1, 2), _padded(x["r"] % 9999 + 1, 4)))

    return _let(_digits(m), swap)


def _ipv4(m: Column, key: str) -> Column:
    def swap(o: Column) -> Column:
        n = [F.get(o, F.lit(i)).cast("long") for i in range(4)]
        p = feistel(n[0] * 256 + n[1], n[2] * 256 + n[3], 65_536, 65_536, key, "ipv4")
        return _let(p, lambda x: F.concat_ws(".", *[
            c.cast("string") for c in (F.floor(x["l"] / 256), x["l"] % 256,
                                       F.floor(x["r"] / 256), x["r"] % 256)]))

    return _let(F.split(m, r"\."), swap)


def _date(m: Column, key: str) -> Column:
    iso = (F.when(m.rlike(r"^[0-9]{4}-"), m)
           .when(m.contains("."), F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 4, 2),
                                              F.substring(m, 1, 2)))
           .otherwise(F.concat_ws("-", F.substring(m, 7, 4), F.substring(m, 1, 2),
                                  F.substring(m, 4, 2))))

    def like_m(new: Column) -> Column:
        return (F.when(m.rlike(r"^[0-9]{4}-"), F.date_format(new, "yyyy-MM-dd"))
                .when(m.contains("."), F.date_format(new, "dd.MM.yyyy"))
                .otherwise(F.date_format(new, "MM/dd/yyyy")))

    def swap(day: Column) -> Column:
        first = F.floor((F.year(day) - 1930) / 100) * 100 + 1930
        start = F.make_date(first.cast("int"), F.lit(1), F.lit(1))
        days = F.datediff(F.make_date((first + 100).cast("int"), F.lit(1), F.lit(1)), start)
        # a century has 36525 = 75 * 487 days, or 36524 = 92 * 397
        long = days == 36_525
        a = F.when(long, F.lit(75)).otherwise(F.lit(92)).cast("long")
        b = F.when(long, F.lit(487)).otherwise(F.lit(397)).cast("long")
        at = F.datediff(day, start)
        p = feistel(F.floor(at / b), at % b, a, b, key, "date")
        return like_m(F.date_add(start, _let(p, lambda x: x["l"] * b + x["r"]).cast("int")))

    return F.when(iso.try_cast("date").isNotNull(), _let(iso.try_cast("date"), swap))


def _email(m: Column, key: str) -> Column:
    """The local part, letters and digits in their places. Punctuation stays.
    A local part with other letters, digits or marks becomes a keyed token of 32
    hexadecimal digits, the same for either letter case."""
    local = F.substring_index(m, "@", 1)
    places = F.transform(_chars(local), lambda c: F.struct(
        c.alias("c"),
        F.when(c.rlike("^[0-9]$"), F.lit(10)).when(c.rlike("^[A-Za-z]$"), F.lit(26))
        .otherwise(F.lit(1)).alias("size"),
        F.when(c.rlike("^[0-9]$"), F.ascii(c) - 48).when(c.rlike("^[a-z]$"), F.ascii(c) - 97)
        .when(c.rlike("^[A-Z]$"), F.ascii(c) - 65).otherwise(F.lit(0)).alias("v")))

    def swap(p: Column) -> Column:
        half = F.floor(F.size(p) / 2).cast("int")

        def step(v: Column, i: Column) -> Column:
            left = F.slice(v, F.lit(1), half)
            right = F.slice(v, half + 1, F.size(v) - half)
            other = F.array_join(F.when(i % 2 == 0, right).otherwise(left).cast("array<string>"), ".")
            turn = F.concat_ws(":", F.lower(F.substring_index(m, "@", -1)), other)

            def moved(x: Column, j: Column) -> Column:
                mine = (j < half) == (i % 2 == 0)
                size = F.get(p, j)["size"].cast("long")
                more = F.pmod(_prf(key, "email", i * 100_000 + j, turn), size)
                return F.when(mine & (size > 1), F.pmod(x + more, size)).otherwise(x)

            return F.transform(v, moved)

        start = F.transform(p, lambda x: x["v"].cast("long"))
        new = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)

        def char(x: Column, i: Column) -> Column:
            c = F.get(p, i)
            code = x.cast("int") + (F.when(c["size"] == 10, F.lit(48))
                                    .when(c["c"].rlike("^[a-z]$"), F.lit(97)).otherwise(F.lit(65)))
            return F.when(c["size"] == 1, c["c"]).otherwise(F.char(code))

        return F.array_join(F.transform(new, char), "")

    token = F.substring(F.sha2(F.concat_ws(":", F.lit(f"{key}:email"), F.lower(m)).cast("binary"), 256),
                        1, 32)
    return F.concat(F.when(local.rlike(r"[^\x00-\x7F]"), token).otherwise(_let(places, swap)),
                    F.lit("@"), F.substring_index(m, "@", -1))


_SWAPS = {"email": _email, "ipv4": _ipv4, "date": _date, "ssn": _ssn, "phone": _phone,
          "e164": _e164, "card": _card}


def _pseudonym(m: Column, key: str) -> Column:
    """(kind, new) of a match; NULL kind if it does not validate."""
    kind = F.lit(None).cast("string")
    for name, pattern in reversed(PATTERNS.items()):
        kind = F.when(m.rlike(f"^(?:{pattern})$"), F.lit(name)).otherwise(kind)

    def swapped(k: Column) -> Column:
        new = F.lit(None).cast("string")
        for name, swap in reversed(_SWAPS.items()):
            new = F.when(k == name, swap(m, key)).otherwise(new)
        return _let(new, lambda x: F.struct(F.when(x.isNotNull(), k).alias("kind"),
                                            F.coalesce(x, m).alias("new")))

    return _let(kind, swapped)


def _count_of(name: str) -> Column:
    return F.size(F.filter("kinds", lambda k: k == name)).cast("long")


def pseudonymise(docs: DataFrame, key: str, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, the text with pseudonyms, n_found, and per kind its count. Whoever has
    ``key`` can undo the permutations: keep it secret, and long."""
    if len(key.encode()) < MIN_KEY:
        raise ValueError(f"the key must have {MIN_KEY} bytes or more")
    found = F.regexp_extract_all("text", F.lit(ANY), F.lit(0))
    rows = (docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .withColumn("swaps", F.when(F.col("text").rlike("[0-9@]") & F.col("text").rlike(ANY),
                                        F.transform(found, lambda m: _pseudonym(m, key))))
            .withColumn("gaps", F.when(F.size("swaps") > 0, F.split("text", ANY, -1))))
    joined = F.array_join(F.transform(
        "gaps", lambda g, i: F.concat(g, F.coalesce(F.get("swaps", i)["new"], F.lit("")))), "")
    kinds = F.coalesce(F.filter(F.col("swaps")["kind"], lambda k: k.isNotNull()),
                       F.array().cast("array<string>"))
    rows = rows.withColumn("kinds", kinds)
    return rows.select(
        "doc_id", F.when(F.col("gaps").isNull(), F.col("text")).otherwise(joined).alias("text"),
        F.size("kinds").cast("long").alias("n_found"),
        *[_count_of(name).alias("n_" + name) for name in PATTERNS])
