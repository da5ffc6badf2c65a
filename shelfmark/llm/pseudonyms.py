"""Personal data: keyed pseudonyms of the same format, DataFrame functions only.

Mail addresses, telephone numbers, payment cards, bank accounts, IP addresses,
social security numbers and dates are found by pattern and validated. At each
place where a form may begin, its candidates are tried, the longer first within
a form; what fails its check stays in the search, so a value inside it or beside
it is still found. A Feistel
network keyed by the caller permutes each within its format, so equal values
get equal pseudonyms in all documents and different values different ones:

- characters: each digit or ASCII letter moves within its own kind, by a keyed
  digest of the other half. Cards, accounts and telephone numbers are permuted
  without the signs that group them, which are put back at their places, so one
  number gets one pseudonym however it is written. Cards get a new check digit
  (Luhn) and accounts new check digits (mod 97).
- numbers: two halves, each of a range of its own: IP addresses (2^16 each),
  social security numbers (areas with groups, and serials, that may be issued),
  and days within a span of 271 * 271 days, which maps dates to dates without a
  search. All years from 1 to 9999 are covered: what no whole span holds at the
  two ends is one set of 50 * 1069 days.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Characters of an account by country (ISO 13616).
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ DZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_KNOWN = [c for some in IBAN_LENGTHS.values() for c in some.split()]
_START, _END = r"(?<![A-Za-z0-9])", r"(?![A-Za-z0-9])"


def _international(groups: str) -> str:
    return rf"(?<![A-Za-z0-9+])\+[0-9]{{1,3}}[ .-]?\(?[0-9]{{1,4}}\)?(?:[ .-]?[0-9]{{2,4}}){groups}{_END}"


#: Validated forms (kind, pattern), in order of precedence. A later one of a kind is tried where an earlier one fails.
FORMS = [
    ("email", r"(?<![\p{L}\p{N}._+-])[\p{L}\p{N}._+-]++@(?:[A-Za-z0-9-]++\.)++[A-Za-z]{2,}"),
    # a country's own length; any length where the country has none
    ("iban", _START + "(?:" + "|".join(
        f"(?:{c.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}" for n, c in IBAN_LENGTHS.items()
    ) + f"|(?!{'|'.join(_KNOWN)})[A-Z]{{2}}[0-9]{{2}}(?: ?[A-Z0-9]){{11,30}})" + _END),
    ("phone", _international("{2,4}")
     + rf"|{_START}\([0-9]{{3}}\) ?[0-9]{{3}}-[0-9]{{4}}{_END}"
     + rf"|(?<![A-Za-z0-9.-])[0-9]{{3}}[.-][0-9]{{3}}[.-][0-9]{{4}}{_END}"),
    ("phone", _international("{2,3}")),
    ("phone", _international("{2}")),
    # a time may follow an ISO date
    ("date", r"(?<![A-Za-z0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}(?=T[0-9]|(?![A-Za-z0-9/-]))|(?:[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}"
     r"|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![A-Za-z0-9/-]))"),
    ("ssn", r"(?<![A-Za-z0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![A-Za-z0-9-])"),
    ("ip", r"(?<![A-Za-z0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![A-Za-z0-9]|\.[0-9])"),
    *(("card", _START + digits + _END) for digits in (
        "[0-9]{13,19}", "[0-9]{4}(?:[ -][0-9]{4}){3}[ -][0-9]{1,3}", "[0-9]{4}(?:[ -][0-9]{4}){3}",
        "[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}", "[0-9]{4}[ -][0-9]{6}[ -][0-9]{4}",
    )),
]
#: Digits grouped otherwise; tried once along a run of digits, since one in ten numbers passes a check digit by chance.
LOOSE = _START + "[0-9](?:[ -]?[0-9]){12,18}" + _END
ANY = "|".join(f"(?:{p})" for p in [*(p for _, p in FORMS), LOOSE])
#: A form but mail is read from so many characters, its end and what must not follow it included.
REACH = 100
#: A text without any of these characters holds none of the forms.
HINT = "[0-9@]"

DAYS = 271
SPAN = DAYS * DAYS
#: First day of a span; whole spans lie on both sides of it.
FIRST_DAY = "1900-01-01"
#: Days of the years 1 to 9999 before that day and from it on, whole spans on each side, and the days left over at both ends.
DAYS_BEFORE, DAYS_AFTER = 693_595, 2_958_464
SPANS_BEFORE, SPANS_AFTER = DAYS_BEFORE // SPAN, DAYS_AFTER // SPAN
LEFT_OVER = (50, 1_069)
#: Areas with groups, and serials, of a social security number: no area 000, 666 or 9xx, no group 00, no serial 0000.
SSN_SIZES = (898 * 99, 9_999)
#: Country codes of telephone numbers by their first digits (E.164); all others have three.
CODES = "^(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[0-9]{3})"


def _number(key: str, kind: str, i: Column, half: Column) -> Column:
    """60 bits of a keyed digest."""
    digest = F.sha2(F.concat(F.lit(f"{key}|{kind}|"), i.cast("string"), F.lit("|"), half.cast("string")), 256)
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")


def permute_number(left: Column, right: Column, sizes: tuple[int, int], key: str, kind: str) -> Column:
    """A permutation of pairs (left, right) from 0 to each one's size - 1, as a struct of both.

    The halves change places in every round, and the rounds are even in number.
    """
    start = F.struct(left.cast("long").alias("left"), right.cast("long").alias("right"))
    return F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)),
        start,
        lambda acc, i: F.struct(
            acc["right"].alias("left"),
            F.pmod(acc["left"] + _number(key, kind, i, acc["right"]), F.when(i % 2 == 1, sizes[0]).otherwise(sizes[1])).alias("right"),
        ),
    )


def permute_chars(text: Column, key: str, kind: str) -> Column:
    """A permutation of the strings of one format: digits, small and capital ASCII letters change within their kind."""

    def moved(char: Column, by: Column) -> Column:
        code = F.ascii(char)

        def within(first: int, size: int) -> Column:
            return F.char(F.lit(first) + (code - first + by) % size)

        one = F.length(char) == 1
        return (
            F.when(one & code.between(48, 57), within(48, 10))
            .when(one & code.between(97, 122), within(97, 26))
            .when(one & code.between(65, 90), within(65, 26))
            .otherwise(char)
        )

    def turn(half: Column, other: Column, i: Column) -> Column:
        digest = F.sha2(F.concat(F.lit(f"{key}|{kind}|"), i.cast("string"), F.lit("|"), other), 256)
        return F.array_join(
            F.transform(
                F.filter(F.split(half, ""), lambda c: c != ""),
                lambda c, at: moved(c, F.conv(F.substring(digest, 2 * (at % 32) + 1, 2), 16, 10).cast("int")),
            ),
            "",
        )

    half = F.floor(F.char_length(text) / 2).cast("int")
    start = F.struct(F.substring(text, F.lit(1), half).alias("left"), F.substring(text, half + 1, F.char_length(text)).alias("right"))
    done = F.aggregate(
        F.sequence(F.lit(1), F.lit(ROUNDS)),
        start,
        lambda acc, i: F.struct(acc["right"].alias("left"), turn(acc["left"], acc["right"], i).alias("right")),
    )
    return F.concat(done["left"], done["right"])


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _let(value: Column, use) -> Column:
    """`use(value)` with the value worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def grouped_as(form: Column, plain: Column) -> Column:
    """`form` with its ASCII letters and digits replaced, one after another, by the characters of `plain`."""

    def step(acc: Column, c: Column, new: Column) -> Column:
        moves = F.rlike(c, F.lit("[A-Za-z0-9]"))
        put = F.when(moves, F.substring(new, acc["at"], F.lit(1))).otherwise(c)
        return F.struct(
            F.concat(acc["out"], put).alias("out"), (acc["at"] + F.when(moves, 1).otherwise(0)).alias("at")
        )

    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("at"))
    chars = F.filter(F.split(form, ""), lambda c: c != "")
    return _let(plain, lambda new: F.aggregate(chars, start, lambda acc, c: step(acc, c, new))["out"])


def luhn(digits: Column) -> Column:
    """Luhn sum of a number whose last digit counts once, modulo 10."""
    doubled = F.transform(
        F.filter(F.split(F.reverse(digits), ""), lambda c: c != ""),
        lambda c, i: F.when(i % 2 == 1, c.cast("int") * 2 - F.when(c.cast("int") > 4, 9).otherwise(0)).otherwise(c.cast("int")),
    )
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10


def card(match: Column, key: str) -> Column:
    """A card number of the same form with a right check digit; what fails the check is no card."""
    digits = _digits(match)
    body = permute_chars(F.substring(digits, F.lit(1), F.char_length(digits) - 1), key, "card")
    new = _let(body, lambda b: F.concat(b, ((10 - luhn(F.concat(b, F.lit("0")))) % 10).cast("string")))
    return F.when(luhn(digits) == 0, grouped_as(match, new))


def mod97(text: Column) -> Column:
    """Remainder of a bank account number as a number, letters as 10 to 35."""
    return F.aggregate(
        F.filter(F.split(text, ""), lambda c: c != ""),
        F.lit(0),
        lambda a, c: F.when(F.ascii(c) < 58, (a * 10 + F.ascii(c) - 48) % 97).otherwise((a * 100 + F.ascii(c) - 55) % 97),
    )


def iban(match: Column, key: str) -> Column:
    """An account of the same country and form with right check digits."""
    plain = F.replace(match, F.lit(" "), F.lit(""))
    country = F.substring(match, 1, 2)

    def checked(rest: Column) -> Column:
        check = 98 - mod97(F.concat(rest, country, F.lit("00")))
        return F.concat(country, F.lpad(check.cast("string"), 2, "0"), rest)

    body = F.substring(plain, F.lit(5), F.char_length(plain))
    good = mod97(F.concat(body, F.substring(plain, 1, 4))) == 1
    return F.when(good, grouped_as(match, _let(permute_chars(body, key, "iban"), checked)))


def ip(match: Column, key: str) -> Column:
    """Another address; each part must be below 256."""
    parts = F.transform(F.split(match, r"\."), lambda p: p.cast("int"))
    value = permute_number(parts[0] * 256 + parts[1], parts[2] * 256 + parts[3], (1 << 16, 1 << 16), key, "ip")
    out = F.concat_ws(
        ".", *(x.cast("string") for h in ("left", "right") for x in (F.floor(value[h] / 256), value[h] % 256))
    )
    return F.when(F.forall(parts, lambda p: p < 256), out)


def another_day(day: Column, key: str) -> Column:
    """Another day of the same span, for days outside the whole spans another such day."""
    first = F.lit(FIRST_DAY).cast("date")
    since = F.datediff(day, first)
    span = F.floor(since / SPAN)
    inside = F.pmod(since, F.lit(SPAN))
    near = permute_number(F.floor(inside / DAYS), inside % DAYS, (DAYS, DAYS), key, "date")
    near = _let(near, lambda p: span * SPAN + p["left"] * DAYS + p["right"])
    # the days at both ends as one row of numbers, those before the first span in front
    head = DAYS_BEFORE - SPANS_BEFORE * SPAN
    at = F.when(since < 0, since + DAYS_BEFORE).otherwise(since - SPANS_AFTER * SPAN + head)
    far = permute_number(F.floor(at / LEFT_OVER[1]), at % LEFT_OVER[1], LEFT_OVER, key, "far date")
    far = _let(far, lambda p: p["left"] * LEFT_OVER[1] + p["right"])
    far = _let(far, lambda n: F.when(n < head, n - DAYS_BEFORE).otherwise(n - head + SPANS_AFTER * SPAN))
    return F.date_add(first, F.when(span.between(-SPANS_BEFORE, SPANS_AFTER - 1), near).otherwise(far).cast("int"))


def date(match: Column, key: str) -> Column:
    """Another date in the same order and with the same signs; day before month where both readings are right."""

    def reading(form: str) -> Column:
        sign = form.strip("Mdy")[0]
        padded = F.concat_ws(sign, F.transform(F.split(match, f"[{sign}]"), lambda p: F.when(F.length(p) < 2, F.concat(F.lit("0"), p)).otherwise(p)))
        day = F.when(match.contains(sign), F.try_to_timestamp(padded, F.lit(form)).cast("date"))
        return _let(day, lambda d: F.when(F.year(d) > 0, F.struct(F.lit(form).alias("form"), d.alias("day"))))

    readings = map(reading, ("yyyy-MM-dd", "dd/MM/yyyy", "dd.MM.yyyy", "MM.dd.yyyy", "MM/dd/yyyy"))
    return _let(
        F.coalesce(*readings),
        lambda r: F.when(r.isNotNull(), F.call_function("date_format", another_day(r["day"], key), r["form"])),
    )


def phone(match: Column, key: str) -> Column:
    """Another number of the same form; a country code and its plus sign stay.

    The number without its country code is permuted, so it is linked with and
    without one.
    """
    digits = _digits(match)
    code = F.when(match.startswith("+"), F.regexp_extract(digits, CODES, 0)).otherwise("")
    new = _let(
        code, lambda c: F.concat(c, permute_chars(F.substring(digits, F.char_length(c) + 1, F.char_length(digits)), key, "phone"))
    )
    return F.when(F.length(digits).between(7, 15), grouped_as(match, new))


def email(match: Column, key: str) -> Column:
    """Another name at the same domain."""
    name = F.substring_index(match, "@", 1)
    return F.concat(permute_chars(name, key, "email"), F.substring(match, F.char_length(name) + 1, F.char_length(match)))


def ssn(match: Column, key: str) -> Column:
    """Another number that may be issued; what may not be issued is none."""
    area, group, serial = (F.substring(match, at, n).cast("int") for at, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    place = area - F.when(area > 666, 2).otherwise(1)
    value = permute_number(place * 99 + group - 1, serial - 1, SSN_SIZES, key, "ssn")

    def written(v: Column) -> Column:
        new = F.floor(v["left"] / 99) + 1
        return F.format_string("%03d-%02d-%04d", new + F.when(new >= 666, 1).otherwise(0), v["left"] % 99 + 1, v["right"] + 1)

    return F.when(valid, _let(value, written))


MAKERS = {"email": email, "iban": iban, "phone": phone, "date": date, "ssn": ssn, "ip": ip, "card": card}


def _try(window: Column, form: str, make, key: str) -> Column:
    """(size, new) of a form at the second character of `window`; `new` is null if it is not valid, all if it is not there."""
    found = F.regexp_extract(window, f"(?s)^.({form})", 1)
    return _let(found, lambda m: F.when(m != "", F.struct(F.char_length(m).alias("size"), make(m, key).alias("new"))))


def candidate(window: Column, key: str) -> Column:
    """What begins at the second character of `window`: (sure, loose), each as `_try` gives it.

    `sure` is the first form of all that is valid, else null.
    """
    sure = (_let(_try(window, form, MAKERS[kind], key), lambda t: F.when(t["new"].isNotNull(), t)) for kind, form in FORMS)
    return F.struct(F.coalesce(*sure).alias("sure"), _try(window, LOOSE, card, key).alias("loose"))


def _walk(pieces: Column, tried: Column) -> Column:
    """Struct with `out`, the new pieces, and `n`, the values replaced.

    The first piece stands before all candidates, each other begins with one.
    A candidate that begins inside a replaced value is passed over, and one of
    loose grouping inside an earlier such candidate too.
    """

    def step(acc: Column, p: Column) -> Column:
        loose = p["t"]["loose"]
        free = acc["skip"] == 0
        open_ = free & (acc["held"] == 0)
        chosen = F.when(free, F.coalesce(p["t"]["sure"], F.when(open_ & loose["new"].isNotNull(), loose)))

        def go(c: Column) -> Column:
            size = F.char_length(p["piece"])
            # characters from the start of this piece that are replaced, or that no loose candidate may begin in
            gone = F.when(c.isNotNull(), c["size"]).otherwise(acc["skip"])
            held = F.when(open_ & c.isNull() & loose.isNotNull(), loose["size"]).otherwise(acc["held"])
            rest = F.when(gone == 0, p["piece"]).otherwise(F.substring(p["piece"], gone + 1, size))
            return F.struct(
                F.greatest(gone - size, F.lit(0)).alias("skip"),
                F.greatest(held - size, F.lit(0)).alias("held"),
                (acc["n"] + F.when(c.isNotNull(), 1).otherwise(0)).alias("n"),
                F.array_append(acc["out"], F.concat(F.coalesce(c["new"], F.lit("")), rest)).alias("out"),
            )

        return _let(chosen, go)

    start = F.struct(
        F.lit(0).alias("skip"), F.lit(0).alias("held"), F.lit(0).alias("n"), F.array().cast("array<string>").alias("out")
    )
    return F.aggregate(F.arrays_zip(pieces.alias("piece"), tried.alias("t")), start, step)


def pseudonymise(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """`docs` with personal data in `text_col` replaced and their number in `n_pii`.

    Columns keep their places, an input column `n_pii` is replaced. Null and
    empty texts stay as they are with none found; repeated rows are treated
    alike. A text of any length is one value in its task, with an array of the
    places where a form may begin. `key` decides the permutation; who has it can
    undo it.
    """
    text = F.col(f"`{text_col}`")
    may = F.coalesce(F.rlike(text, F.lit(HINT)), F.lit(False))
    # the places where a form may begin: what stands there, and the text parted at them
    window = rf"(?=(?:{ANY}))(?=({FORMS[0][1]}|(?s:.{{1,{REACH}}})))"
    found = docs.withColumn("__found", F.when(may, F.regexp_extract_all(text, F.lit(window), F.lit(1))))
    hit = F.coalesce(F.size("__found") > 0, F.lit(False))
    parts = F.split(text, f"(?={ANY})", -1)
    # no empty piece comes before a form at the very start
    pieces = F.when(F.size(parts) > F.size("__found"), parts).otherwise(F.concat(F.array(F.lit("")), parts))
    found = found.withColumn("__pieces", F.when(hit, pieces))
    windows = F.transform(
        "__found", lambda w, i: F.concat(F.coalesce(F.nullif(F.right(F.get("__pieces", i), F.lit(1)), F.lit("")), F.lit("\n")), w)
    )
    tried = F.transform(windows, lambda w: candidate(w, key))
    nothing = F.array(F.lit(None).cast("struct<sure:struct<size:int,new:string>,loose:struct<size:int,new:string>>"))
    found = found.withColumn("__done", F.when(hit, _walk(F.col("__pieces"), F.concat(nothing, tried))))
    kept = [c for c in docs.columns if c.lower() != "n_pii"]
    return found.select(
        *(
            F.when(hit, F.array_join("__done.out", "")).otherwise(text).alias(c) if c.lower() == text_col.lower() else F.col(f"`{c}`")
            for c in kept
        ),
        F.when(hit, F.col("__done.n")).otherwise(0).cast("long").alias("n_pii"),
    )
