"""Personal data replaced by format-preserving pseudonyms, in built-in functions only.

A value is validated, cut into two halves, and the halves take turns: each character of one is
moved within its kind (digit, small or capital letter) by an amount that a keyed hash of the other
half gives. That is a Feistel network, so it permutes the values of a format: equal values get
equal pseudonyms everywhere, different ones stay different, and nobody without the key can tell
which. Card numbers keep a right check digit, addresses stay addresses, and dates are permuted
among the days of a 400-year cycle of the calendar, each within its way of writing.

The rounds' keys are worked out from the key on the driver, one way, so plans and event logs hold
them and never the key itself. Who can read those can undo the pseudonyms made with them, so plans
are to be kept as safe as the texts.
"""

import hashlib
import hmac

from pyspark.sql import functions as F

ROUNDS = 6
#: Days of the Gregorian cycle and its factors, over which dates are permuted, from DATE_START.
DATE_START, CYCLE_DAYS, DATE_LEFT, DATE_RIGHT = "1800-01-01", 146097, 189, 773

# How the kinds are written, tried in this order at each place.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@(?:[A-Za-z0-9-]{1,63}\.){1,126}[A-Za-z]{2,24}(?![A-Za-z0-9-])"
_MONTH = "(?:January|February|March|April|May|June|July|August|September|October|November|December|Jan|Feb|Mar|Apr|Jun|Jul|Aug|Sep|Oct|Nov|Dec)"
_MONTH_DAY = "(?:[12][0-9]|3[01]|[1-9])"
DATE = (
    r"(?<![0-9./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})(?![0-9/-]|\.[0-9])"
    rf"|(?<![A-Za-z]){_MONTH} {_MONTH_DAY}, [0-9]{{4}}(?![0-9])|(?<![0-9.]){_MONTH_DAY} {_MONTH} [0-9]{{4}}(?![0-9])"
)
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
IPV4 = r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9]|\.[0-9])"
_GROUPED = r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])"
E164 = r"(?<![0-9+])\+[1-9][0-9]{7,14}(?![0-9])"
INTERNATIONAL = r"(?<![0-9+])\+[1-9][0-9]{0,2}(?:[ .-]?\([0-9]{1,4}\))?(?:[ .-][0-9]{1,4}){2,6}(?![0-9])"
PHONE = f"{_GROUPED}|{E164}|{INTERNATIONAL}"
IPV6 = (
    r"(?<![0-9A-Za-z:.])(?:(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}"
    r"|(?:[0-9A-Fa-f]{1,4}:){2,6}(?::[0-9A-Fa-f]{1,4}){1,5})(?![0-9A-Za-z:])"
)
CARD = r"(?<![0-9])(?:(?:[0-9]{4}[ -]?){3}[0-9]{1,7}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{4,5})(?![0-9])"
KINDS = {"email": EMAIL, "date": DATE, "ssn": SSN, "ip": IPV4, "phone": PHONE, "card": CARD, "ipv6": IPV6}
ANY = "|".join(f"(?:{pattern})" for pattern in KINDS.values())


def _let(value, body):
    """`body` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def round_keys(key):
    """A key for each round that does not tell the key it is made from."""
    return [
        hmac.new(key.encode(), f"round {number}".encode(), hashlib.sha256).hexdigest()
        for number in range(ROUNDS)
    ]


def _keyed(keys, number, text):
    """A hash of a half that takes the round's key to know."""
    return F.sha2(F.concat_ws(":", F.lit(keys[number]), text, F.lit(keys[number])), 256)


def _moved(char, amount):
    def within(first, size):
        place = F.ascii(char) - F.lit(ord(first))
        return F.char(F.pmod(place + F.pmod(amount, F.lit(size)), F.lit(size)) + F.lit(ord(first)))

    return (
        F.when(char.between("0", "9"), within("0", 10))
        .when(char.between("a", "z"), within("a", 26))
        .when(char.between("A", "Z"), within("A", 26))
        .otherwise(char)
    )


def _mixed(half, other, keys, number):
    """`half` with every character moved as the other half says."""
    chars = F.filter(F.split(half, ""), lambda c: c != "")
    return _let(
        _keyed(keys, number, other),
        lambda digest: F.array_join(
            F.transform(chars, lambda c, at: _moved(c, F.xxhash64(digest, at))), ""
        ),
    )


def _text_turn(keys, number):
    def turn(h):
        if number % 2:
            return F.struct(h["l"].alias("l"), _mixed(h["r"], h["l"], keys, number).alias("r"))
        return F.struct(_mixed(h["l"], h["r"], keys, number).alias("l"), h["r"].alias("r"))

    return turn


def permuted_text(value, keys):
    """The value with its letters and digits permuted within their kinds; the rest stays."""
    middle = F.ceil(F.length(value) / 2).cast("int")
    halves = F.struct(
        F.substring(value, F.lit(1), middle).alias("l"),
        F.substring(value, middle + 1, F.length(value)).alias("r"),
    )
    for number in range(ROUNDS):
        halves = _let(halves, _text_turn(keys, number))
    return _let(halves, lambda h: F.concat(h["l"], h["r"]))


def _number_turn(n_left, n_right, keys, number):
    def plus_keyed(value, other, size):
        digest = F.substring(_keyed(keys, number, other.cast("string")), 1, 12)
        return F.pmod(value + F.conv(digest, 16, 10).cast("long"), F.lit(size))

    def turn(p):
        if number % 2:
            return F.struct(p["l"].alias("l"), plus_keyed(p["r"], p["l"], n_right).alias("r"))
        return F.struct(plus_keyed(p["l"], p["r"], n_left).alias("l"), p["r"].alias("r"))

    return turn


def _turns(left, right, n_left, n_right, keys):
    """Two numbers below n_left and n_right permuted together."""
    pair = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    for number in range(ROUNDS):
        pair = _let(pair, _number_turn(n_left, n_right, keys, number))
    return pair


def _digits(value):
    return F.regexp_replace(value, "[^0-9]", "")


def _doubled_sum(digits, odd_from_right):
    """Luhn's sum of digits; the digits at odd places from the right count double."""
    places = F.filter(F.split(F.reverse(digits), ""), lambda c: c != "")
    values = F.transform(
        places,
        lambda c, at: F.when(
            at % 2 == odd_from_right,
            c.cast("int") * 2 - F.when(c.cast("int") > 4, F.lit(9)).otherwise(F.lit(0)),
        ).otherwise(c.cast("int")),
    )
    return F.aggregate(values, F.lit(0), lambda a, b: a + b)


def is_card(value):
    """13 to 19 digits with a right check digit."""
    return _let(_digits(value), lambda d: F.length(d).between(13, 19) & (_doubled_sum(d, 1) % 10 == 0))


def _put_back(value, digits):
    """`digits` in the places that the value's digits have."""
    spots = F.filter(F.split(value, ""), lambda c: c != "")
    return _let(
        spots,
        lambda chars: F.array_join(
            F.transform(
                chars,
                lambda c, at: F.when(
                    c.between("0", "9"),
                    F.substring(
                        digits,
                        F.size(F.filter(F.slice(chars, F.lit(1), at + 1), lambda x: x.between("0", "9"))),
                        F.lit(1),
                    ),
                ).otherwise(c),
            ),
            "",
        ),
    )


def _card(value, keys):
    """All digits but the last permuted, and the check digit that belongs to them."""

    def renumbered(digits):
        body = permuted_text(F.substring(digits, F.lit(1), F.length(digits) - 1), keys)
        return _let(
            body,
            lambda b: F.concat(b, F.pmod(10 - _doubled_sum(b, 0) % 10, F.lit(10)).cast("string")),
        )

    return _put_back(value, _let(_digits(value), renumbered))


def is_address(value):
    return ~F.exists(F.split(value, r"\."), lambda part: part.cast("int") > 255)


def _address(value, keys):
    def number(at):
        return F.split_part(value, F.lit("."), F.lit(at)).cast("long")

    pair = _turns(number(1) * 256 + number(2), number(3) * 256 + number(4), 65536, 65536, keys)

    def written_out(p):
        parts = [F.floor(p["l"] / 256), p["l"] % 256, F.floor(p["r"] / 256), p["r"] % 256]
        return F.concat_ws(".", *[part.cast("string") for part in parts])

    return _let(pair, written_out)


def _dom(day):
    return F.dayofmonth(_date_of(day))


def _month(day):
    return F.month(_date_of(day))


def _date_of(day):
    return F.date_add(F.lit(DATE_START).cast("date"), day.cast("int"))


def _short(day):
    """Whether day or month has one digit."""
    return (_dom(day) < 10) | (_month(day) < 10)


#: Ways to write a date: pattern, format, and which days are written so and no other way above.
#: Numbers with slashes are months first where they can be. May has no short name.
DATE_FORMS = (
    ("^[0-9]{4}-", "yyyy-MM-dd", None),
    ("^[0-9]{2}/[0-9]{2}/", "MM/dd/yyyy", None),
    ("^[0-9]{1,2}/[0-9]{1,2}/", "M/d/yyyy", _short),
    ("^[0-9]{2}/[0-9]{2}/", "dd/MM/yyyy", lambda day: _dom(day) > 12),
    ("^[0-9]{2}/[0-9]/", "d/M/yyyy", lambda day: (_dom(day) > 12) & (_month(day) < 10)),
    (r"^[0-9]{2}\.[0-9]{2}\.", "dd.MM.yyyy", None),
    (r"^[0-9]{1,2}\.[0-9]{1,2}\.", "d.M.yyyy", _short),
    ("^[A-Z][a-z]+ ", "MMMM d, yyyy", None),
    ("^[A-Z][a-z]{2} ", "MMM d, yyyy", lambda day: _month(day) != 5),
    ("^[0-9]+ ", "d MMMM yyyy", None),
    ("^[0-9]+ [A-Z][a-z]{2} ", "d MMM yyyy", lambda day: _month(day) != 5),
)
#: Turns after which a day that is not written in its form counts as found; the chance of that is
#: below 10^-25.
WALK = 64


def _fits(number, day):
    """Whether a day of the cycle is written in this form."""
    rule = DATE_FORMS[number][2]
    return rule(day) if rule else F.lit(True)


def _day(value):
    """(number of the form, day of the cycle) of a date; null if it is none."""

    def read(number):
        pattern, form, _ = DATE_FORMS[number]
        date = F.when(value.rlike(pattern), F.try_to_date(value, form))

        def usable(day):
            known = day.between(0, CYCLE_DAYS - 1) & _fits(number, day)
            return F.when(known, F.struct(F.lit(number).alias("form"), day.alias("day")))

        return _let(F.datediff(date, F.lit(DATE_START).cast("date")), usable)

    return F.coalesce(*[read(number) for number in range(len(DATE_FORMS))])


def is_day(value):
    return _day(value).isNotNull()


def _by_form(form, of):
    """One of the values that `of` gives for each form."""
    chosen = F.when(form == 0, of(0))
    for number in range(1, len(DATE_FORMS)):
        chosen = chosen.when(form == number, of(number))
    return chosen


def _date(value, keys):
    """The day permuted, and again while it is no day that is written in this form: that way the days
    of each form are permuted among themselves."""

    def turned(day):
        pair = _turns(F.floor(day / DATE_RIGHT), day % DATE_RIGHT, DATE_LEFT, DATE_RIGHT, keys)
        return _let(pair, lambda p: p["l"] * DATE_RIGHT + p["r"])

    def walked(found):
        start = F.struct(found["day"].cast("long").alias("day"), F.lit(False).alias("done"))

        def fits(day):
            return _by_form(found["form"], lambda number: _fits(number, day))

        def step(state, _):
            once = _let(turned(state["day"]), lambda day: F.struct(day.alias("day"), fits(day).alias("done")))
            return F.when(state["done"], state).otherwise(once)

        return F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), start, step, lambda state: state["day"])

    return _let(
        _day(value),
        lambda found: _let(
            walked(found),
            lambda day: _by_form(found["form"], lambda n: F.date_format(_date_of(day), DATE_FORMS[n][1])),
        ),
    )


HEX = "0123456789abcdef"


def _groups(value):
    """The eight groups of an IPv6 address, four hex digits each, in small letters; null if there
    are not eight."""
    sides = F.split(F.lower(value), "::")
    left = F.split(F.get(sides, F.lit(0)), ":")
    right = F.when(F.size(sides) > 1, F.split(F.get(sides, F.lit(1)), ":")).otherwise(F.array().cast("array<string>"))
    missing = 8 - F.size(left) - F.size(right)
    zeros = F.when((F.size(sides) > 1) & (missing > 0), F.array_repeat(F.lit("0"), missing)).otherwise(
        F.array().cast("array<string>")
    )
    every = F.transform(F.concat(left, zeros, right), lambda group: F.lpad(group, 4, "0"))
    return F.when(F.size(every) == 8, every)


def is_address6(value):
    return _groups(value).isNotNull()


def _address6(value, keys):
    """The 128 bits permuted, written in eight groups whatever the way they came."""

    def half_turn(number):
        def turn(h):
            def mixed(half, other):
                return _let(
                    _keyed(keys, number, other),
                    lambda digest: F.array_join(
                        F.transform(
                            F.sequence(F.lit(1), F.lit(16)),
                            lambda at: F.substring(
                                F.lit(HEX),
                                F.pmod(
                                    F.instr(F.lit(HEX), F.substring(half, at, F.lit(1)))
                                    - 1
                                    + F.pmod(F.xxhash64(digest, at), F.lit(16)),
                                    F.lit(16),
                                ).cast("int")
                                + 1,
                                F.lit(1),
                            ),
                        ),
                        "",
                    ),
                )

            if number % 2:
                return F.struct(h["l"].alias("l"), mixed(h["r"], h["l"]).alias("r"))
            return F.struct(mixed(h["l"], h["r"]).alias("l"), h["r"].alias("r"))

        return turn

    halves = _let(
        F.array_join(_groups(value), ""),
        lambda digits: F.struct(F.substring(digits, 1, 16).alias("l"), F.substring(digits, 17, 16).alias("r")),
    )
    for number in range(ROUNDS):
        halves = _let(halves, half_turn(number))
    groups = _let(
        halves,
        lambda h: F.transform(
            F.sequence(F.lit(0), F.lit(7)),
            lambda at: F.regexp_replace(F.substring(F.concat(h["l"], h["r"]), 4 * at + 1, F.lit(4)), "^0{1,3}", ""),
        ),
    )
    return F.array_join(groups, ":")


def is_ssn(value):
    """Areas 000, 666 and 900 on, group 00 and serial 0000 are never given out."""
    return ~value.rlike("^(000|666|9)|-00-|-0000$")


def _ssn(value, keys):
    """Area, group and serial permuted among the valid ones."""
    area = F.substring(value, 1, 3).cast("long")
    place = area - 1 - F.when(area > 666, F.lit(1)).otherwise(F.lit(0))
    tail = (F.substring(value, 5, 2).cast("long") - 1) * 9999 + F.substring(value, 8, 4).cast("long") - 1

    def written_out(p):
        new = p["l"] + 1 + F.when(p["l"] >= 665, F.lit(1)).otherwise(F.lit(0))
        group, serial = F.floor(p["r"] / 9999) + 1, p["r"] % 9999 + 1
        return F.format_string("%03d-%02d-%04d", new, group, serial)

    return _let(_turns(place, tail, 898, 99 * 9999, keys), written_out)


def _email(value, keys):
    """Name and host permuted, the top-level domain and all punctuation kept."""
    host = F.regexp_extract(value, r"^(.*)(\.[A-Za-z]{2,24})$", 1)
    return F.concat(permuted_text(host, keys), F.regexp_extract(value, r"(\.[A-Za-z]{2,24})$", 1))


def _phone(value, keys):
    """The country prefix kept, the ten digits of the number permuted; of a number in other groups,
    all digits but the first group; of a number in one run of digits, all but the first."""
    number = r"((?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4})$"
    grouped = F.concat(
        F.regexp_replace(value, number, ""),
        _let(
            F.regexp_extract(value, number, 1),
            lambda n: _put_back(n, permuted_text(_digits(n), keys)),
        ),
    )
    run = F.concat(F.substring(value, 1, 2), permuted_text(F.substring(value, 3, 14), keys))
    country = F.regexp_extract(value, "^([+][0-9]+)", 1)
    others = F.concat(
        country,
        _let(
            F.substring(value, F.length(country) + 1, F.length(value)),
            lambda n: _put_back(n, permuted_text(_digits(n), keys)),
        ),
    )
    return (
        F.when(value.rlike("^[+][0-9]+$"), run)
        .when(value.rlike(f"^(?:{_GROUPED})$"), grouped)
        .otherwise(others)
    )


def is_phone(value):
    """With a country prefix, 8 to 15 digits in all."""
    return value.rlike(f"^(?:{_GROUPED})$") | F.length(_digits(value)).between(8, 15)


def kind_of(value):
    """Which validated kind a match is; null if none."""
    whole = {name: F.lit(f"^(?:{pattern})$") for name, pattern in KINDS.items()}
    return (
        F.when(F.contains(value, F.lit("@")), F.lit("email"))
        .when(F.regexp_like(value, whole["date"]), F.when(is_day(value), F.lit("date")))
        .when(F.regexp_like(value, whole["ssn"]), F.when(is_ssn(value), F.lit("ssn")))
        .when(F.regexp_like(value, whole["ip"]), F.when(is_address(value), F.lit("ip")))
        .when(F.regexp_like(value, whole["ipv6"]), F.when(is_address6(value), F.lit("ipv6")))
        .when(F.regexp_like(value, whole["phone"]), F.when(is_phone(value), F.lit("phone")))
        .when(is_card(value), F.lit("card"))
    )


def pseudonym(value, kind, keys):
    return (
        F.when(kind == "email", _email(value, keys))
        .when(kind == "date", _date(value, keys))
        .when(kind == "ssn", _ssn(value, keys))
        .when(kind == "ip", _address(value, keys))
        .when(kind == "phone", _phone(value, keys))
        .when(kind == "card", _card(value, keys))
        .when(kind == "ipv6", _address6(value, keys))
        .otherwise(value)
    )


def pseudonymise(docs, key, text_col="text"):
    """The documents with personal data replaced in `text_col`, and `pii`: an array of (kind,
    pseudonym) in order of place, in place of a column of that name.

    Null text stays null with an empty array; a text without personal data stays as it is; a match
    that is not valid (a wrong check digit, no such day) stays. Repeated values and rows get the
    same pseudonyms. Texts are split at their matches, so nothing is cut off whatever their length.
    An empty table gives no rows.
    """
    keys, text = round_keys(key), F.col(f"`{text_col}`")
    matches = F.regexp_extract_all(text, F.lit(ANY), F.lit(0))
    found = F.transform(
        matches,
        lambda m: _let(
            kind_of(m),
            lambda kind: F.struct(kind.alias("kind"), pseudonym(m, kind, keys).alias("value")),
        ),
    )
    has_any = F.coalesce(F.regexp_like(text, F.lit("[0-9@]")), F.lit(False))
    none = F.array().cast("array<struct<kind:string,value:string>>")
    helper = "_pii"
    while helper in docs.columns:
        helper += "_"
    marked = docs.withColumn(helper, F.when(has_any, found).otherwise(none))
    gaps = F.split(text, ANY, -1)
    pieces = F.transform(
        gaps,
        lambda gap, at: F.concat(gap, F.coalesce(F.get(F.col(helper), at)["value"], F.lit(""))),
    )
    replaced = F.when(F.size(helper) > 0, F.array_join(pieces, "")).otherwise(text)
    marked = marked.withColumn(text_col, replaced)
    valid = F.filter(helper, lambda m: m["kind"].isNotNull())
    return marked.withColumn("pii", valid).drop(helper)
