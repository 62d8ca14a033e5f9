"""Cards and phones in forms that the given tables don't have."""

import datetime
import hashlib
import hmac
import ipaddress
import random
import re
import struct

import xxhash

from logweir.llm import pii


def test_grouped_cards_and_phones_in_a_run(spark):
    values = ["3782 822463 10005", "3056-930902-5904", "+15551234567", "+442079460958"]
    kept = ["3782 822463 10006", "+123", "1+2345678901234567"]
    frame = spark.createDataFrame([(n, f"see {v}, then") for n, v in enumerate(values + kept)], "doc_id long, text string")
    found = {r.doc_id: r for r in pii.pseudonymise(frame, "k").collect()}
    for n, value in enumerate(values):
        assert [m.kind for m in found[n].pii] == ["card" if n < 2 else "phone"]
        assert value not in found[n].text
        assert re.sub(r"\d", "9", found[n].text) == re.sub(r"\d", "9", f"see {value}, then")
    for n, value in enumerate(kept, len(values)):
        assert found[n].pii == [] and found[n].text == f"see {value}, then"


# ---- an independent Feistel network, number by number ----

KEYS = [hmac.new(b"k", f"round {n}".encode(), hashlib.sha256).hexdigest() for n in range(6)]


def digest(number, text):
    return hashlib.sha256(f"{KEYS[number]}:{text}:{KEYS[number]}".encode()).hexdigest()


def amount(text, at):
    """Spark's xxhash64 of a string and an int, signed."""
    h = xxhash.xxh64_intdigest(struct.pack("<i", at), xxhash.xxh64_intdigest(text.encode(), 42))
    return h - 2**64 if h >> 63 else h


def moved(char, by, alphabets=("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ")):
    for letters in alphabets:
        if char in letters:
            return letters[(letters.index(char) + by) % len(letters)]
    return char


def text_turns(value, start=0, **alphabets):
    left, right = value[: (len(value) + 1) // 2], value[(len(value) + 1) // 2 :]
    for n in range(6):
        if n % 2:
            right = "".join(moved(c, amount(digest(n, left), at + start), **alphabets) for at, c in enumerate(right))
        else:
            left = "".join(moved(c, amount(digest(n, right), at + start), **alphabets) for at, c in enumerate(left))
    return left + right


def number_turns(left, right, n_left, n_right):
    for n in range(6):
        if n % 2:
            right = (right + int(digest(n, str(left))[:12], 16)) % n_right
        else:
            left = (left + int(digest(n, str(right))[:12], 16)) % n_left
    return left, right


def put_back(value, digits):
    digits = iter(digits)
    return "".join(next(digits) if c.isdigit() else c for c in value)


def only_digits(value):
    return "".join(c for c in value if c.isdigit())


def expected(kind, value):
    if kind == "email":
        at = value.rindex(".")
        return text_turns(value[:at]) + value[at:]
    if kind == "card":
        body = text_turns(only_digits(value)[:-1])
        total = sum(sum(divmod(int(d) * (2 - i % 2), 10)) for i, d in enumerate(reversed(body)))
        return put_back(value, body + str(-total % 10))
    if kind == "ssn":
        area, group, serial = map(int, value.split("-"))
        left, right = number_turns(area - 1 - (area > 666), (group - 1) * 9999 + serial - 1, 898, 99 * 9999)
        return f"{left + 1 + (left >= 665):03d}-{right // 9999 + 1:02d}-{right % 9999 + 1:04d}"
    if kind == "ip":
        a, b, c, d = map(int, value.split("."))
        left, right = number_turns(a * 256 + b, c * 256 + d, 65536, 65536)
        return f"{left // 256}.{left % 256}.{right // 256}.{right % 256}"
    if kind == "ipv6":
        bits = ipaddress.IPv6Address(value).exploded.replace(":", "")
        new = text_turns(bits, start=1, alphabets=("0123456789abcdef",))
        return ":".join(f"{int(new[i : i + 4], 16):x}" for i in range(0, 32, 4))
    if kind == "phone":
        if re.fullmatch(r"\+\d+", value):
            return value[:2] + text_turns(value[2:])
        grouped = re.search(r"(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}$", value)
        at = grouped.start() if grouped else re.match(r"\+\d+", value).end()
        return value[:at] + put_back(value[at:], text_turns(only_digits(value[at:])))


VALUES = {
    "email": ["a@b.com", "Jo.Q-1%x+tag@mail8.example.co.uk", "x@" + "a1.b2." * 30 + "org"],
    "card": ["4041894974608795", "4041 8949 7460 8795", "3782 822463 10005", "3056-930902-5904"],
    "ssn": ["123-45-6789", "001-01-0001", "665-99-9999", "667-99-9999", "899-01-0002"],
    "ip": ["70.123.182.155", "0.0.0.0", "255.255.255.255"],
    "ipv6": ["2001:db8::1", "2001:0DB8:0:0:0:0:0:1", "fe80:1:2:3:4:5:6:ffff"],
    "phone": ["+1 (988) 555-2485", "555-123-4567", "+15551234567", "+44 20 7946 0958", "+33 1 23 45 67 89", "+49 (30) 1234 5678"],
}


def test_every_kind_against_an_independent_network(spark):
    rows = [(kind, value) for kind, values in VALUES.items() for value in values]
    frame = spark.createDataFrame([(n, f"see {v}, then") for n, (_, v) in enumerate(rows)], "doc_id long, text string")
    found = {r.doc_id: r for r in pii.pseudonymise(frame, "k").collect()}
    for n, (kind, value) in enumerate(rows):
        assert [(m.kind, m["value"]) for m in found[n].pii] == [(kind, expected(kind, value))], value
        assert found[n].text == f"see {expected(kind, value)}, then"


FORMS = ["%Y-%m-%d", "%m/%d/%Y", "{m}/{d}/%Y", "%d/%m/%Y", "{d}/{m}/%Y", "%d.%m.%Y", "{d}.{m}.%Y", "%B {d}, %Y", "%b {d}, %Y", "{d} %B %Y", "{d} %b %Y"]


def written(day, form):
    date = datetime.date(1800, 1, 1) + datetime.timedelta(days=day)
    return date.strftime(form.format(d=date.day, m=date.month))


def first_way(text):
    """Number of the first form that a date can be read in, and its day."""
    for number, form in enumerate(FORMS):
        try:
            date = datetime.datetime.strptime(text, form.format(d="%d", m="%m")).date()
        except ValueError:
            continue
        day = (date - datetime.date(1800, 1, 1)).days
        if written(day, form) == text:
            return number, day
    return None


def test_dates_in_every_form_against_an_independent_walk(spark):
    rnd = random.Random(3)
    texts = {written(rnd.randrange(146097), form) for form in FORMS for _ in range(40)}
    texts |= {"12/31/1999", "31/12/1999", "31.12.1999", "1.2.2003", "January 5, 2020", "May 1, 1999", "5 Jan 2020", "29 February 2000", "03/04/2020"}
    bad = ["13/13/2000", "31.4.2000", "February 30, 2001", "0 May 2000", "1/2/1700", "32 January 2000"]
    frame = spark.createDataFrame([(t, f"on {t};") for t in [*texts, *bad]], "v string, text string")
    found = {r.v: r for r in pii.pseudonymise(frame, "k").collect()}
    for text in texts:
        form, day = first_way(text)
        for _ in range(64):
            left, right = number_turns(day // 773, day % 773, 189, 773)
            day = left * 773 + right
            if first_way(written(day, FORMS[form])) == (form, day):
                break
        assert found[text].text == f"on {written(day, FORMS[form])};", text
    assert all(found[t].text == f"on {t};" and found[t].pii == [] for t in bad)


def test_the_key_is_not_in_the_plan_and_columns_stay(spark):
    frame = spark.createDataFrame([(1, "a@b.com", "x", "y")], "doc_id long, text string, _pii string, _pii_ string")
    done = pii.pseudonymise(frame, "a very secret key")
    assert "a very secret key" not in done._jdf.queryExecution().toString()
    row = done.first()
    assert done.columns == ["doc_id", "text", "_pii", "_pii_", "pii"] and (row._pii, row._pii_) == ("x", "y")


def test_very_long_texts(spark):
    text = ("word " * 20 + "Jo@mail.example.com, 4041 8949 7460 8795 on 31.12.1999. ") * 8000
    assert len(text) > 1_200_000
    row = pii.pseudonymise(spark.createDataFrame([(text,)], "text string"), "k").first()
    assert len(row.pii) == 24_000 and len({m["value"] for m in row.pii}) == 3
    assert "Jo@mail" not in row.text and "8795" not in row.text and len(row.text) == len(text)
