"""Text and prices out of captured pages."""

import re

from pyspark.sql import functions as F

PRICE_TYPE = "decimal(20,6)"


def _first_match(text, pattern):
    """First match of a pattern, NULL when there is none. Taking it out of the list of matches
    runs the pattern once; regexp_substr would run it again to tell "no match" apart."""
    return F.get(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), F.lit(0))


def _without_tags(html):
    return F.regexp_replace(html, r"<[^>]*>", "")


def _opening(element_id):
    """Pattern of the opening tag of the element with this id; its first group is its kind."""
    name = re.escape(element_id)
    return (
        r"(?is)<([a-z][a-z0-9]*)(?=\s)[^>]*?\sid\s*=\s*"
        rf"(?:\"{name}\"|'{name}'|{name}(?=[\s>]))[^>]*>"
    )


def _inner(element, kind):
    """What an element that nests its own kind holds, without the tags of that kind: up to the tag
    that brings the count of open ones back to none; NULL when there is none.

    The tags are an array, and one fold over it finds the number of that tag."""
    tag = F.concat(F.lit("(?i)</?"), kind, F.lit(r"(?=[\s/>])[^>]*>"))
    tags = F.regexp_extract_all(element, tag, F.lit(0))
    pieces = F.split(element, tag, F.lit(-1))
    start = F.struct(F.lit(0).alias("open"), F.lit(0).alias("at"), F.lit(0).alias("end"))

    def step(state, one):
        change = F.when(one.startswith("</"), -1).when(one.endswith("/>"), 0).otherwise(1)
        now, at = state["open"] + change, state["at"] + 1
        end = F.when((state["end"] == 0) & (now == 0), at).otherwise(state["end"])
        return F.struct(now.alias("open"), at.alias("at"), end.alias("end"))

    end = F.aggregate(tags, start, step, lambda state: state["end"])
    # ahead of the first tag there is nothing; the tag number `end` ends the piece of that number
    return F.when(end > 0, F.array_join(F.slice(pieces, F.lit(2), F.greatest(end - 1, F.lit(0))), ""))


def element_text(html, element_id):
    """Text of the first element with this id, without its tags; NULL when there is none.

    The element ends at the closing tag of its own kind that closes it, whatever it nests. Where
    tags of that kind are left open, so that none closes it, it ends at the first one. An element
    of a kind that is never closed after it has no text. A tag that ends in `/>` opens nothing.
    """
    opening = _opening(element_id)
    nested = r"(?is)^<([a-z][a-z0-9]*)(?=\s)[^>]*>.*<\1(?=[\s/>])"

    def text(first):
        kind = F.regexp_extract(first, opening, 1)
        from_there = F.substring(html, F.instr(html, first), F.length(html))
        whole = F.when(F.regexp_like(first, F.lit(nested)), _inner(from_there, kind))
        return _without_tags(F.coalesce(whole, first))

    # a value of its own, so that the page is searched once
    first = _first_match(html, opening + r".*?</\1\s*>")
    return F.get(F.transform(F.array(first), text), F.lit(0))


def page_title(html):
    """Text of the title element, NULL when there is none."""
    return F.trim(_without_tags(_first_match(html, r"(?is)<title[^>]*>.*?</title\s*>")))


def parse_price(text):
    """Number in a price text such as "₹ 12,999.00"; NULL when it is not one number.

    Character references and everything ahead of the first digit go, thousands separators too.
    """
    plain = F.regexp_replace(text, r"&#?[A-Za-z0-9]+;", " ")
    digits = F.regexp_replace(F.regexp_replace(plain, r"^[^0-9]+", ""), ",", "")
    return F.regexp_replace(digits, r"[\s\u00A0]+$", "").try_cast(PRICE_TYPE)


def price_text(price):
    """A price as digits with at least one decimal: 12999.0, 12999.5, 12999.99."""
    return F.regexp_replace(price.cast("string"), r"(\.\d+?)0+$", "$1")
