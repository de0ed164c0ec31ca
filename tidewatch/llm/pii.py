"""Format-preserving pseudonyms for personal data, as SQL expressions only.

Validated numbers and dates go through a keyed Feistel network over their own domain:
a card number keeps its length, separators and a right check digit, an address stays an
address, a date a calendar date.  The permutation is a bijection, so equal values get
equal pseudonyms in every document and different ones stay apart.  Mail addresses and
secrets have no numeric domain: they get keyed digests in their own format.

One regular expression finds the values; a text without one is passed on as it is.
The rest runs on the array of found values with higher-order functions: no shuffle, no
Python, whole texts.  Cards are sought in whole runs of digit groups: from every group on,
each grouping of ``CARDS`` is tried until one passes the Luhn test, so numbers before or
after a card do not hide it.

Covered forms: mail addresses; ``name = value`` secrets and AKIA/ASIA keys; dotted IPv4 addresses; dates as
``yyyy-mm-dd``, ``dd.mm.yyyy``, ``dd/mm/yyyy`` and ``mm/dd/yyyy``; social security numbers as ``ddd-dd-dddd``; phones in
groups of 3-3-4 with separators, or 8 to 15 digits after a plus; cards of 13 to 19 digits, grouped or not.

Validation decides what is personal: a card number must pass the Luhn test, a date exist (from the year 400 on),
an address have octets up to 255, a social security number have no all-zero or reserved
group.  What fails, and any other form (IPv6, IBAN, dates with month names or one-digit days, numbers without
separators), is left in place (``4.0.`` or an order number is not personal data).

Defined cases: a null text stays null with no spans; an empty one stays empty; repeated
rows get equal results; other columns are untouched, and ``spans`` is replaced if present;
an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import free_name, let

ROUNDS = 8
#: The session setting that holds the secret key of the permutations; equal keys link equal values.
KEY_SETTING = "spark.tidewatch.pseudonym.key"
#: Without that setting, as in tests: anyone with this code can undo the pseudonyms.
DEFAULT_KEY = "pseudonym-key-1"

_EDGE = r"(?<![\p{L}\p{N}_])"
_END = r"(?![\p{L}\p{N}_])"
_IP = r"(?<![\p{L}\p{N}.])\d{1,3}(?:\.\d{1,3}){3}(?![\p{L}\p{N}]|\.\d)"
#: A date may end before the time of an ISO timestamp.
_DATE = rf"{_EDGE}(?:\d{{4}}-\d{{2}}-\d{{2}}(?!(?!T\d)[\p{{L}}\p{{N}}_])|\d{{2}}[./]\d{{2}}[./]\d{{4}}{_END})"
_SSN = r"(?<![\p{L}\p{N}\-])\d{3}-\d{2}-\d{4}(?![\p{L}\p{N}]|-\d)"
#: Four groups of four (and no fifth) or a 4-6-5 or 4-6-4 card begin here: no part of a phone number.
_NO_CARD = r"(?!(?<!\d)\d{4}[ \-](?:\d{4}[ \-]\d{4}[ \-]\d{4}(?!\d|[ \-]\d{4}(?!\d))|\d{6}[ \-]\d{4,5}(?!\d)))"
_PHONE = (rf"(?<![\p{{L}}\p{{N}}])(?:\+\d{{1,3}}[ .\-]?)?(?:\(\d{{3}}\)[ .\-]?|\d{{3}}[ .\-])\d{{3}}[ .\-]{_NO_CARD}\d{{4}}{_END}"
          # 8 to 15 digits after a plus, grouped in any way
          rf"|(?<![\p{{L}}\p{{N}}])\+\d(?:(?:[ .\-]?\(?|\)[ .\-]?){_NO_CARD}(?!(?<!\d)(?:{_DATE}|{_IP}))\d){{7,14}}{_END}")
#: What is looked for, by kind, in order of precedence at one place.  Repeated groups are possessive or
#: of few rounds: the engine would recurse once a round of any other, and overflow its stack on a long value.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+\-])[\p{L}\p{N}._%+\-]++@[\p{L}\p{N}\-]++(?:\.[\p{L}\p{N}\-]++)++",
    "secret": (r"(?i:\b(?:token|secret|password|passwd|api[_-]?key|access[_-]?key)\b[\"']?\s*[=:]\s*)(?:\"[^\"\s]{6,}+\"|'[^'\s]{6,}+'|[^\s\"'|]{6,}+)"
               rf"|{_EDGE}(?:AKIA|ASIA)[A-Z0-9]{{16}}{_END}"),
    "ip": _IP,
    "date": _DATE,
    "ssn": _SSN,
    "phone": _PHONE,
    # a run of digit groups up to where another value begins
    "card": rf"{_EDGE}(?=(?:\d[ \-]?){{13}})\d++{_END}(?:[ \-](?!{_IP}|{_DATE}|{_SSN}|{_PHONE})\d++{_END})*+",
}

#: Groupings of a card number, those in use first; at one place the first that passes the Luhn test counts.
CARDS = [rf"^{groups}(?!\d)" for groups in (
    r"\d{13,19}", r"\d{4}(?:[ \-]\d{4}){3}[ \-]\d{3}", r"\d{4}(?:[ \-]\d{4}){3}", r"\d{4}[ \-]\d{6}[ \-]\d{5}", r"\d{4}[ \-]\d{6}[ \-]\d{4}",
    *(rf"\d{{4}}[ \-]\d{{4}}(?:[ \-]\d{{2,7}}){{{n}}}" for n in (3, 2, 1)))]
CARD_GROUPS = 5


def _digest(key: Column, *parts) -> Column:
    return F.sha2(F.concat_ws("|", key, *parts), 256)


def feistel(value: Column, left: int, right: int, key: Column, domain: str) -> Column:
    """A keyed permutation of the longs 0 .. left * right - 1 (null stays null)."""
    def step(state: Column, i: Column) -> Column:
        odd = i % 2 == 1
        half = F.when(odd, state.r).otherwise(state.l)
        f = F.conv(F.substring(_digest(key, F.lit(domain), i.cast("string"), half.cast("string")), 1, 15), 16, 10).cast("long")
        return F.struct(F.when(odd, F.pmod(state.l + F.pmod(f, F.lit(left)), F.lit(left).cast("long"))).otherwise(state.l).alias("l"),
                        F.when(odd, state.r).otherwise(F.pmod(state.r + F.pmod(f, F.lit(right)), F.lit(right).cast("long"))).alias("r"))

    start = F.struct(_div(value, right).alias("l"), F.pmod(value, F.lit(right).cast("long")).alias("r"))
    return F.aggregate(F.array(*[F.lit(i) for i in range(1, ROUNDS + 1)]), start, step, lambda s: s.l * F.lit(right).cast("long") + s.r)


def _div(value: Column, by: int) -> Column:
    return F.call_function("div", value, F.lit(by).cast("long"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _into(value: Column, digits: Column) -> Column:
    """``value`` with its digits replaced, in order, by those of ``digits``."""
    def step(state: Column, c: Column) -> Column:
        is_digit = c.rlike("^[0-9]$")
        return F.struct(F.concat(state.s, F.when(is_digit, F.substr(digits, state.k, F.lit(1))).otherwise(c)).alias("s"),
                        (state.k + is_digit.cast("int")).alias("k"))

    start = F.struct(F.lit("").alias("s"), F.lit(1).alias("k"))
    return F.aggregate(F.regexp_extract_all(value, F.lit("(?s)."), F.lit(0)), start, step, lambda s: s.s)


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """The Luhn sum where the last digit is doubled (1) or not (0)."""
    reversed_ = F.regexp_extract_all(F.reverse(digits), F.lit("."), F.lit(0))
    each = F.transform(reversed_, lambda c, i: F.when((i + doubled) % 2 == 0, c.cast("int"))
                       .otherwise(2 * c.cast("int") - F.when(c.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def _is_card(value: Column) -> Column:
    digits = _digits(value)
    return F.length(digits).between(13, 19) & (_luhn_sum(digits, 0) % 10 == 0)


def _plain(value: Column) -> Column:
    return F.struct(F.lit(None).cast("string").alias("kind"), value.alias("value"))


def _run(value: Column) -> Column:
    """A run of digit groups as (kind, value) pieces: its cards, and what is between them."""
    def cards(parts: Column) -> Column:                    # groups at even places, separators at odd ones
        at = F.sequence(F.lit(0), F.size(parts) - 1, F.lit(2))
        ahead = lambda i: F.array_join(F.slice(parts, i + 1, F.lit(2 * CARD_GROUPS)), "")
        return F.transform(at, lambda i: let(ahead(i), lambda t: F.get(F.filter(
            F.array(*[F.regexp_extract(t, shape, 0) for shape in CARDS]), _is_card), F.lit(0))))

    def split(parts: Column, card: Column) -> Column:
        text = lambda a, b: F.array_join(F.slice(parts, a + 1, b - a), "")

        def step(state: Column, i: Column) -> Column:
            end = 2 * i + F.size(F.regexp_extract_all(F.get(card, i), F.lit(r"\d+|[ \-]"), F.lit(0)))
            mark = F.struct(state.end.alias("before"), (2 * i).alias("start"), F.get(card, i).alias("value"))
            hit = F.get(card, i).isNotNull() & (2 * i >= state.end)
            return F.when(hit, F.struct(end.alias("end"), F.concat(state.marks, F.array(mark)).alias("marks"))).otherwise(state)

        none = F.expr("cast(array() as array<struct<before:int,start:int,value:string>>)")
        found = F.aggregate(F.sequence(F.lit(0), F.size(card) - 1), F.struct(F.lit(0).alias("end"), none.alias("marks")), step)
        pieces = lambda f: F.concat(
            F.flatten(F.transform(f.marks, lambda m: F.array(_plain(text(m.before, m.start)), F.struct(F.lit("card").alias("kind"), m.value.alias("value"))))),
            F.array(_plain(text(f.end, F.size(parts)))))
        return let(found, pieces)

    # most runs hold no card
    return let(F.regexp_extract_all(value, F.lit(r"\d+|[ \-]"), F.lit(0)), lambda parts: let(cards(parts), lambda card: F.when(
        F.exists(card, lambda c: c.isNotNull()), split(parts, card)).otherwise(F.array(_plain(F.array_join(parts, ""))))))


def _card(value: Column, key: Column) -> Column:
    digits = _digits(value)
    valid = _is_card(value)
    body = F.substr(digits, F.lit(1), F.length(digits) - 1)
    image = _by_length(body, range(12, 19), key, "card")
    check = F.pmod(10 - _luhn_sum(image, 1) % 10, F.lit(10)).cast("string")
    return F.when(valid, _into(value, F.concat(image, check)))


def _by_length(digits: Column, lengths, key: Column, domain: str) -> Column:
    out = None
    for n in lengths:
        right = 10 ** (n // 2)
        image = F.lpad(feistel(digits.cast("long"), 10 ** (n - n // 2), right, key, f"{domain}{n}").cast("string"), n, "0")
        out = F.when(F.length(digits) == n, image) if out is None else out.when(F.length(digits) == n, image)
    return out


def _ip(value: Column, key: Column) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: p.cast("long"))
    valid = F.forall(parts, lambda p: p <= 255)
    whole = F.aggregate(parts, F.lit(0).cast("long"), lambda a, p: a * 256 + p)
    image = feistel(whole, 1 << 16, 1 << 16, key, "ip")
    octets = [F.pmod(F.shiftright(image, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)]
    return F.when(valid, F.concat_ws(".", *octets))


#: Fixed value: days of the Gregorian calendar's 400-year cycle, and its two factors.
CYCLE, CYCLE_LEFT, CYCLE_RIGHT = 146097, 189, 773


#: Dates before this have images that cannot be written with four digits of year.
FIRST_DATE = "0400-01-01"
#: Steps along the permutation, each of which stays within its form for three dates in five.
WALK = 80


def _date(value: Column, key: Column) -> Column:
    """Calendar dates are permuted within their 400-year cycle (1600-1999, 2000-2399, ...).

    ``d/m`` is read day first where that is a date.  A date that can only be read month first walks
    the permutation on to one of its kind, so no two slash dates share an image.
    """
    start = F.lit("2000-01-01").cast("date")
    iso = value.rlike("^[0-9]{4}-")
    slash = F.substr(value, F.lit(3), F.lit(1)) == "/"

    def one(pattern: str, walks: bool = False) -> Column:
        day = F.try_to_timestamp(value, F.lit(pattern)).cast("date")
        number = F.datediff(day, start).cast("long")
        cycle = number - F.pmod(number, F.lit(CYCLE))
        permuted = lambda n: feistel(n, CYCLE_LEFT, CYCLE_RIGHT, key, "date")
        moved = lambda n: F.date_add(start, (cycle + n).cast("int"))
        image = permuted(F.pmod(number, F.lit(CYCLE)))
        if walks:
            image = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), image,
                                lambda n, _: F.when(F.dayofmonth(moved(n)) > 12, n).otherwise(permuted(n)))
        return F.when(day >= F.lit(FIRST_DATE).cast("date"), F.date_format(moved(image), pattern))

    return (F.when(iso, one("yyyy-MM-dd")).when(~slash, one("dd.MM.yyyy"))
            .otherwise(F.coalesce(one("dd/MM/yyyy"), one("MM/dd/yyyy", walks=True))))


def _ssn(value: Column, key: Column) -> Column:
    """Areas 001-899 but 666, groups 01-99 and serials 0001-9999 map onto themselves."""
    area, group, serial = (F.substr(value, F.lit(a), F.lit(n)).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    place = area - 1 - (area > 666).cast("long")           # 0 .. 897
    image = feistel((place * 99 + group - 1) * 9999 + serial - 1, 898 * 99, 9999, key, "ssn")
    high = _div(image, 9999)
    a = _div(high, 99)
    a = a + 1 + (a >= 665).cast("long")
    text = lambda c, n: F.lpad(c.cast("string"), n, "0")
    return F.when(valid, F.concat_ws("-", text(a, 3), text(F.pmod(high, F.lit(99)) + 1, 2),
                                     text(F.pmod(image, F.lit(9999)) + 1, 4)))


def _phone(value: Column, key: Column) -> Column:
    """The last ten digits (or all of fewer) are permuted; the rest stays."""
    digits = _digits(value)
    n = F.least(F.length(digits), F.lit(10))
    head = F.substr(digits, F.lit(1), F.length(digits) - n)
    tail = F.substr(digits, F.length(digits) - n + 1, n)
    return _into(value, F.concat(head, _by_length(tail, [8, 9, 10], key, "phone")))


def _email(value: Column, key: Column) -> Column:
    d = _digest(key, F.lit("email"), F.lower(value))
    return F.concat(F.lit("user"), F.substr(d, F.lit(1), F.lit(16)), F.lit("@mail.example"))


def _secret(value: Column, key: Column) -> Column:
    """What names the secret stays; its characters become keyed hexadecimal ones, as many."""
    head = F.regexp_extract(value, r"(?i)^((?:token|secret|password|passwd|api[_-]?key|access[_-]?key)[\"']?\s*[=:]\s*[\"']?|AKIA|ASIA)", 1)
    quote = F.regexp_extract(value, "([\"'])$", 1)
    body = F.substr(value, F.length(head) + 1, F.length(value) - F.length(head) - F.length(quote))
    blocks = let(_digest(key, F.lit("secret"), body), lambda whole: F.transform(
        F.sequence(F.lit(0), ((F.length(body) - 1) / 64).cast("int")), lambda i: _digest(key, F.lit("secret"), i.cast("string"), whole)))
    hexes = F.substr(F.array_join(blocks, ""), F.lit(1), F.length(body))
    return F.concat(head, F.when(head.isin("AKIA", "ASIA"), F.upper(hexes)).otherwise(hexes), quote)


_MAKERS = {"email": _email, "secret": _secret, "ip": _ip, "date": _date, "ssn": _ssn, "phone": _phone, "card": _card}

#: Every pattern needs one of these, which a scan finds faster.
MAYBE = "[0-9@=:]|AKIA|ASIA"
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())


def _kind(value: Column) -> Column:
    """Which pattern a found value is of: the first that matches it as a whole."""
    out = None
    for kind, pattern in PATTERNS.items():
        hit = value.rlike(rf"\A(?:{pattern})\z")
        out = F.when(hit, kind) if out is None else out.when(hit, kind)
    return out


def _pseudonym(found: Column, key: Column) -> Column:
    out = None
    for kind, make in _MAKERS.items():
        out = F.when(found.kind == kind, make(found.value, key)) if out is None else out.when(found.kind == kind, make(found.value, key))
    return out


NO_MARKS = "cast(array() as array<struct<kind:string,start:int,length:int>>)"
#: Pieces whose places are summed up together: appending to an array copies it, so a text's pieces go in two levels.
PIECES = 256


def _marks(found: Column, put) -> Column:
    """``(kind, start, length)`` of every replaced piece of ``found``, whose new text is ``put(piece)``."""
    def step(state: Column, f: Column) -> Column:
        mark = F.struct(f.kind.alias("kind"), state.at.alias("start"), F.length(put(f)).alias("length"))
        return F.struct(F.when(f.new.isNotNull(), F.concat(state.marks, F.array(mark)))
                        .otherwise(state.marks).alias("marks"), (state.at + F.length(put(f))).alias("at"))

    begin = F.struct(F.expr(NO_MARKS).alias("marks"), F.lit(0).alias("at"))
    groups = F.transform(F.sequence(F.lit(1), F.size(found), F.lit(PIECES)),
                         lambda i: F.aggregate(F.slice(found, i, F.lit(PIECES)), begin, step))

    def joined(parts: Column) -> Column:
        starts = F.aggregate(parts, F.struct(F.expr("cast(array() as array<int>)").alias("starts"), F.lit(0).alias("at")),
                             lambda s, p: F.struct(F.concat(s.starts, F.array(s.at)).alias("starts"), (s.at + p.at).alias("at"))).starts
        return F.flatten(F.zip_with(parts, starts, lambda p, at: F.transform(p.marks, lambda m: F.struct(
            m.kind.alias("kind"), (m.start + at).alias("start"), m.length.alias("length")))))

    return let(groups, joined)


def pseudonymised(docs: DataFrame, text: str = "text", key: str | None = None, spans: str | None = "spans") -> DataFrame:
    """``docs`` with the text's personal values replaced, and a column of what was replaced.

    The ``key`` is by default that of the session's setting ``KEY_SETTING``.

    ``spans`` holds ``(kind, start, length)`` of every replaced value in the *new* text,
    in code points from 0, and never the value itself; ``spans=None`` leaves it out.
    """
    k = F.lit(key if key is not None else docs.sparkSession.conf.get(KEY_SETTING, DEFAULT_KEY))
    t = F.col(text).cast("string")
    values = F.regexp_extract_all(t, F.lit(ANY), F.lit(0))
    between = F.split(t, ANY, -1)                           # one more than values
    typed = F.transform(values, lambda v: F.struct(_kind(v).alias("kind"), v.alias("value")))
    typed = F.transform(typed, lambda f: F.when(f.kind == "card", _run(f.value)).otherwise(F.array(f)))
    # the text in pieces: what is between values has no kind
    pieces = F.flatten(F.zip_with(between, typed, lambda b, f: F.concat(F.array(_plain(b)), F.coalesce(f, F.array(_plain(F.lit("")))))))
    made = F.transform(pieces, lambda f: F.struct(f.kind.alias("kind"), f.value.alias("value"), _pseudonym(f, k).alias("new")))
    held, changed = free_name(docs, "_found"), free_name(docs, "_new")
    work = docs.withColumn(held, F.when(t.rlike(MAYBE) & t.rlike(ANY), made))
    found = F.col(held)
    put = lambda f: F.coalesce(f.new, f.value)
    out = work.withColumn(changed, F.array_join(F.transform(found, put), ""))
    if spans:
        out = out.withColumn(spans, F.when(found.isNotNull(), _marks(found, put)).otherwise(F.expr(NO_MARKS)))
    return out.withColumn(text, F.coalesce(changed, t)).drop(held, changed)
