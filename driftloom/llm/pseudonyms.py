"""Format-preserving pseudonyms for numbers and dates in text.

Payment card numbers, North American telephone and social security numbers, IPv4 addresses and
dates are found by pattern, validated, and permuted within their own format by a keyed Feistel
network: a valid value becomes another valid value of the same form, and equal values become
equal pseudonyms in every document, so records stay linked. Who has the key can turn them back.

Each kind of value is numbered from 0 to N - 1, with N = N1 * N2. A number is written as a pair
(a, b) below (N1, N2); ten rounds add to a a keyed digest of b, modulo N1, and to b one of a,
modulo N2, in turn. That is a permutation of all pairs, so nothing has to be tried again and no
two values meet. All of it is DataFrame functions, and each row is worked on by itself.

Kinds and numbering: a card keeps its first digit and length, its last digit is computed (Luhn);
a telephone number's area and exchange start with 2 to 9; a social security number's area is not
000, 666 or 9xx and its other parts are not zero; dates are days of 1700 to 2099, one cycle of
the Gregorian calendar, written yyyy-mm-dd, yyyy/mm/dd, dd.mm.yyyy or mm/dd/yyyy. What has the
form but is not valid stays as it is.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from driftloom.llm.common import fresh_name, need

ROUNDS = 10
#: Stands for a secret in tests and in the query; a run for others passes its own.
DEMO_KEY = "demonstration key"
_DATE = r"\d{4}-\d{2}-\d{2}|\d{4}/\d{2}/\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4}"
_CARD = r"[3-6]\d{12,18}|[3-6]\d{3}(?: \d{4}){3}|[3-6]\d{3}(?:-\d{4}){3}"
_PHONE = r"(?:\+1[ -]?)?\([2-9]\d{2}\) ?[2-9]\d{2}-\d{4}|(?:\+1[ -])?[2-9]\d{2}-[2-9]\d{2}-\d{4}|\+1[2-9]\d{2}[2-9]\d{6}"
_SSN = r"\d{3}-\d{2}-\d{4}"
_IP = r"\d{1,3}(?:\.\d{1,3}){3}"
#: Not inside a longer number or word, nor part of a longer dotted or dashed one.
PATTERN = rf"(?<![\p{{L}}\p{{N}}+])(?<!\p{{N}}[.\-/])(?=[+(0-9])(?:{_DATE}|{_CARD}|{_PHONE}|{_SSN}|{_IP})(?![\p{{L}}\p{{N}}]|[.\-/]\p{{N}})"
FIRST_DAY, DAYS = "1700-01-01", (189, 773)


def _feistel(number: Column, n1: int | Column, n2: int | Column, tweak: Column, key: Column, inverse: bool) -> Column:
    """The number's place under the keyed permutation of n1 * n2 numbers."""
    n1 = F.lit(n1).cast("long") if isinstance(n1, int) else n1
    n2 = F.lit(n2).cast("long") if isinstance(n2, int) else n2
    sign = F.lit(-1 if inverse else 1)

    def moved(k: Column, other: Column) -> Column:
        text = F.concat_ws("|", key, tweak, k.cast("string"), other.cast("string"))
        return sign * F.conv(F.substring(F.sha2(text.cast("binary"), 256), 1, 14), 16, 10).cast("long")

    def step(pair: Column, k: Column) -> Column:
        even = k % 2 == 0
        a = F.when(even, F.pmod(pair["a"] + moved(k, pair["b"]), n1)).otherwise(pair["a"])
        b = F.when(even, pair["b"]).otherwise(F.pmod(pair["b"] + moved(k, pair["a"]), n2))
        return F.struct(a.alias("a"), b.alias("b"))

    rounds = F.sequence(F.lit(ROUNDS - 1), F.lit(0)) if inverse else F.sequence(F.lit(0), F.lit(ROUNDS - 1))
    number = number.cast("long")
    # Dividing as doubles is exact only below 2^53, so the quotient comes from what the remainder leaves.
    start = F.struct(((number - F.pmod(number, n2)).cast("decimal(20,0)") / n2.cast("decimal(20,0)")).cast("long").alias("a"), F.pmod(number, n2).alias("b"))
    return F.aggregate(rounds, start, step, lambda pair: pair["a"] * n2 + pair["b"])


def luhn_sum(digits: Column, length: Column, double_last: bool) -> Column:
    """Luhn's weighted digit sum; every second digit counts double, the last one or the last but one first."""

    def add(total: Column, i: Column) -> Column:
        d = F.substring(digits, i, F.lit(1)).cast("int")
        twice = (length - i) % 2 == (0 if double_last else 1)
        return total + F.when(twice, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), length), F.lit(0), add)


def _part(text: Column, start: int, size: int) -> Column:
    return F.substring(text, start, size)


def _card(found: Column, digits: Column, key: Column, inverse: bool) -> Column:
    n = F.length(digits)
    middle = n - 2
    half = F.floor(middle / 2).cast("int")
    inner = _feistel(F.substring(digits, F.lit(2), middle).cast("long"), F.pow(F.lit(10.0), middle - half).cast("long"), F.pow(F.lit(10.0), half).cast("long"), F.concat(F.lit("card"), n.cast("string")), key, inverse)
    body = F.concat(_part(digits, 1, 1), F.lpad(inner.cast("string"), middle, F.lit("0")))
    check = F.pmod(10 - luhn_sum(body, n - 1, True) % 10, F.lit(10))
    new = F.concat(body, check.cast("string"))
    gap = F.regexp_extract(found, r"([ -])", 1)
    grouped = F.concat_ws(" ", *[_part(new, 1 + 4 * i, 4) for i in range(4)])
    grouped = F.when(gap == "-", F.translate(grouped, " ", "-")).otherwise(grouped)
    return F.when(luhn_sum(digits, n, False) % 10 == 0, F.when(gap == "", new).otherwise(grouped)).otherwise(found)


def _filled(form: Column, digits: Column, last: int) -> Column:
    """`form` with its last `last` digits replaced by `digits`, signs and blanks kept."""
    # Every digit place from the right is filled by position: the signs between are few and fixed.
    signs = F.regexp_replace(form, r"\d", "#")

    def put(state: Column, i: Column) -> Column:
        c = F.substring(signs, F.length(form) + 1 - i, F.lit(1))
        here = (c == "#") & (state["used"] < last)
        sign = F.when(here, F.substring(digits, F.lit(last) - state["used"], F.lit(1))).otherwise(F.substring(form, F.length(form) + 1 - i, F.lit(1)))
        return F.struct(F.concat(sign, state["out"]).alias("out"), (state["used"] + F.when(here, 1).otherwise(0)).alias("used"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("used"))
    return F.aggregate(F.sequence(F.lit(1), F.length(form)), start, put, lambda s: s["out"])


def _phone(found: Column, digits: Column, key: Column, inverse: bool) -> Column:
    ten = F.substring(digits, -10, 10)
    number = ((_part(ten, 1, 3).cast("long") - 200) * 800 + _part(ten, 4, 3).cast("long") - 200) * 10000 + _part(ten, 7, 4).cast("long")
    new = _feistel(number, 80_000, 80_000, F.lit("phone"), key, inverse)
    front = F.floor(new / 10_000).cast("long")
    text = F.concat((F.floor(front / 800) + 200).cast("string"), (F.pmod(front, F.lit(800)) + 200).cast("string"), F.lpad(F.pmod(new, F.lit(10_000)).cast("string"), 4, "0"))
    return _filled(found, text, 10)


def _social(found: Column, key: Column, inverse: bool) -> Column:
    area, group, serial = _part(found, 1, 3).cast("long"), _part(found, 5, 2).cast("long"), _part(found, 8, 4).cast("long")
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    place = area - F.when(area > 666, 2).otherwise(1)
    new = _feistel((place * 99 + group - 1) * 9999 + serial - 1, 898 * 99, 9999, F.lit("social"), key, inverse)
    front = F.floor(new / 9999).cast("long")
    place = F.floor(front / 99).cast("long")
    area = place + F.when(place + 1 > 665, 2).otherwise(1)
    text = F.concat_ws("-", F.lpad(area.cast("string"), 3, "0"), F.lpad((F.pmod(front, F.lit(99)) + 1).cast("string"), 2, "0"), F.lpad((F.pmod(new, F.lit(9999)) + 1).cast("string"), 4, "0"))
    return F.when(valid, text).otherwise(found)


def _address(found: Column, key: Column, inverse: bool) -> Column:
    octets = F.split(found, r"\.")
    value = [F.element_at(octets, i + 1).cast("long") for i in range(4)]
    plain = F.concat_ws(".", *[v.cast("string") for v in value])  # leading zeros are another form
    new = _feistel(((value[0] * 256 + value[1]) * 256 + value[2]) * 256 + value[3], 65_536, 65_536, F.lit("ipv4"), key, inverse)
    text = F.concat_ws(".", *[F.shiftright(new, s).bitwiseAND(F.lit(255)).cast("string") for s in (24, 16, 8, 0)])
    return F.when((F.greatest(*value) < 256) & (plain == found), text).otherwise(found)


def _date(found: Column, key: Column, inverse: bool) -> Column:
    form = F.when(_part(found, 5, 1) == "-", "yyyy-MM-dd").when(_part(found, 5, 1) == "/", "yyyy/MM/dd").when(_part(found, 3, 1) == ".", "dd.MM.yyyy").otherwise("MM/dd/yyyy")
    year = F.when(form.startswith("yyyy"), _part(found, 1, 4)).otherwise(_part(found, 7, 4))
    month = F.when(form == "dd.MM.yyyy", _part(found, 4, 2)).when(form == "MM/dd/yyyy", _part(found, 1, 2)).otherwise(_part(found, 6, 2))
    day = F.when(form == "dd.MM.yyyy", _part(found, 1, 2)).when(form == "MM/dd/yyyy", _part(found, 4, 2)).otherwise(_part(found, 9, 2))
    date = F.concat_ws("-", year, month, day).try_cast("date")
    number = F.datediff(date, F.lit(FIRST_DAY).cast("date"))
    new = F.date_add(F.lit(FIRST_DAY).cast("date"), _feistel(number, *DAYS, F.lit("date"), key, inverse).cast("int"))
    y, m, d = F.lpad(F.year(new).cast("string"), 4, "0"), F.lpad(F.month(new).cast("string"), 2, "0"), F.lpad(F.day(new).cast("string"), 2, "0")
    text = F.when(form == "dd.MM.yyyy", F.concat_ws(".", d, m, y)).when(form == "MM/dd/yyyy", F.concat_ws("/", m, d, y)).otherwise(F.concat(y, _part(found, 5, 1), m, _part(found, 5, 1), d))
    return F.when((number >= 0) & (number < DAYS[0] * DAYS[1]), text).otherwise(found)


def pseudonym(found: Column, key: Column, inverse: bool = False) -> Column:
    """A found value's pseudonym, or with `inverse` the value of a pseudonym; the value itself where it is not valid."""
    digits = F.regexp_replace(found, r"[^0-9]", "")
    is_ = lambda pattern: found.rlike(rf"^(?:{pattern})$")
    out = (
        F.when(is_(_DATE), _date(found, key, inverse))
        .when(is_(_CARD), _card(found, digits, key, inverse))
        .when(is_(_PHONE), _phone(found, digits, key, inverse))
        .when(is_(_SSN), _social(found, key, inverse))
        .when(is_(_IP), _address(found, key, inverse))
    )
    return F.coalesce(out, found)


def with_pseudonyms(docs: DataFrame, key: str, text_col: str = "text", inverse: bool = False) -> tuple[DataFrame, str]:
    """The documents with their text rewritten, one more column, and its name: how many values were replaced.

    A null text stays null and has 0; a text without such values stays as it is. Rows and other
    columns stay as they are. The new column is called `n_replaced`, with underscores after it
    where the frame has one of that name.
    """
    need(docs, text_col)
    name, parts = fresh_name(docs, "n_replaced"), fresh_name(docs, "__parts")
    text, secret = F.col(text_col), F.lit(key)
    found = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))
    pairs = F.transform(found, lambda x: F.struct(x.alias("old"), pseudonym(x, secret, inverse).alias("new")))
    held = docs.withColumn(parts, F.when(text.rlike(r"\d\d|\d\.\d"), pairs))
    new, pieces = F.transform(F.col(parts), lambda p: p["new"]), F.split(text, PATTERN, -1)
    rewritten = F.array_join(F.zip_with(pieces, new, lambda a, b: F.concat(a, F.coalesce(b, F.lit("")))), "")
    any_ = F.size(parts) > 0
    count = F.size(F.filter(F.col(parts), lambda p: p["old"] != p["new"]))
    columns = [F.when(any_, rewritten).otherwise(text).alias(c) if c == text_col else F.col(c) for c in docs.columns]
    return held.select(*columns, F.when(any_, count).otherwise(0).alias(name)), name
