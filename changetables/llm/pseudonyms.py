"""Personal data replaced by format-preserving Feistel pseudonyms.

Validated numbers, dates, addresses and mail names are permuted by a keyed Feistel network
inside their own format: a card number stays a valid card number, a date a date. Equal
values get equal pseudonyms in every document, different values different ones, and
``restore=True`` with the same key gives the originals back.

A network has two halves and never swaps them: even rounds add a keyed hash of the right
half to the left one, modulo the left half's size, odd rounds do the reverse. As in any
permutation a value may be its own pseudonym; that matters only for very short mail names.

Mail addresses with a name above 256 characters or a domain above 8 labels are beyond what
mail systems take; they are not recognised and stay as they are.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changetables.functions.text import let
from changetables.llm.common import matches

ROUNDS = 8

# The kinds and their formats, in the order in which they are tried.
# Each starts and ends where its run of characters does, so long runs are read once.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,256}+@(?:[A-Za-z0-9-]{1,63}+\.){1,8}[A-Za-z]{2,24}",
    "ip": r"(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?!\.?[0-9])",
    "date": r"(?<![0-9])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": r"(?<![0-9])(?:(?:\+1[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-][0-9]{4}|\+1[ .-]?[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}"
    r"|[2-9][0-9]{2}[ .-][2-9][0-9]{2}[ .-][0-9]{4})(?![0-9])",
    "abroad": r"(?<![0-9])\+[2-9][0-9]{0,2}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}[A-Z0-9]{11,30}(?![A-Za-z0-9])",
    "card": r"(?<![0-9])(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})(?![0-9])",
}
KINDS = tuple(PATTERNS)
ANY = "|".join(PATTERNS.values())
#: The 400 years in which dates are permuted: 146,097 days, 189 x 773.
FIRST_DAY, LAST_DAY = "1800-01-01", "2199-12-31"
DATE_FORMATS = {r"^....-": "yyyy-MM-dd", r"\.": "dd.MM.yyyy", "/": "MM/dd/yyyy"}


class Cipher:
    """The keyed permutations; ``restore`` turns them round."""

    def __init__(self, key: str, restore: bool = False):
        self.key, self.restore = key, restore

    def _hash(self, kind: str, tweak: Column, turn: Column, half: Column) -> Column:
        return F.sha2(F.concat_ws("|", F.lit(self.key), F.lit(kind), tweak, turn, half), 256)

    def _number(self, *of) -> Column:
        return F.conv(F.substring(self._hash(*of), 1, 15), 16, 10).cast("long")

    def _rounds(self, left: Column, right: Column, step) -> Column:
        turns = range(ROUNDS - 1, -1, -1) if self.restore else range(ROUNDS)
        return F.aggregate(
            F.array(*(F.lit(t) for t in turns)),
            F.struct(left.alias("l"), right.alias("r")),
            lambda x, t: F.when(t % 2 == 0, F.struct(step(x["l"], x["r"], t, 0).alias("l"), x["r"].alias("r"))).otherwise(
                F.struct(x["l"].alias("l"), step(x["r"], x["l"], t, 1).alias("r"))
            ),
        )

    def numbers(self, kind: str, left: Column, right: Column, sizes: tuple, tweak: Column | None = None) -> Column:
        """A pair of numbers, each below its size, as struct (l, r)."""
        tweak = F.lit("") if tweak is None else tweak
        sign = -1 if self.restore else 1

        def step(own, other, turn, side):
            size = sizes[side]
            return F.pmod(own + sign * F.pmod(self._number(kind, tweak, turn, other.cast("string")), size), size)

        return self._rounds(left.cast("long"), right.cast("long"), step)

    def digits(self, kind: str, text: Column, tweak: Column | None = None) -> Column:
        """A string of 2 to 30 digits, permuted among those of its length."""
        cut = F.floor(F.length(text) / 2).cast("int")
        left, right = F.substring(text, F.lit(1), cut), F.substring(text, cut + 1, F.length(text))
        size = lambda x: F.pow(F.lit(10.0), F.length(x)).cast("long")
        pair = self.numbers(kind, left.cast("long"), right.cast("long"), (size(left), size(right)), tweak)
        return let(
            pair,
            lambda p: F.concat(
                F.lpad(p["l"].cast("string"), F.length(left), F.lit("0")),
                F.lpad(p["r"].cast("string"), F.length(right), F.lit("0")),
            ),
        )

    def name(self, text: Column, tweak: Column) -> Column:
        """A string whose letters and digits change within their class; other characters stay."""
        cut = F.ceil(F.length(text) / 2).cast("int")
        sign = -1 if self.restore else 1

        def step(own, other, turn, _):
            def shifted(c: Column, shift: Column) -> Column:
                code = F.ascii(c)
                turned = lambda low, n: F.char(F.pmod(code - low + sign * F.pmod(shift, F.lit(n)), F.lit(n)) + low)
                return (
                    F.when(c.between("0", "9"), turned(48, 10))
                    .when(c.between("A", "Z"), turned(65, 26))
                    .when(c.between("a", "z"), turned(97, 26))
                    .otherwise(c)
                )

            return let(
                self._hash("name", tweak, turn, other),
                lambda h: F.array_join(
                    F.transform(
                        F.split(own, ""),
                        lambda c, i: shifted(c, F.conv(F.substring(h, (i % 16) * 4 + 1, F.lit(4)), 16, 10).cast("int")),
                    ),
                    "",
                ),
            )

        pair = self._rounds(F.substring(text, F.lit(1), cut), F.substring(text, cut + 1, F.length(text)), step)
        return let(pair, lambda p: F.concat(p["l"], p["r"]))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _in_layout(layout: Column, digits: Column) -> Column:
    """``layout`` with its digits replaced, in order."""
    return F.array_join(
        F.transform(
            F.split(layout, ""),
            lambda c, i: F.when(
                c.between("0", "9"), F.substring(digits, F.length(_digits(F.substring(layout, F.lit(1), i + 1))), F.lit(1))
            ).otherwise(c),
        ),
        "",
    )


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0), lambda a, x: a + x)


def luhn(digits: Column) -> Column:
    """Luhn sum, modulo 10; 0 for a valid number."""
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    return F.pmod(
        _sum(
            F.transform(
                F.split(F.reverse(digits), ""),
                lambda c, i: F.when(i % 2 == 1, doubled(c.cast("int"))).otherwise(c.cast("int")),
            )
        ),
        F.lit(10),
    )


def mod97(text: Column) -> Column:
    """Remainder by 97 of digits and letters, letters counting from 10."""

    def value(rest: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), rest * 10 + c.cast("int")).otherwise(rest * 100 + F.ascii(c) - 55) % 97

    return F.aggregate(F.split(text, ""), F.lit(0), value)


def _part(value: Column, start: int, length: int) -> Column:
    return F.substring(value, start, length).cast("long")


def _email(m: Column, c: Cipher) -> Column:
    at = F.instr(m, "@")
    domain = F.substring(m, at, F.length(m))
    return F.concat(c.name(F.substring(m, F.lit(1), at - 1), F.lower(domain)), domain)


def _ip(m: Column, c: Cipher) -> Column:
    def permuted(o: Column) -> Column:
        pair = c.numbers("ip", o[0] * 256 + o[1], o[2] * 256 + o[3], (F.lit(65536), F.lit(65536)))
        return let(
            pair,
            lambda p: F.concat_ws(
                ".", F.floor(p["l"] / 256), F.pmod(p["l"], F.lit(256)), F.floor(p["r"] / 256), F.pmod(p["r"], F.lit(256))
            ),
        )

    octets = F.split(m, r"\.").cast("array<int>")
    return let(octets, lambda o: F.when(F.forall(o, lambda x: x < 256), permuted(o)))


def _date(m: Column, c: Cipher) -> Column:
    def permuted(day: Column, layout: str) -> Column:
        n = F.date_diff(day, F.lit(FIRST_DAY).cast("date"))
        pair = c.numbers("date", F.floor(n / 773), F.pmod(n, F.lit(773)), (F.lit(189), F.lit(773)))
        return let(
            pair,
            lambda p: F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), (p["l"] * 773 + p["r"]).cast("int")), layout),
        )

    def one(layout: str) -> Column:
        day = F.try_to_timestamp(m, F.lit(layout)).cast("date")
        return let(day, lambda d: F.when(d.between(F.lit(FIRST_DAY).cast("date"), F.lit(LAST_DAY).cast("date")), permuted(d, layout)))

    return reduce(lambda rest, x: F.when(m.rlike(x[0]), one(x[1])).otherwise(rest), DATE_FORMATS.items(), F.lit(None))


def _ssn(m: Column, c: Cipher) -> Column:
    area, group, serial = _part(m, 1, 3), _part(m, 5, 2), _part(m, 8, 4)
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    place = area - F.when(area > 666, 2).otherwise(1)
    pair = c.numbers("ssn", place, (group - 1) * 9999 + serial - 1, (F.lit(898), F.lit(99 * 9999)))
    out = let(
        pair,
        lambda p: F.concat_ws(
            "-",
            F.lpad((p["l"] + F.when(p["l"] >= 665, 2).otherwise(1)).cast("string"), 3, "0"),
            F.lpad((F.floor(p["r"] / 9999) + 1).cast("string"), 2, "0"),
            F.lpad((F.pmod(p["r"], F.lit(9999)) + 1).cast("string"), 4, "0"),
        ),
    )
    return F.when(valid, out)


def _phone(m: Column, c: Cipher) -> Column:
    """A leading +1 stays; area and exchange codes that start with 2 to 9, or not, go on doing so."""
    lead = F.regexp_extract(m, r"^\+1", 0)
    rest = F.substring(m, F.length(lead) + 1, F.length(m))

    def permuted(d: Column) -> Column:
        area, line = _part(d, 1, 3), _part(d, 4, 7)
        low = [F.when(area < 200, 0).otherwise(200), F.when(line < 2_000_000, 0).otherwise(2_000_000)]
        sizes = (F.when(area < 200, 200).otherwise(800), F.when(line < 2_000_000, 2_000_000).otherwise(8_000_000))
        pair = c.numbers("phone", area - low[0], line - low[1], sizes, F.concat_ws("/", *sizes))
        return let(
            pair,
            lambda p: F.concat(
                F.lpad((p["l"] + low[0]).cast("string"), 3, "0"), F.lpad((p["r"] + low[1]).cast("string"), 7, "0")
            ),
        )

    return F.concat(lead, _in_layout(rest, let(_digits(rest), permuted)))


def _abroad(m: Column, c: Cipher) -> Column:
    """Digits after the first one are permuted."""
    lead = F.substring(m, 1, 2)
    rest = F.substring(m, F.lit(3), F.length(m))
    return F.concat(lead, _in_layout(rest, let(_digits(rest), lambda d: c.digits("abroad", d, lead))))


def _iban(m: Column, c: Cipher) -> Column:
    """Letters and country stay, the account's digits change, the check digits follow."""
    country, account = F.substring(m, 1, 2), F.substring(m, F.lit(5), F.length(m))
    old = _digits(account)
    new = F.when(F.length(old) < 2, old).otherwise(c.digits("iban", old, F.concat(country, F.regexp_replace(account, "[0-9]", "0"))))
    out = let(
        _in_layout(account, new),
        lambda a: F.concat(country, F.lpad((98 - mod97(F.concat(a, country, F.lit("00")))).cast("string"), 2, "0"), a),
    )
    return F.when(mod97(F.concat(account, F.substring(m, 1, 4))) == 1, out)


def _card(m: Column, c: Cipher) -> Column:
    """The first digit stays, the check digit follows, the digits between are permuted."""

    def permuted(d: Column) -> Column:
        first = F.substring(d, 1, 1)
        inner = F.substring(d, F.lit(2), F.length(d) - 2)
        return let(
            F.concat(first, c.digits("card", inner, first)),
            lambda x: F.concat(x, F.pmod(10 - luhn(F.concat(x, F.lit("0"))), F.lit(10)).cast("string")),
        )

    return let(_digits(m), lambda d: F.when(luhn(d) == 0, _in_layout(m, permuted(d))))


_PERMUTE = {
    "email": _email, "ip": _ip, "date": _date, "ssn": _ssn,
    "phone": _phone, "abroad": _abroad, "iban": _iban, "card": _card,
}


def pseudonym(value: Column, cipher: Cipher) -> Column:
    """Struct (kind, text) for a matched string; null text where it is not valid for its kind."""
    out = F.lit(None).cast("struct<kind:string,text:string>")
    for kind in reversed(KINDS):
        whole = value.rlike(f"^(?:{PATTERNS[kind]})$")
        out = F.when(whole, F.struct(F.lit(kind).alias("kind"), _PERMUTE[kind](value, cipher).alias("text"))).otherwise(out)
    return out


def pseudonymise(
    docs: DataFrame, key: str, text: str = "text", restore: bool = False, replaced: str = "replaced"
) -> DataFrame:
    """``docs`` with the text rewritten and a column of the kinds of its replaced values, in order.

    Strings that have a kind's form but are not valid (a card number with a wrong check
    digit, 31 February) stay. A null text stays null, with nothing replaced; every other
    input row comes back too. A column of the name ``replaced`` gives is overwritten. The key
    is a secret of the caller.
    """
    cipher = Cipher(key, restore)
    whole = F.col(text)

    def rewritten(found: Column, between: Column) -> Column:
        pseudonyms = F.transform(found, lambda m: pseudonym(m, cipher))
        return let(
            pseudonyms,
            lambda p: F.struct(
                F.array_join(
                    F.transform(
                        between,
                        lambda b, i: F.concat(
                            b, F.when(i < F.size(found), F.coalesce(F.get(p, i)["text"], F.get(found, i))).otherwise(F.lit(""))
                        ),
                    ),
                    "",
                ).alias("text"),
                F.transform(F.filter(p, lambda x: x["text"].isNotNull()), lambda x: x["kind"]).alias("kinds"),
            ),
        )

    return (
        docs.withColumn("__new", F.when(whole.rlike("[0-9@]"), matches(whole, ANY, rewritten)))
        .withColumn(text, F.when(F.size("__new.kinds") > 0, F.col("__new.text")).otherwise(whole))
        .withColumn(replaced, F.coalesce(F.col("__new.kinds"), F.array().cast("array<string>")))
        .drop("__new")
    )


def rewrite(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with the text rewritten and their own columns; n_chars follows the text."""
    out = pseudonymise(docs, key, replaced="__replaced")
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.when(F.size("__replaced") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)
