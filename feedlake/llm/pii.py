"""Format-preserving pseudonyms for personal data.

Numbers, addresses and dates that pass their validation are permuted by a keyed
Feistel network within the set of valid values of their format. Equal values get
equal pseudonyms in all documents, different values of a format different ones,
and lengths and separators stay. Nothing is stored: the key is the only secret.

A Feistel round adds a keyed digest of one half to the other, modulo the number of
values of that half. This is a permutation whatever the two moduli are, so sets
such as the days of 400 years are permuted without leaving them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedlake.llm.common import let

ROUNDS = 8
MAX_HALF = {10: 17, 16: 14, 36: 11}  # characters of a half that fit a signed long with a sum's carry
CYCLE_START, CYCLE_DAYS = "1600-01-01", (27, 5411)  # the Gregorian calendar repeats after 400 years

_MASKED = "__feedlake_masked"

# Each kind with its pattern, the first that fits a place wins. No pattern starts or
# ends within a word or number.
_EDGE, _END = "(?<![A-Za-z0-9])", "(?![A-Za-z0-9])"
PATTERNS = {
    "email": "(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}+@[A-Za-z0-9-]{1,63}(?:\\.[A-Za-z0-9-]{1,63}){1,8}",
    "key": _EDGE + "(?:AKIA|ASIA)[A-Z0-9]{16}" + _END,
    "token": _EDGE + "(?:[0-9a-f]{32,64}|[0-9A-F]{32,64})" + _END,
    "iban": _EDGE + "[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _END,
    "ip": "(?<![A-Za-z0-9.])[0-9]{1,3}(?:\\.[0-9]{1,3}){3}(?![0-9A-Za-z]|\\.[0-9])",
    "iso_date": _EDGE + "[12][0-9]{3}[-/][01][0-9][-/][0-3][0-9](?!-?[0-9])",
    "day_date": _EDGE + "[0-3]?[0-9][./][0-3]?[0-9][./][12][0-9]{3}(?![0-9])",
    "ssn": _EDGE + "[0-9]{3}-[0-9]{2}-[0-9]{4}(?!-?[0-9A-Za-z])",
    "card": _EDGE + "[0-9](?:[ -]?[0-9]){12,18}" + _END,
    "phone": "(?<![A-Za-z0-9])(?:\\+[0-9]{1,3}[ .-]?)?(?:\\([0-9]{3}\\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
    + _END + "|(?<![A-Za-z0-9])\\+[0-9]{1,3}(?:[ .-]?[0-9]){7,12}" + _END,
}
# Cards and IBANs are searched for as the very values that are valid: their patterns also take
# numbers and words next to them, and a reading that fails must not hide a shorter one.
CARD_LENGTHS = range(19, 12, -1)
DIGIT_RUN = _EDGE + "[0-9][0-9 -]{12,}+[A-Za-z]?"
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC",
    32: "LC", 33: "RU",
}


def _iban_reading(length: int) -> str:
    groups, rest = divmod(length - 4, 4)
    tail = f" ?[A-Z0-9]{{{rest}}}" if rest else ""
    return f"(?:{'|'.join(IBAN_LENGTHS[length].split())})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}{tail}"


IBAN_READING = f"{_EDGE}(?=[A-Z]{{2}}[0-9]{{2}})(?=({'|'.join(f'{_iban_reading(n)}{_END}' for n in IBAN_LENGTHS)}))"


def _digest(key: str, kind: str, turn: Column, half: Column) -> Column:
    """60 keyed pseudo-random bits; the key stands on both sides of what it hides."""
    text = F.concat(F.lit(f"{key}|{kind}|"), turn, F.lit("|"), half, F.lit(f"|{key}"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 15), 16, 10).cast("long")


def feistel(left: Column, right: Column, n_left: Column, n_right: Column, key: str, kind: str) -> Column:
    """Struct (l, r): `left` below n_left and `right` below n_right, permuted as a pair.

    Even rounds change the left half by the right one, odd rounds the other way round.
    """

    def round_(s: Column, i: Column) -> Column:
        return F.when(
            i % 2 == 0,
            F.struct(((s["l"] + _digest(key, kind, i, s["r"]) % n_left) % n_left).alias("l"), s["r"].alias("r")),
        ).otherwise(
            F.struct(s["l"].alias("l"), ((s["r"] + _digest(key, kind, i, s["l"]) % n_right) % n_right).alias("r"))
        )

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), start, round_)


def _power(radix: int, exponent: Column) -> Column:
    return F.get(F.lit([radix**i for i in range(MAX_HALF[radix] + 1)]).cast("array<long>"), exponent)


def permute_text(value: Column, radix: int, key: str, kind: str) -> Column:
    """A string of digits of the radix, permuted among those of its length.

    One of a single digit is shifted by a keyed amount; a long one is permuted
    in pieces, each with the piece before it in its digest.
    """
    size = 2 * MAX_HALF[radix]

    def number(s: Column) -> Column:
        return F.conv(F.when(s == "", F.lit("0")).otherwise(s), radix, 10).cast("long")

    def text(n: Column, width: Column) -> Column:
        digits = F.lower(F.conv(n.cast("string"), 10, radix))
        return F.when(width == 0, F.lit("")).otherwise(F.lpad(digits, width, "0"))

    def piece(p: Column) -> Column:
        a = F.floor(F.length(p) / 2).cast("int")
        b = F.length(p) - a
        return let(
            feistel(
                number(F.substring(p, F.lit(1), a)), number(F.substring(p, a + 1, b)),
                _power(radix, a), _power(radix, b), key, kind,
            ),
            lambda s: F.concat(text(s["l"], a), text(s["r"], b)),
        )

    def pieces(v: Column) -> Column:
        return F.array_join(
            F.transform(
                F.sequence(F.lit(0), F.floor((F.length(v) - 1) / size).cast("int")),
                lambda i: piece(F.substring(v, i * size + 1, F.lit(size))),
            ),
            "",
        )

    return let(value, lambda v: F.when(F.length(v) == 0, v).otherwise(pieces(v)))


def _only(text: Column, keep: str) -> Column:
    return F.regexp_replace(text, f"[^{keep}]", "")


def _refill(shape: Column, filling: Column, kind: str) -> Column:
    """`shape` with its characters of a kind replaced, in order, by those of `filling`."""

    def replaced(both: Column) -> Column:
        s, f = both["s"], both["f"]
        return F.array_join(
            F.transform(
                F.sequence(F.lit(1), F.length(s)),
                lambda i: let(
                    F.substring(s, i, F.lit(1)),
                    lambda c: F.when(
                        c.rlike(f"[{kind}]"),
                        F.substring(f, F.length(_only(F.substring(s, F.lit(1), i), kind)), F.lit(1)),
                    ).otherwise(c),
                ),
            ),
            "",
        )

    return let(F.struct(shape.alias("s"), filling.alias("f")), replaced)


def _luhn_sum(digits: Column, doubled: int) -> Column:
    """Sum of digits from the right, every second one doubled, from the first if `doubled` is 0."""
    values = F.transform(F.split(F.reverse(digits), ""), lambda d: F.coalesce(d.try_cast("int"), F.lit(0)))
    return F.aggregate(
        F.transform(
            values,
            lambda d, i: F.when(i % 2 == doubled, F.when(d > 4, 2 * d - 9).otherwise(2 * d)).otherwise(d),
        ),
        F.lit(0),
        lambda a, d: a + d,
    )


def _card_valid(m: Column) -> Column:
    return let(_only(m, "0-9"), lambda d: _luhn_sum(d, 1) % 10 == 0)


def _iban_valid(m: Column) -> Column:
    return let(_only(m, "0-9A-Z"), lambda d: _iban_rest(d) == 1)


def _cards_in(text: Column) -> Column:
    """All valid card numbers that begin and end with a group of digits, longer ones first."""

    def readings(runs: Column) -> Column:
        return F.concat(
            *[
                F.regexp_extract_all(
                    runs, F.lit(f"{_EDGE}(?=([0-9](?:[ -]?[0-9]){{{n - 1}}}){_END})"), F.lit(1)
                )
                for n in CARD_LENGTHS
            ]
        )

    runs = F.regexp_extract_all(text, F.lit(DIGIT_RUN), F.lit(0))
    return let(
        runs,
        lambda r: F.when(
            F.size(r) > 0, F.filter(F.array_distinct(readings(F.array_join(r, "\n"))), _card_valid)
        ).otherwise(F.array().cast("array<string>")),
    )


def _ibans_in(text: Column) -> Column:
    """All valid IBANs: those of their country's length, then those the whole pattern takes."""
    known = F.regexp_extract_all(text, F.lit(IBAN_READING), F.lit(1))
    whole = F.regexp_extract_all(text, F.lit(PATTERNS["iban"]), F.lit(0))
    return F.filter(F.array_distinct(F.concat(known, whole)), _iban_valid)


def _pattern(text: Column) -> Column:
    """The pattern of all kinds, where cards and IBANs stand as the valid values of this text."""

    def values(found: Column, begin: str) -> Column:
        some = F.concat(F.lit(f"{_EDGE}(?={begin})(?:"), F.array_join(found, "|"), F.lit(f"){_END}"))
        return F.when(F.size(found) > 0, some).otherwise(F.lit("(?!)"))

    parts = [
        let(_cards_in(text), lambda f: values(f, "[0-9]")) if kind == "card"
        else let(_ibans_in(text), lambda f: values(f, "[A-Z]")) if kind == "iban"
        else F.lit(f"(?:{p})")
        for kind, p in PATTERNS.items()
    ]
    return F.concat_ws("|", *parts)


def _card(m: Column, key: str) -> Column:
    def changed(d: Column) -> Column:
        body = permute_text(F.substring(d, F.lit(1), F.length(d) - 1), 10, key, "card")
        return let(
            body,
            lambda b: _refill(
                m, F.concat(b, ((10 - _luhn_sum(b, 0) % 10) % 10).cast("string")), "0-9"
            ),
        )

    return let(_only(m, "0-9"), lambda d: F.when(_luhn_sum(d, 1) % 10 == 0, changed(d)))


def _iban_rest(text: Column) -> Column:
    """The remainder by 97 of an IBAN written from its country's part on."""
    moved = F.concat(F.substring(text, F.lit(5), F.length(text)), F.substring(text, 1, 4))
    return F.aggregate(
        F.transform(F.split(moved, ""), lambda c: F.conv(c, 36, 10).cast("int")),
        F.lit(0),
        lambda a, v: F.when(v > 9, (a * 100 + v) % 97).otherwise((a * 10 + v) % 97),
    )


def _iban(m: Column, key: str) -> Column:
    def changed(d: Column) -> Column:
        account = F.substring(d, F.lit(5), F.length(d))
        body = _refill(account, permute_text(_only(account, "0-9"), 10, key, "iban"), "0-9")
        return let(
            F.concat(F.substring(d, 1, 2), F.lit("00"), body),
            lambda z: _refill(
                m,
                F.concat(
                    F.substring(d, 1, 2),
                    F.lpad((98 - _iban_rest(z)).cast("string"), 2, "0"),
                    F.substring(z, F.lit(5), F.length(z)),
                ),
                "0-9A-Z",
            ),
        )

    return let(_only(m, "0-9A-Z"), lambda d: F.when(_iban_rest(d) == 1, changed(d)))


def _ip(m: Column, key: str) -> Column:
    def octet(n: Column) -> Column:
        return F.concat(F.floor(n / 256).cast("string"), F.lit("."), (n % 256).cast("string"))

    def changed(p: Column) -> Column:
        state = feistel(
            p[0] * 256 + p[1], p[2] * 256 + p[3], F.lit(65536), F.lit(65536), key, "ip"
        )
        return let(state, lambda s: F.concat(octet(s["l"]), F.lit("."), octet(s["r"])))

    parts = F.transform(F.split(m, "\\."), lambda x: x.cast("int"))
    return let(parts, lambda p: F.when(~F.exists(p, lambda x: x > 255), changed(p)))


def _ssn(m: Column, key: str) -> Column:
    """Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999."""

    def changed(p: Column) -> Column:
        area = p[0] - F.when(p[0] > 666, 2).otherwise(1)
        state = feistel(area * 99 + p[1] - 1, p[2] - 1, F.lit(898 * 99), F.lit(9999), key, "ssn")
        return let(
            state,
            lambda s: let(
                F.floor(s["l"] / 99).cast("int"),
                lambda a: F.concat_ws(
                    "-",
                    F.lpad((a + F.when(a >= 665, 2).otherwise(1)).cast("string"), 3, "0"),
                    F.lpad((s["l"] % 99 + 1).cast("string"), 2, "0"),
                    F.lpad((s["r"] + 1).cast("string"), 4, "0"),
                ),
            ),
        )

    valid = lambda p: p[0].between(1, 899) & (p[0] != 666) & (p[1] > 0) & (p[2] > 0)
    parts = F.transform(F.split(m, "-"), lambda x: x.cast("int"))
    return let(parts, lambda p: F.when(valid(p), changed(p)))


def _phone(m: Column, key: str) -> Column:
    """The country code stays, the rest is permuted; +1 numbers keep first digits 2 to 9."""

    def american(d: Column) -> Column:
        part = lambda at, n: F.substring(d, at, n).cast("long")
        state = feistel(
            part(1, 3) - 200, (part(4, 3) - 200) * 10_000 + part(7, 4),
            F.lit(800), F.lit(8_000_000), key, "phone",
        )
        return let(
            state,
            lambda s: F.concat(
                (s["l"] + 200).cast("string"),
                (F.floor(s["r"] / 10_000) + 200).cast("string"),
                F.lpad((s["r"] % 10_000).cast("string"), 4, "0"),
            ),
        )

    def changed(d: Column) -> Column:
        return F.when(d.rlike("^[2-9][0-9]{2}[2-9][0-9]{6}$"), american(d)).otherwise(
            permute_text(d, 10, key, "phone_other")
        )

    code = F.regexp_extract(m, "^\\+[0-9]{1,3}(?=[ .(-])|^\\+[0-9]", 0)
    return let(
        code,
        lambda c: F.concat(
            c,
            let(
                F.substring(m, F.length(c) + 1, F.length(m)),
                lambda rest: _refill(rest, let(_only(rest, "0-9"), changed), "0-9"),
            ),
        ),
    )


def _days(day: Column, key: str) -> Column:
    """A date, permuted within its 400 years."""
    small, large = CYCLE_DAYS
    n = F.datediff(day, F.to_date(F.lit(CYCLE_START)))
    total = small * large
    within = F.pmod(n, F.lit(total))
    state = feistel(F.floor(within / large), within % large, F.lit(small), F.lit(large), key, "date")
    return let(
        state,
        lambda s: F.date_add(
            F.to_date(F.lit(CYCLE_START)), (n - within + s["l"] * large + s["r"]).cast("int")
        ),
    )


def _iso_date(m: Column, key: str) -> Column:
    day = F.try_to_date(F.regexp_replace(m, "/", "-"), "yyyy-MM-dd")
    return let(
        day,
        lambda d: F.when(
            d.isNotNull(),
            _refill(m, F.date_format(_days(d, key), "yyyyMMdd"), "0-9"),
        ),
    )


def _day_date(m: Column, key: str) -> Column:
    """Day first, or month first where only that is a date; written with two digits each."""

    def changed(p: Column) -> Column:
        day_first = F.try_to_date(F.concat_ws("-", p[2], p[1], p[0]), "yyyy-M-d")
        month_first = F.try_to_date(F.concat_ws("-", p[2], p[0], p[1]), "yyyy-M-d")
        mark = F.regexp_extract(m, "[./]", 0)

        def written(first: str, second: str) -> Callable[[Column], Column]:
            return lambda day: F.when(
                day.isNotNull(),
                let(
                    _days(day, key),
                    lambda d: F.concat(
                        F.date_format(d, first), mark, F.date_format(d, second), mark, F.date_format(d, "yyyy")
                    ),
                ),
            )

        return F.coalesce(let(day_first, written("dd", "MM")), let(month_first, written("MM", "dd")))

    return let(F.split(m, "[./]"), changed)


def _email(m: Column, key: str) -> Column:
    """Letters and digits of the local part and of the domain but its last label."""

    def run(text: Column, kind: str) -> Column:
        return let(
            text, lambda t: _refill(t, permute_text(_only(t, "a-z0-9"), 36, key, kind), "a-z0-9")
        )

    def changed(low: Column) -> Column:
        last = F.substring_index(low, ".", -1)
        front = F.substring_index(F.substring(low, F.lit(1), F.length(low) - F.length(last)), "@", -1)
        return F.concat(run(F.substring_index(low, "@", 1), "email"), F.lit("@"), run(front, "host"), last)

    return let(F.lower(m), changed)


def _key(m: Column, key: str) -> Column:
    return F.concat(
        F.substring(m, 1, 4),
        F.upper(permute_text(F.lower(F.substring(m, F.lit(5), F.length(m))), 36, key, "key")),
    )


def _token(m: Column, key: str) -> Column:
    """Hexadecimal digits; numbers without a letter are left to the other kinds."""
    new = permute_text(F.lower(m), 16, key, "token")
    return F.when(m.rlike("[a-f]"), new).when(m.rlike("[A-F]"), F.upper(new))


_PERMUTED = {
    "email": _email, "key": _key, "token": _token, "iban": _iban, "ip": _ip, "iso_date": _iso_date,
    "day_date": _day_date, "ssn": _ssn, "card": _card, "phone": _phone,
}


def pseudonym(match: Column, key: str) -> Column:
    """The pseudonym of one match, or the match itself where validation fails."""
    return F.coalesce(
        *[
            F.when(match.rlike(f"^(?:{PATTERNS[kind]})$"), permuted(match, key))
            for kind, permuted in _PERMUTED.items()
        ],
        match,
    )


def mask_text(text: Column, key: str) -> Column:
    """Struct (text, n): the text with pseudonyms, and how many matches were replaced."""

    def joined(found: Column, pattern: Column) -> Column:
        return let(
            F.transform(found, lambda m: pseudonym(m, key)),
            lambda new: F.struct(
                F.array_join(
                    F.flatten(
                        F.transform(
                            F.split(text, pattern, -1),
                            lambda part, i: F.array(part, F.coalesce(F.get(new, i), F.lit(""))),
                        )
                    ),
                    "",
                ).alias("text"),
                F.size(F.filter(F.zip_with(found, new, lambda a, b: a != b), lambda x: x))
                .cast("long").alias("n"),
            ),
        )

    nothing = F.struct(text.alias("text"), F.lit(0).cast("long").alias("n"))
    # Every kind holds a digit or an at sign; texts without either are not searched.
    return F.when(
        text.rlike("[0-9@]"),
        let(
            _pattern(text),
            lambda pattern: let(
                F.regexp_extract_all(text, pattern, F.lit(0)),
                lambda found: F.when(F.size(found) > 0, joined(found, pattern)).otherwise(nothing),
            ),
        ),
    ).otherwise(nothing)


def pseudonymize(
    docs: DataFrame, key: str, text_col: str = "text", count_col: str | None = None
) -> DataFrame:
    """All rows and columns, with the text's personal data replaced by pseudonyms.

    `count_col` names a further column with the number of replaced values. A null
    text stays null and has none; numbers and dates that are not valid in their
    format stay as they are. Lengths do not change, except that the parts of an IP
    address have one to three digits and that days and months get two. Rows are
    treated one by one.
    """
    masked = docs.select("*", F.explode(F.array(mask_text(F.col(f"`{text_col}`"), key))).alias(_MASKED))
    columns = [
        F.col(f"{_MASKED}.text").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns
    ]
    if count_col:
        columns.append(F.col(f"{_MASKED}.n").alias(count_col))
    return masked.select(*columns)
