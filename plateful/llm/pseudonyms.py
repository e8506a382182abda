"""Format-preserving pseudonyms for personal data, by a keyed Feistel network in SQL functions.

Numbers, dates and addresses that pass their check are replaced by others of the same format
that pass it too: a card number keeps its length, its separators and a right check digit, a date
stays a date in the same notation. The replacement is a permutation of all values of the format
under a key, so equal values stay equal in all documents, different ones stay different,
and nothing is collected or joined. What fails its check (a 16-digit number without a right
check digit, 31 February) is not personal data of that kind and stays as it is; what else stands in
a match for an account number is looked for again.

A value is an array of numbers, each below its own radix. Ten rounds shift the numbers of one
half, modulo their radix, by a keyed hash of the other half.

The key comes as the result of a one-row query and is not part of any plan's text. Of a telephone number
only the national digits are permuted: the country code and a bracketed trunk zero stay, so all ways to write
a number get the same national digits.

Defined results: a NULL or empty text stays as it is; a very long text is searched whole; rows that repeat are
treated alike; an empty table gives an empty result; other columns are kept whatever their names.
"""

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

ROUNDS = 10
KINDS = ["email", "iban", "card", "phone", "ssn", "ip", "date"]

_CARD = r"\d{13,19}|\d{4}(?:[ -]\d{4}){2}[ -]\d{1,7}|\d{4}[ -]\d{6}[ -]\d{5}"
# National digits where a country has one number of them; elsewhere a number is as long as it goes on, up to 15 digits.
_PHONE_DIGITS = {8: "45|47|65", 9: "27|31|33|34|41|48|61|351|353|420|421|971|972", 10: "1|7|20|30|44|52|57|90|91|92", 11: "86"}
# International codes, none of which begins another: one digit, these of two digits, and all else three.
_COUNTRY = r"^(?:[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
_TRUNK = "(0)"
_PHONE = "|".join([
    r"\+\d{1,3}[ .-]?\(?\d{2,4}\)?[ .-]?\d{3}[ .-]?\d{4}|\(\d{3}\) ?\d{3}-\d{4}|\d{3}-\d{3}-\d{4}",
    *[rf"\+(?:{codes})(?:[ .-]?\(0\))?(?:[ .-]?\(?\d\)?){{{n}}}" for n, codes in _PHONE_DIGITS.items()],
    r"\+\d(?:[ .-]?\(?\d\)?){8,14}"])
_SSN = r"\d{3}-\d{2}-\d{4}"
_IP = r"\d{1,3}(?:\.\d{1,3}){3}"
_DATE = r"\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4}"
# Countries by the length of their account numbers. Others are matched as far as they go and cut where the check holds.
_IBAN_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}


def _iban_of(size: int, countries: str) -> str:
    groups, rest = divmod(size - 4, 4)
    spaced = rf"(?: [A-Z0-9]{{4}}){{{groups}}}" + (rf" [A-Z0-9]{{{rest}}}" if rest else "")
    return rf"(?:{countries.replace(' ', '|')})\d{{2}}(?:[A-Z0-9]{{{size - 4}}}|{spaced})"


_IBAN = (r"(?=[A-Z]{2}\d{2}[A-Z0-9 ])(?:" + "|".join(_iban_of(*c) for c in _IBAN_COUNTRIES.items())
         + r"|[A-Z]{2}\d{2}(?:[A-Z0-9]{11,30}|(?: [A-Z0-9]{4}){2,7}(?: [A-Z0-9]{1,3})?))")
_EMAIL = r"[\p{L}\p{N}._%+-]++@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}"


def _personal(*kinds: str) -> str:
    return (rf"(?<![\p{{L}}\p{{N}}._%+-]){_EMAIL}|(?<![\p{{L}}\p{{N}}+.-])(?:{'|'.join(kinds)})"
            r"(?![\p{L}\p{N}]|[.-]\d)")


PERSONAL = _personal(_IBAN, _DATE, _SSN, _PHONE, _CARD, _IP)
# What may stand in a match for an account number that is none.
NO_IBAN = _personal(_DATE, _SSN, _PHONE, _CARD, _IP)

# A 400-year cycle of the calendar has 189 * 773 days, so dates permute without a gap.
_FIRST_DAY, _DATE_RADICES = "1800-01-01", (189, 773)


def _chars(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0))


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _numbers(digits: Column) -> Column:
    return F.transform(_chars(digits), lambda c: c.cast("long"))


def secret(spark: SparkSession, key: str) -> Column:
    """``key`` as a scalar query over local data, whose plan does not show it."""
    return spark.createDataFrame(pa.table({"secret": [key]})).scalar()


def feistel(values: Column, radices: Column, half: Column, tweak: str, key: Column) -> Column:
    """``values`` (array of bigint, each below its radix) under the keyed permutation."""
    def shifted(own, own_radices, other, turn):
        said = F.array_join(other.cast("array<string>"), ",")

        def shift(value, i):
            drawn = F.sha2(F.concat_ws("|", key, F.lit(tweak), turn.cast("string"), i.cast("string"), said), 256)
            return (value + F.conv(F.substr(drawn, F.lit(1), F.lit(15)), 16, 10).cast("long")) % F.get(own_radices, i)

        return F.transform(own, shift)

    rest = F.size(values) - half
    left_radices, right_radices = F.slice(radices, F.lit(1), half), F.slice(radices, half + 1, rest)

    def step(state, turn):
        return F.when(turn % 2 == 1, F.struct(
            shifted(state["left"], left_radices, state["right"], turn).alias("left"), state["right"].alias("right"))
        ).otherwise(F.struct(
            state["left"].alias("left"), shifted(state["right"], right_radices, state["left"], turn).alias("right")))

    start = F.struct(F.slice(values, F.lit(1), half).alias("left"), F.slice(values, half + 1, rest).alias("right"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step,
                       lambda s: F.concat(s["left"], s["right"]))


def _half(values: Column) -> Column:
    return F.floor(F.size(values) / 2).cast("int")


def _longs(*numbers: int) -> Column:
    return F.array(*[F.lit(n).cast("long") for n in numbers])


def _permuted_digits(digits: Column, tweak: str, key: Column) -> Column:
    values = _numbers(digits)
    ten = F.transform(values, lambda _: F.lit(10).cast("long"))
    return F.array_join(feistel(values, ten, _half(values), tweak, key).cast("array<string>"), "")


def _permuted_text(text: Column, tweak: str, key: Column) -> Column:
    """Digits become digits, small letters small and capitals capital; anything else stays."""
    chars = _chars(text)
    kinds = F.transform(chars, lambda c: F.when(c.between("0", "9"), 48).when(c.between("a", "z"), 97)
                        .when(c.between("A", "Z"), 65).otherwise(0).cast("long"))
    radices = F.transform(kinds, lambda k: F.when(k == 48, 10).when(k > 0, 26).otherwise(1).cast("long"))
    values = F.zip_with(chars, kinds, lambda c, k: F.when(k > 0, F.ascii(c) - k).otherwise(0).cast("long"))
    moved = F.zip_with(kinds, feistel(values, radices, _half(values), tweak, key),
                       lambda k, v: F.when(k > 0, F.char(k + v)))
    return F.array_join(F.zip_with(chars, moved, lambda c, m: F.coalesce(m, c)), "")


def _into(template: Column, signs: Column, pattern: str = "[0-9]") -> Column:
    """``template`` with its signs of ``pattern``, digits if not said, replaced in turn by ``signs``, of the same number."""
    chars = _chars(template)

    def place(c, i):
        nth = F.size(F.filter(F.slice(chars, F.lit(1), i + 1), lambda x: x.rlike(pattern)))
        return F.when(c.rlike(pattern), F.substr(signs, nth, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(chars, place), "")


def _luhn_sum(digits: Column) -> Column:
    """Sum of the digits from the right, every second one doubled and cast out, the last one single."""
    def term(d, i):
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.transform(F.reverse(_numbers(digits)), term), F.lit(0).cast("long"), lambda a, d: a + d)


def _mod97(text: Column) -> Column:
    """Remainder by 97 of a text whose letters stand for 10 to 35."""
    def add(rest, c):
        return (F.when(c.between("0", "9"), rest * 10 + c.cast("long"))
                .otherwise(rest * 100 + F.ascii(c) - 55)) % 97

    return F.aggregate(_chars(text), F.lit(0).cast("long"), add)


def _card(m: Column, key: Column) -> Column:
    digits = _digits(m)
    payload = _permuted_digits(F.substr(digits, F.lit(1), F.length(digits) - 1), "card", key)
    check = (10 - _luhn_sum(F.concat(payload, F.lit("0"))) % 10) % 10
    return F.when(_luhn_sum(digits) % 10 == 0, _into(m, F.concat(payload, check.cast("string"))))


def _phone(m: Column, key: Column) -> Column:
    trunk = F.lit(_TRUNK)
    international = m.startswith("+")
    # The trunk zero of an international number is not part of it; a sign that is no digit keeps its place.
    form = F.when(international, F.replace(m, trunk, F.lit("()"))).otherwise(m)
    digits = _digits(form)
    country = F.when(international, F.regexp_extract(digits, _COUNTRY, 0)).otherwise("")
    national = F.substr(digits, F.length(country) + 1, F.length(digits))
    shown = _into(form, F.concat(country, _permuted_digits(national, "phone", key)))
    return F.when(F.length(digits).between(9, 15), F.when(international, F.replace(shown, F.lit("()"), trunk)).otherwise(shown))


def _ssn(m: Column, key: Column) -> Column:
    area, group, serial = [F.split(m, "-")[i].cast("long") for i in range(3)]
    # Areas 001 to 899 without 666.
    values = F.array(area - F.when(area > 666, 2).otherwise(1), group - 1, serial - 1)
    moved = feistel(values, _longs(898, 99, 9999), F.lit(1), "ssn", key)
    shown = F.transform(moved, lambda v, i: F.when(
        i == 0, F.lpad((v + F.when(v >= 665, 2).otherwise(1)).cast("string"), 3, "0"))
        .when(i == 1, F.lpad((v + 1).cast("string"), 2, "0")).otherwise(F.lpad((v + 1).cast("string"), 4, "0")))
    valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
    return F.when(valid, F.array_join(shown, "-"))


def _ip(m: Column, key: Column) -> Column:
    values = F.split(m, r"\.").cast("array<bigint>")
    moved = feistel(values, _longs(256, 256, 256, 256), F.lit(2), "ip", key)
    return F.when(F.forall(values, lambda v: v < 256), F.array_join(moved.cast("array<string>"), "."))


def _date(m: Column, key: Column) -> Column:
    def shown(notation):
        day = F.try_to_timestamp(m, F.lit(notation)).cast("date")
        number = F.datediff(day, F.lit(_FIRST_DAY).cast("date")).cast("long")
        b = F.lit(_DATE_RADICES[1]).cast("long")
        moved = feistel(F.array(F.floor(number / b), number % b), _longs(*_DATE_RADICES), F.lit(1), "date", key)
        days = F.aggregate(moved, F.lit(0).cast("long"), lambda a, v: a * b + v)
        known = number.between(0, _DATE_RADICES[0] * _DATE_RADICES[1] - 1)
        return F.when(known, F.date_format(F.date_add(F.lit(_FIRST_DAY).cast("date"), days.cast("int")), notation))

    return (F.when(m.contains("-"), shown("yyyy-MM-dd")).when(m.contains("."), shown("dd.MM.yyyy"))
            .otherwise(F.coalesce(shown("dd/MM/yyyy"), shown("MM/dd/yyyy"))))


def _iban_holds(m: Column) -> Column:
    plain = F.replace(m, F.lit(" "), F.lit(""))
    return _mod97(F.concat(F.substr(plain, F.lit(5), F.length(plain)), F.substr(plain, F.lit(1), F.lit(4)))) == 1


def _iban(m: Column, key: Column) -> Column:
    """The account is permuted without its spaces, so both forms of a number get the same one."""
    plain = F.replace(m, F.lit(" "), F.lit(""))
    country = F.substr(plain, F.lit(1), F.lit(2))
    moved = _permuted_text(F.substr(plain, F.lit(5), F.length(plain)), "iban", key)
    check = F.lpad((98 - _mod97(F.concat(moved, country, F.lit("00")))).cast("string"), 2, "0")
    return F.when(_iban_holds(m), F.concat(country, check, _into(F.substr(m, F.lit(5), F.length(m)), moved, "[^ ]")))


def _iban_size(m: Column) -> Column:
    """How much of a match for an account number is one; 0 if nothing. Groups after a number of unknown length are cut off."""
    groups = F.split(m, " ")

    def first(n):
        return F.array_join(F.slice(groups, F.lit(1), n), " ")

    known = m.rlike("^(?:" + "|".join(_IBAN_COUNTRIES.values()).replace(" ", "|") + ")")
    ends = F.filter(F.sequence(F.size(groups), F.lit(1)), lambda n: (F.length(F.replace(first(n), F.lit(" "), F.lit(""))) > 14)
                    & _iban_holds(first(n)))
    return (F.when(_iban_holds(m), F.length(m))
            .when(~known & (F.size(ends) > 0), F.length(first(F.get(ends, F.lit(0))))).otherwise(0))


def _email(m: Column, key: Column) -> Column:
    """The name and the hosts before the last two labels are permuted; the domain stays."""
    domain = F.regexp_extract(m, r"[@.]([A-Za-z0-9-]+\.[A-Za-z]+)$", 1)
    own = F.substr(m, F.lit(1), F.length(m) - F.length(domain))
    return F.concat(_permuted_text(own, "email", key), domain)


def kind_of(m: Column) -> Column:
    def whole(pattern):
        return m.rlike(f"^(?:{pattern})$")

    return (F.when(m.contains("@"), "email").when(whole(_DATE), "date").when(whole(_SSN), "ssn")
            .when(whole(_PHONE), "phone").when(whole(_CARD), "card").when(whole(_IP), "ip").otherwise("iban"))


def pseudonym(m: Column, key: Column) -> Column:
    """The replacement of one match; NULL if it fails the check of its kind."""
    by_kind = {"email": _email, "iban": _iban, "card": _card, "phone": _phone, "ssn": _ssn, "ip": _ip, "date": _date}
    kind, found = kind_of(m), None
    for name in KINDS:
        value = by_kind[name](m, key)
        found = F.when(kind == name, value) if found is None else found.when(kind == name, value)
    return found


def replacements(text: Column, key: Column) -> Column:
    """Array of (before, kind, match, value): the text cut at its matches; those without a match hold text only."""
    def cut(own, pattern):
        return F.zip_with(F.split(own, pattern, -1), F.regexp_extract_all(own, F.lit(pattern), F.lit(0)),
                          lambda before, m: F.struct(before.alias("before"), m.alias("match")))

    def without_false_ibans(p):
        m, size = p["match"], _iban_size(p["match"])
        own = F.struct(p["before"].alias("before"), F.when(size > 0, F.substr(m, F.lit(1), size)).alias("match"))
        split = F.concat(F.array(own), cut(F.substr(m, size + 1, F.length(m)), NO_IBAN))
        return F.when(m.isNotNull() & (kind_of(m) == "iban") & (size < F.length(m)), split).otherwise(F.array(p))

    def part(p):
        m = p["match"]
        return F.struct(p["before"].alias("before"), kind_of(m).alias("kind"), m.alias("match"),
                        F.when(m.isNotNull(), pseudonym(m, key)).alias("value"))

    return F.transform(F.flatten(F.transform(cut(text, PERSONAL), without_false_ibans)), part)


def with_pseudonyms(rows: DataFrame, key: str, counts: bool = False) -> DataFrame:
    """``rows`` (..., text) with personal data replaced, and with the number replaced per kind if wanted."""
    rows = rows.withColumn("_secret", secret(rows.sparkSession, key))
    parts = F.when(F.col("text").rlike(PERSONAL), replacements(F.col("text"), F.col("_secret")))
    replaced = F.array_join(F.transform("_parts", lambda p: F.concat(
        p["before"], F.coalesce(p["value"], p["match"], F.lit("")))), "")
    done = (rows.withColumn("_parts", parts)
            .withColumn("text", F.when(F.col("_parts").isNull(), F.col("text")).otherwise(replaced)))
    if counts:
        done = done.withColumns({f"n_{k}": F.coalesce(F.size(F.filter(
            "_parts", lambda p: (p["kind"] == k) & p["value"].isNotNull())), F.lit(0)).cast("long") for k in KINDS})
    return done.drop("_parts", "_secret")


def pseudonym_report(docs: DataFrame, key: str) -> DataFrame:
    """Per document: doc_id, text, and how many values of each kind were replaced."""
    return with_pseudonyms(docs.select("doc_id", "text"), key, counts=True)


def pseudonymous_documents(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with pseudonyms in its text and all other columns as they are (n_chars holds, formats keep length or nearly so)."""
    rows = docs.select(F.struct("*").alias("_row"), "text")
    return with_pseudonyms(rows, key).select(F.col("_row").withField("text", F.col("text")).alias("_row")).select("_row.*")
