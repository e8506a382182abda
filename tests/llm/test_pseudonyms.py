import hashlib
import re
from datetime import date

import pytest

from pyspark.sql import functions as F

from plateful.llm import pseudonyms, queries
from tests.llm.cases import SCHEMA, clashing, frame, prose, rows

KEY = "k1"


def luhn(digits):
    values = [int(d) for d in reversed(digits)]
    return sum(v if i % 2 == 0 else 2 * v - 9 * (v > 4) for i, v in enumerate(values)) % 10


def plain_feistel(values, radices, half, tweak, key=KEY):
    left, right = list(values[:half]), list(values[half:])
    for turn in range(1, pseudonyms.ROUNDS + 1):
        own, other, base = (left, right, radices[:half]) if turn % 2 else (right, left, radices[half:])
        said = ",".join(map(str, other))
        own[:] = [(v + int(hashlib.sha256(f"{key}|{tweak}|{turn}|{i}|{said}".encode()).hexdigest()[:15], 16)) % base[i]
                  for i, v in enumerate(own)]
    return left + right


def report(spark, *texts, key=KEY):
    docs = frame(spark, [(i, t, None, None, None) for i, t in enumerate(texts)])
    return [r["text"] for r in pseudonyms.pseudonym_report(docs, key).orderBy("doc_id").collect()]


def test_values_match_plain_form(spark):
    card, ip, day = report(spark, "4111111111111111", "192.0.2.77", "2024-02-29")
    payload = plain_feistel([int(d) for d in "411111111111111"], [10] * 15, 7, "card")
    assert card[:-1] == "".join(map(str, payload)) and luhn(card) == 0
    assert ip == ".".join(map(str, plain_feistel([192, 0, 2, 77], [256] * 4, 2, "ip")))
    number = date(2024, 2, 29).toordinal() - date(1800, 1, 1).toordinal()
    a, b = plain_feistel(divmod(number, 773), [189, 773], 1, "date")
    assert day == date.fromordinal(date(1800, 1, 1).toordinal() + a * 773 + b).isoformat()


def test_small_spaces_are_permuted(spark):
    found = report(spark, *[f"call 212-555-0{i:03d}" for i in range(300)])
    assert len(set(found)) == 300 and all(re.fullmatch(r"call \d{3}-\d{3}-\d{4}", f) for f in found)
    found = report(spark, *[f"x {area:03d}-{group:02d}-0001 y" for area in (1, 665, 667, 899) for group in range(1, 40)])
    assert len(set(found)) == 156
    assert all(re.fullmatch(r"x (?!000|666|9)\d{3}-(?!00)\d{2}-(?!0000)\d{4} y", f) for f in found)


@pytest.mark.parametrize("text, form", [
    ("a 4111-1111-1111-1111, b", r"a \d{4}-\d{4}-\d{4}-\d{4}, b"),
    ("(31/12/1999)", r"\(\d\d/\d\d/\d{4}\)"),
    ("DE89370400440532013000.", r"DE\d{20}\."),
    ("GB29 NWBK 6016 1331 9268 19", r"GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d"),
    ("+1 (017) 555-7713%%%", r"\+1 \(\d{3}\) \d{3}-\d{4}%%%"),
    ("to jane.DOE7@mail9.example.com!", r"to [a-z]{4}\.[A-Z]{3}\d@[a-z]{4}\d\.example\.com!"),
    ("2353820953013749 4550997810720808", r"2353820953013749 \d{16}"),
])
def test_formats_stay(spark, text, form):
    found, = report(spark, text)
    assert re.fullmatch(form, found) and found != text


@pytest.mark.parametrize("text, form", [
    ("ES91 2100 0418 4502 0005 1332 BIC", r"ES\d\d( \d{4}){5} BIC"),
    ("NO93 8601 1117 947 AB 12", r"NO\d\d \d{4} \d{4} \d{3} AB 12"),
    ("DE89 3704 0044 0532 0130 00 X1 and", r"DE\d\d( \d{4}){4} \d\d X1 and"),
    ("+44 20 7946 0958", r"\+44 \d\d \d{4} \d{4}"),
    ("+33 6 12 34 56 78 2024", r"\+33 \d( \d\d){4} 2024"),
    ("+44 (0)20 7946 0958.", r"\+44 \(\d\)\d\d \d{4} \d{4}\."),
    ("+49 151 23456789, x", r"\+49 \d{3} \d{8}, x"),
    ("+358 9 1234 5678", r"\+358 \d \d{4} \d{4}"),
])
def test_any_grouping_and_what_follows(spark, text, form):
    found, = report(spark, text)
    assert re.fullmatch(form, found) and found != text


@pytest.mark.parametrize("country, national, forms", [
    ("1", "4155552671", ["+14155552671", "+1 415 555 2671", "+1-415-555-2671", "+1 (415) 555-2671", "+1.415.555.2671",
                         "(415) 555-2671", "415-555-2671"]),
    ("44", "2079460958", ["+442079460958", "+44 20 7946 0958", "+44 (0)20 7946 0958", "+44 (0) 20 7946 0958", "+44 207 946 0958"]),
    ("33", "612345678", ["+33612345678", "+33 6 12 34 56 78", "+33 (0)6 12 34 56 78", "+33.6.12.34.56.78"]),
    ("49", "15123456789", ["+4915123456789", "+49 151 23456789", "+49 (0)151 23456789"]),
    ("358", "912345678", ["+358912345678", "+358 9 1234 5678", "+358 (0)9 1234 5678"]),
])
def test_all_forms_of_a_phone_number_stay_linked(spark, country, national, forms):
    """The country code and the trunk zero stay, and so does the form; the national digits are the same in all."""
    found = report(spark, *[f"call {f} now" for f in forms])
    seen = set()
    for form, text in zip(forms, found):
        shown = text.removeprefix("call ").removesuffix(" now")
        assert re.sub(r"\d", "0", shown) == re.sub(r"\d", "0", form) and shown != form
        digits = re.sub(r"\D", "", shown.replace("(0)", "") if "+" in form else shown)
        if "+" in form:
            assert digits.startswith(country) and ("(0)" in shown) == ("(0)" in form)
            digits = digits[len(country):]
        seen.add(digits)
    assert len(seen) == 1 and seen != {national} and len(*seen) == len(national)


def test_the_key_is_in_no_plan(spark, capsys):
    key = "a-key-that-nobody-should-see"
    found = pseudonyms.pseudonym_report(frame(spark, [(1, "a@b.org +442079460958", "en", "s", 1)]), key)
    execution = found._jdf.queryExecution()
    found.explain("formatted")
    found.explain("extended")
    texts = [capsys.readouterr().out, *(str(p) for p in (execution.logical(), execution.analyzed(), execution.optimizedPlan(),
                                                         execution.executedPlan(), execution))]
    assert found.collect() and all(key not in t for t in texts)
    assert key not in execution.executedPlan().toString()


def test_without_a_secret_one_is_drawn_for_the_session(spark):
    other = spark.newSession()
    key = queries.pseudonym_key(other)
    assert len(key) == 64 and queries.pseudonym_key(other) == key != queries.pseudonym_key(spark.newSession())
    shown = other.sql("SET").filter(F.col("key") == queries.PSEUDONYM_SECRET).first()["value"]
    assert key not in shown


def test_very_long_text(spark):
    text = prose(1, 150_000) + " +442079460958 " + prose(2, 1000) + " 4111111111111111"
    found, short = report(spark, text, "+442079460958")
    assert short in found and "+442079460958" not in found and "4111111111111111" not in found and found[:1000] == text[:1000]


def test_what_a_false_account_number_holds_is_found(spark):
    found, date_kept = report(spark, "ref AB12 4111 1111 1111 1111 x", "GB00 NWBK 6016 1331 9268 19")
    assert re.fullmatch(r"ref AB12( \d{4}){4} x", found) and found != "ref AB12 4111 1111 1111 1111 x"
    assert luhn(re.sub(r"\D", "", found[9:])) == 0 and date_kept == "GB00 NWBK 6016 1331 9268 19"


def test_unknown_country_ends_where_the_check_holds(spark):
    number = next(f"ZZ{c:02d} 2100 0418 4502 0005" for c in range(2, 99) if int("".join(
        str(int(x, 36)) for x in f"2100041845020005ZZ{c:02d}")) % 97 == 1)
    alone, followed = report(spark, number, f"{number} BIC")
    assert alone != number and followed == f"{alone} BIC"


def test_spaces_do_not_change_the_pseudonym(spark):
    a, b = report(spark, "ES91 2100 0418 4502 0005 1332", "ES9121000418450200051332")
    assert a.replace(" ", "") == b and int("".join(str(int(c, 36)) for c in b[4:] + b[:4])) % 97 == 1


def test_iban_check_digits_are_right(spark):
    found, = report(spark, "DE89370400440532013000")
    moved = found[4:] + found[:4]
    assert int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


@pytest.mark.parametrize("text", ["4111111111111112", "2023-02-29", "000-12-3456", "300.1.1.1", "1.2.3", "v1.2.3.4.5",
                                  "DE00370400440532013000", "x4111111111111111", "@home", "12345", "", prose(1, 50), None])
def test_what_fails_its_check_stays(spark, text):
    assert report(spark, text) == [text]


def test_equal_values_stay_linked_and_keys_differ(spark):
    a, b, c = report(spark, "pay 4111111111111111", "card 4111 1111 1111 1111", "4111111111111111\nx")
    assert a[4:] == b[5:].replace(" ", "") == c[:16]
    assert report(spark, "pay 4111111111111111", key="k2") != [a]


def test_counts_columns_and_empty_tables(spark):
    docs = clashing(frame(spark, [(1, "a@b.org 10.0.0.1 10.0.0.2", "en", "s", 1), (None, None, None, None, None)] * 2),
                    "_parts", "_row", "n_email", "kind")
    counted = pseudonyms.pseudonym_report(docs, KEY)
    assert [(r["n_email"], r["n_ip"], r["n_card"]) for r in counted.orderBy("doc_id").collect()] == [(0, 0, 0)] * 2 + [(1, 2, 0)] * 2
    done = pseudonyms.pseudonymous_documents(docs, KEY)
    assert done.columns == docs.columns and rows(done.select("kind").distinct()) == [("kept",)]
    assert rows(done.select("text")) == rows(counted.select("text"))
    assert pseudonyms.pseudonym_report(frame(spark, [], SCHEMA), KEY).count() == 0


def test_no_python_in_the_plan(spark):
    plan = pseudonyms.pseudonym_report(frame(spark), KEY)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
