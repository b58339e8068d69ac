import datetime as dt
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from terrapipe.llm.pii import Cipher, luhn, pseudonymise, replaced, spans

CIPHER = Cipher(b"test")


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000, 2600])
def test_permutation_without_fixed_points(n):
    image = [CIPHER.permute("t", n, x) for x in range(n)]
    assert sorted(image) == list(range(n))
    assert n == 1 or all(x != y for x, y in enumerate(image))
    assert [CIPHER.invert("t", n, y) for y in image] == list(range(n))


def test_key_and_format_matter():
    assert [Cipher(b"a").permute("t", 10**9, 5), CIPHER.permute("u", 10**9, 5)].count(CIPHER.permute("t", 10**9, 5)) == 0


SHAPES = {
    "jane.doe7@mail.example.com": ("email", r"[a-z]{4}\.[a-z]{3}\d@mail\.example\.com"),
    "4111 1111 1111 1111": ("card", r"\d{4} \d{4} \d{4} \d{4}"), "378282246310005": ("card", r"\d{15}"),
    "GB82 WEST 1234 5698 7654 32": ("iban", r"GB\d\d [A-Z]{4} \d{4} \d{4} \d{4} \d\d"),
    "2021-03-05": ("date", r"\d{4}-\d\d-\d\d"), "17/05/1999": ("date", r"\d\d/\d\d/\d{4}"), "5/7/1999": ("date", r"\d{1,2}/\d{1,2}/\d{4}"),
    "05.03.2020": ("date", r"\d\d\.\d\d\.\d{4}"), "123-45-6789": ("ssn", r"\d{3}-\d\d-\d{4}"), "10.20.30.40": ("ip", r"\d+\.\d+\.\d+\.\d+"),
    "+1 (974) 555-3436": ("phone", r"\+1 \(\d{3}\) \d{3}-\d{4}"), "(974) 555-3436": ("phone", r"\(\d{3}\) \d{3}-\d{4}"),
    '"x": secret = "ABCDEF0123456789ABCDEF0123456789"': ("key", r'"x": secret = "[0-9A-F]{32}"'),
}


@pytest.mark.parametrize("value", SHAPES)
def test_format_and_linkage(value):
    kind, shape = SHAPES[value]
    text = f"before {value}, and again {value}."
    found = spans(text, CIPHER)
    assert [k for _, _, k, _ in found] == [kind] * 2
    new = replaced(text, found)
    first, second = re.fullmatch(rf"before (.*), and again (.*)\.", new).groups()
    assert first == second != value and re.fullmatch(shape, first)
    again = spans(new, CIPHER)
    assert [k for _, _, k, _ in again] == [kind] * 2  # what comes out is valid too
    if kind == "card":
        assert luhn(re.sub(r"\D", "", first))
    if value == "2021-03-05":
        dt.date.fromisoformat(first)


@pytest.mark.parametrize("text", ["4111 1111 1111 1112", "2021-13-01", "30.02.2020", "999.1.1.1", "Version 2.0.", "000-12-3456", "1234", "a@b",
                                  "GB82 WEST 1234 5698 7654 33", "0000000000000000", "page 12/13", "", "no numbers at all", "1899-01-01"])
def test_what_is_not_valid_stays(text):
    assert spans(text, CIPHER) == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.dates(dt.date(1900, 1, 1), dt.date(2099, 12, 31)), min_size=2, max_size=5, unique=True))
def test_dates_stay_apart(days):
    for form in ("%Y-%m-%d", "%d.%m.%Y", "%m/%d/%Y"):
        shown = [d.strftime(form) for d in days]
        new = [replaced(s, spans(s, CIPHER)) for s in shown]
        assert len(set(new)) == len(days) and not set(zip(shown, new, strict=True)) & {(s, s) for s in shown}


NOTATIONS = {"%Y-%m-%d": "{0.year:04d}-{0.month:02d}-{0.day:02d}", "%Y/%m/%d": "{0.year:04d}/{0.month:02d}/{0.day:02d}",
             "%d.%m.%Y": "{0.day:02d}.{0.month:02d}.{0.year:04d}", "unpadded": "{0.day}.{0.month}.{0.year:04d}", "%m/%d/%Y": "{0.month:02d}/{0.day:02d}/{0.year:04d}",
             "month first": "{0.month}/{0.day}/{0.year:04d}", "day first": "{0.day}/{0.month}/{0.year:04d}", "%d-%m-%Y": "{0.day:02d}-{0.month:02d}-{0.year:04d}"}


@settings(max_examples=300, deadline=None)
@given(st.dates(dt.date(1900, 1, 1), dt.date(2099, 12, 31)))
def test_a_day_has_one_pseudonym_in_all_notations(day):
    new = dt.date.fromisoformat(replaced(s := day.isoformat(), spans(s, CIPHER)))
    assert new != day and (new.day > 12) == (day.day > 12)
    for name, form in NOTATIONS.items():
        if name not in ("day first", "%d-%m-%Y") or day.day > 12:  # else these read as month first
            shown = form.format(day)
            got = replaced(shown, spans(shown, CIPHER))
            assert got == form.format(new) or [int(x) for x in re.split(r"\D", got)] == [int(x) for x in re.split(r"\D", form.format(new))]


def test_many_values_in_one_text():
    days = [dt.date(1950, 1, 1) + dt.timedelta(days=k) for k in range(20_000)]
    text = " ".join(d.isoformat() for d in days)
    found = spans(text, CIPHER)
    assert len(found) == 20_000 and found == sorted(found) and all(a[1] <= b[0] for a, b in zip(found, found[1:]))


def test_rows(documents, empty, spark):
    out = pseudonymise(documents, b"k")
    assert out.columns == [*documents.columns, "pii"] and out.drop("pii").exceptAll(documents).count() == 0
    clash = spark.createDataFrame([(1, "call +1 (974) 555-3436", "x", None), (2, None, "y", 3), (3, "", None, None)], "doc_id long, text string, pii string, n int")
    rows = {r.doc_id: r for r in pseudonymise(clash, b"k").collect()}
    assert rows[1].pii[0].kind == "phone" and rows[1].text != "call +1 (974) 555-3436" and rows[2].text is None and rows[3].text == "" and rows[2].n == 3
    assert pseudonymise(empty, b"k").count() == 0
