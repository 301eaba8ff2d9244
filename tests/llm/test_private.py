from __future__ import annotations

import re
from collections import Counter

from fixtures import SF_DIR, TEXTS, edge_rows, read

from kolumna.llm import queries, surrogates

LETTER = (
    "Mr. John Smith met Mrs. Anna Smith. Later Smith and John wrote to j.smith@mail.example.com and called +1 (212) 555-0100 "
    "or (212) 555-0100. DE89 3704 0044 0532 0130 00, 4111 1111 1111 1111, 192.168.7.9, 2001:db8:85a3::8a2e:370:7334, 123-45-6789, "
    "г-н Иванов, 王先生, J.SMITH@MAIL.EXAMPLE.COM"
)


def test_letter(spark):
    rows = spark.createDataFrame([(1, LETTER), (2, LETTER)], "doc_id long, text string")
    first, second = surrogates.replaced(rows, "key").collect()
    assert first.text == second.text and first.text != surrogates.replaced(rows, "other").first().text
    new = first.text
    for value in ("John", "Smith", "Anna", "212", "0100", "3704", "4111", "192.168", "85a3", "6789", "Иванов", "王先", "mail.example.com"):
        assert value.lower() not in new.lower()
    names = re.match(r"Mr\. (\w+) (\w+) met Mrs\. (\w+) (\w+)\. Later (\w+) and (\w+) wrote to (\S+) and called \+1 (\(\d{3}\) \d{3}-\d{4}) or (\(\d{3}\) \d{3}-\d{4})", new).groups()
    assert names[1] == names[3] == names[4] and names[0] == names[5] and names[7] == names[8] and names[2][-1] in "ae"
    assert new.endswith(names[6].upper())
    account = re.search(r"DE\d\d(?: \d{4}){4} \d\d", new).group().replace(" ", "")
    assert account[2:4] == surrogates.iban_check("DE", account[4:])
    card = re.search(r"\d{4} \d{4} \d{4} \d{4}(?=, )", new).group().replace(" ", "")
    assert surrogates.luhn_digit(card[:-1]) == card[-1]
    assert re.search(r"г-н [А-Я][а-я]+", new)


def test_table(spark):
    old = {r.doc_id: r.text for r in read(spark).collect()}
    new = {r.doc_id: r for r in queries.private_data(spark, SF_DIR).collect()}
    assert old.keys() == new.keys()
    for pattern in (r"[\w.]+@[\w.]+\.com", r"\(\d{3}\) 555-\d{4}", r"\b\d{16}\b", r"\b\d{1,3}(?:\.\d{1,3}){3}\b"):
        was = {m for t in old.values() for m in re.findall(pattern, t)}
        assert was and not was & {m for r in new.values() for m in re.findall(pattern, r.text)}
    for i, r in new.items():
        assert (r.n_entities == 0) == (r.text == old[i]) and r.n_entities == len([s for s in r.spans.split(",") if s])


def test_distinct_and_consistent(spark):
    """So many entities of a small kind that candidates collide: still one surrogate for each, none of them real."""
    known = spark.createDataFrame([("name", f"name{i}", "male") for i in range(3000)] + [("ip4", f"240.0.0.{i}", None) for i in range(200)], "kind string, value string, gender string")
    found = surrogates.surrogate_table(known, b"k").collect()
    values, made = {(r.kind, r.value) for r in found}, {(r.kind, r.surrogate) for r in found}
    assert len(found) == len(values) == len(made) == 3200 and not values & made
    assert Counter(surrogates.invented("name", f"name{i}", b"k", 0, "male") for i in range(3000)).most_common(1)[0][1] > 1


def test_clean_texts_stay(spark):
    for text in ("On 12.05.2020 we sold 1,234,567 pieces at 3.14159 each, see section 1.2.3.4.5 and 2020-01-31.", "Dr. no one; mr and mrs; a@b"):
        assert surrogates.entities(text) == []


def test_edges(spark):
    found = surrogates.replaced(edge_rows(spark), "key").collect()
    assert Counter((r.doc_id, r.text) for r in found) == Counter(TEXTS) and {r.n_entities for r in found} == {0}
    assert surrogates.replaced(edge_rows(spark).limit(0), "key").collect() == []


def test_one_person_one_surrogate(spark):
    """A name has one surrogate behind any title, as given and as last name, in all documents; genders follow most titles."""
    letters = [
        "Dr. John Smith called. John Smith left.", "Mr. John Smith called.", "Prof. Smith met Mr. John Adams.", "Mr. John Brown, Mrs. Anna John.",
        "Mrs. Anna Smith and Dr. Anna Adams.", "Mx. Robin Smith", "Mrs. Robin Brown and Mrs. Robin Adams and Mr. Robin Smith",
    ]
    rows = spark.createDataFrame(list(enumerate(letters)), "doc_id long, text string")
    new = {r.doc_id: r.text for r in surrogates.replaced(rows, "key").collect()}
    made = {}
    for i, text in enumerate(letters):
        old_words, new_words = re.findall(r"\w+", text), re.findall(r"\w+", new[i])
        assert len(old_words) == len(new_words)
        for old, word in zip(old_words, new_words):
            if old in ("John", "Smith", "Adams", "Brown", "Anna", "Robin"):
                assert made.setdefault(old, word) == word != old
            else:
                assert old == word
    assert len(set(made.values())) == len(made)
    assert made["John"][-1] in "nrsk" and made["Anna"][-1] in "ae"
