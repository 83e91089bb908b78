import re

from shelfline.llm import private_data as p
from tests.llm import cases

KEY = b"test"


def test_surrogates_keep_the_format():
    s = lambda kind, value: p.surrogate(kind, value, KEY)
    a, b = s("email", "dikcoc.41@mail7.example.com"), s("email", "other@mail7.example.com")
    assert re.fullmatch(r"[a-z]{6}\.[1-9]\d@[a-z]{4}\d\.[a-z]{7}\.com", a) and a.split("@")[1] == b.split("@")[1]
    assert re.fullmatch(r"\+1 \([1-9]\d\d\) [1-9]\d\d-\d{4}", s("phone", "+1 (736) 555-2678"))
    assert re.fullmatch(r"\d\d\.\d{3}\.\d{3}\.\d{3}", s("ip", "61.131.143.218"))
    card = s("card", "4242 4242 4242 4242")
    assert re.fullmatch(r"4\d{3}( \d{4}){3}", card) and p.luhn_holds([int(c) for c in card if c.isdigit()])
    assert not p.luhn_holds([int(c) for c in s("card", "4242424242424241")])
    assert s("person", "Frau Keller").startswith("Frau ") and s("person", "Анна Орлов").split()[0] in p.NAMES["cyrillic", "f"]
    assert s("person", "Mr Paul Baker").split()[1] in p.NAMES["latin", "m"]


TEXTS = ["mail dikcoc.41@mail7.example.com, +1 (736) 555-2678; é 61.131.143.218 end", "again dikcoc.41@mail7.example.com.", "card 4777431686562174 x", "Frau Keller and Anna Moreau met Анна Соколов", "Version 2.0. of 1999", "1.2.3.4"]


def test_neighbours_do_not_hide_each_other():
    text = "61.131.143.218 4777431686562174 4291222221165632 +1 (736) 555-2678 a@b.example.com"
    assert [k for _, _, k, _ in p.entities(text)] == ["ip", "card", "card", "phone", "email"]


def test_mentions_agree_and_nothing_is_left(spark):
    rows = [(500 + k, t, *([None] * 10)) for k, t in enumerate(TEXTS)] + cases.rows(1, 30)
    docs = spark.createDataFrame(rows, cases.SCHEMA)
    got = {r.doc_id: r for r in p.replace_entities(docs, KEY).collect()}
    assert got[500].n_entities == 3 and got[503].n_entities == 3 and got[504].text == TEXTS[4]
    for k, t in enumerate(TEXTS[:4]):
        assert all(value not in got[500 + k].text for _, _, _, value in p.entities(t))
    address = re.search(r"\S+@\S+(?=,)", got[500].text)[0]
    assert got[501].text == f"again {address}." and got[500].text.endswith(" end")
    clean = {r[0]: r[1] for r in cases.rows(1, 30) if r[0]}
    assert all(got[i].text == t for i, t in clean.items())
    assert p.replace_entities(docs, KEY).count() == len(rows) and p.replace_entities(cases.empty(spark)).count() == 0


def test_distinct_entities_stay_distinct(spark):
    values = [("person", f"Herr {'Bcdfgh'[k % 6]}{'aeiou'[k % 5]}{chr(97 + k % 26)}{chr(97 + k // 26)}") for k in range(300)] + [("ip", f"1.1.1.{k}") for k in range(1, 10)]
    got = p.mapping(spark.createDataFrame(values, "kind string, value string"), KEY).collect()
    assert len(got) == len(set(values)) == len({(r.kind, r.surrogate) for r in got})
    assert not {(r.kind, r.surrogate) for r in got} & set(values)


def test_mentions_in_other_forms_are_one_entity(spark):
    texts = [
        "Dr. Anna Keller wrote. Anna Keller and Frau Keller and Frau Dr. Anna Keller; Herr Keller, Paul Keller", "Anna Keller alone", "Frau Keller alone",
        "Ann.Bo@Mail.example.com ann.bo@mail.example.com ANN.BO@MAIL.EXAMPLE.COM", "+1 (736) 555-2678, +1 736 555 2678; +1.736.555.2678; +1-736-555-2678", "4242 4242 4242 4242, 4242424242424242, 4242-4242-4242-4242", "Mr Xanthor then",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = [r.text for r in p.replace_entities(docs, KEY).orderBy("doc_id").collect()]
    first, last, other = re.fullmatch(r"Dr\. (\w+) (\w+) wrote\. \1 \2 and Frau \2 and Frau Dr\. \1 \2; Herr \w+, (\w+ \w+)", got[0]).groups()
    assert got[1] == f"{first} {last} alone" and first in p.NAMES["latin", "f"] and other != f"{first} {last}"
    assert got[0].split("Herr ")[1].split(",")[0] == other.split()[1] and not any("Keller" in t for t in got)
    a, b, c = got[3].split(" ")
    assert a.lower() == b == c.lower() and c.isupper() and a[0].isupper() and a != texts[3].split(" ")[0]
    for k in (4, 5):
        assert len({re.sub(r"\D", "", x) for x in re.split("[,;]", got[k])}) == 1 and re.sub(r"\d", "0", got[k]) == re.sub(r"\d", "0", texts[k])
    assert got[4].startswith("+1 (") and got[4] != texts[4] and p.luhn_holds([int(x) for x in got[5].split(",")[1].strip()])
    assert got[6].startswith("Mr ") and "Xanthor" not in got[6]


def test_a_full_format_is_widened(spark):
    values = [("ip", f"{1 + k // 729}.{1 + k // 81 % 9}.{1 + k // 9 % 9}.{1 + k % 9}") for k in range(5000)]
    values += [("email", f"{a}@{b}.io") for a in "abcdefghijklmnopqrstuvwxyz" for b in "abcdefghijklmnop"]
    got = {(r.kind, r.value): r.surrogate for r in p.mapping(spark.createDataFrame(values, "kind string, value string"), KEY).collect()}
    assert set(got) == set(values) and len({(k, s) for (k, _), s in got.items()}) == len(values)
    assert not {(k, s) for (k, _), s in got.items()} & set(values)
    assert all(p.entities(f"x {s} y")[0][2:] == (k, s) for (k, _), s in got.items())
    for kind, value in (("phone", "+1 (736) 555-2678"), ("ssn", "123-45-6789"), ("card", "4242 4242 4242 4242")):
        old, new = p.surrogate(kind, value, KEY, 3), p.surrogate(kind, value, KEY, 5)
        assert len(old) == len(value) and len(new) == len(value) + 2
    assert p.luhn_holds([int(c) for c in new if c.isdigit()])
