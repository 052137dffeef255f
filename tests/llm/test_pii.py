import re

import pytest
from pyspark.sql import functions as F

from careflow.llm import pii

KEY = b"k" * 32
TEXT = ("Mr John Smith (john.smith@mail7.example.com, +1 (017) 555-7713) met Mrs. Anna Smith. JOHN.SMITH@MAIL7.EXAMPLE.COM "
        "paid with 4845168114407329 and 4845-1681-1440-7329 from 97.51.17.173; token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" "
        "IBAN DE89 3704 0044 0532 0130 00, id 123-45-6789, г-жа Иванова.")


def kinds(text):
    return [x[2] for x in pii.find(text)]


def test_kinds_and_canonical_forms():
    found = pii.find(TEXT)
    assert [x[2] for x in found] == ["given m LATIN", "family LATIN", "email", "phone", "given f LATIN", "family LATIN", "email",
                                     "card", "card", "ip", "secret", "iban", "ssn", "family CYRILLIC"]
    assert found[2][3] == found[6][3] and found[7][3] == found[8][3] and found[1][3] == found[5][3]


@pytest.mark.parametrize("clean", [
    "Version 2.0 of 4.0, section 1.2.3, in 2019, 100000 times", "9807915762804490 is no card", "4845168114407328 has a wrong digit",
    "1.2.3.4.5 and 999.1.1.1 and 1.2.3", "the token: language", "a@b and @home", "12:30 to 14:45, 3-4 days, 555-7713",
    "deadbeefdeadbeefdeadbeef", "mister of the house; mr", ""])
def test_clean_texts_stay(clean):
    assert pii.replace(clean, KEY) == (clean, 0)


def test_formats_coreference_and_validity():
    new, n = pii.replace(TEXT, KEY)
    assert n == 14
    again = pii.find(new)
    assert [x[2] for x in again] == kinds(TEXT)  # valid addresses, check digits, titles with names
    mails = re.findall(r"\S+@\S+?\.com", new, re.I)
    assert mails[0].lower().lstrip("(") == mails[1].lower() and mails[1].isupper()
    assert again[1][3] == again[5][3] and again[7][3] == again[8][3]
    assert re.search(r"\+1 \(\d{3}\) \d{3}-\d{4}", new) and re.search(r"4\d{3}-\d{4}-\d{4}-\d{4}", new)
    assert not {x[3] for x in pii.find(TEXT)} & {x[3] for x in again}
    assert pii.replace(TEXT, KEY) == (new, n) and pii.replace(TEXT, b"z" * 32)[0] != new


def test_surrogates_are_distinct_over_the_corpus(spark):
    """A kind with only a few possible surrogates: every one still goes to one entity and is no entity."""
    names = [f"n{i:02d}" for i in range(20)]
    entities = spark.createDataFrame([("x", n) for n in names] + [("y", n) for n in names], "kind string, canonical string")

    def few(frame, secret):
        # attempt 0 sends all to three surrogates, one of them real; later attempts spread out
        number = F.substring("canonical", 2, 2).cast("int")
        first = F.concat(F.lit("s"), (number % 3).cast("string"))
        return frame.withColumn("surrogate", F.when(F.col("attempt") == 0, F.when(number % 3 == 0, F.lit("n05")).otherwise(first))
                                .otherwise(F.concat(F.lit("t"), (number * 7 + F.col("attempt")).cast("string"))))

    moved = pii.moved_entities(entities, KEY, few)
    attempts = {(r["kind"], r["canonical"]): r["attempt"] for r in moved.collect()}
    final = [(r["kind"], r["surrogate"]) for r in few(
        spark.createDataFrame([(k, n, attempts.get((k, n), 0)) for k in "xy" for n in names],
                              "kind string, canonical string, attempt int"), KEY).collect()]
    assert len(set(final)) == 40 and not {s for _, s in final} & set(names)


def test_moved_entities_reach_their_documents(spark, monkeypatch):
    """Names have few surrogates at first: many families, all told apart in the texts."""
    rows = [(i, f"Mr {chr(65 + i % 26)}{'aeiou'[i // 26 % 5]}{'bcdfg'[i // 130]}son wrote to Herr Müller.") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in pii.with_surrogates(docs, "secret", count="n").collect()}
    name = lambda t: re.match(r"Mr (\w+) wrote", t)[1]
    before, after = [name(t) for _, t in rows], [name(got[i]["text"]) for i, _ in rows]
    assert len(set(after)) == len(set(before)) and len(set(zip(before, after, strict=True))) == len(set(before))
    assert not {a.casefold() for a in after} & {b.casefold() for b in before}
    assert len({got[i]["text"].split("Herr ")[1] for i, _ in rows}) == 1
    assert all(r["n"] == 2 for r in got.values())


def test_odd_rows(odd_docs, no_docs):
    got = pii.with_surrogates(odd_docs, "secret", count="n_replaced")
    assert got.columns == [*odd_docs.columns, "n_replaced"]
    rows, want = got.collect(), odd_docs.collect()
    assert len(rows) == len(want)
    texts = sorted(str(r["text"]) for r in rows if r["n_replaced"] == 0)
    assert texts == sorted(str(r["text"]) for r in want if "@" not in (r["text"] or ""))
    changed = [r["text"] for r in rows if r["n_replaced"]]
    assert len(changed) == 2 and changed[0] == changed[1] and "jo.doe" not in changed[0]
    assert pii.with_surrogates(no_docs, "secret").count() == 0


@pytest.mark.parametrize("text, number", [
    ("4111 1111 1111 1111 12/27", "4111 1111 1111 1111"), ("4111-1111-1111-1111 123", "4111-1111-1111-1111"),
    ("room 12 4111111111111111", "4111111111111111"), ("12 4111 1111 1111 1111 12 27 x", "4111 1111 1111 1111"),
    ("3.5 4111 1111 1111 1111 12th", "4111 1111 1111 1111"),
    ("BE71 0961 2345 6769 EUR", "BE71 0961 2345 6769"), ("AT61 1904 3002 3457 3201 BIC", "AT61 1904 3002 3457 3201"),
    ("NO99 1234 BE71 0961 2345 6769 EUR PAID", "BE71 0961 2345 6769"),
    ("+1 555 123 4567 2024 2025", "+1 555 123 4567 2024")])
def test_numbers_beside_other_figures_or_words(text, number):
    found = pii.find(text)
    assert [text[a:b] for a, b, _, _ in found] == [number]
    new, n = pii.replace(text, KEY)
    assert n == 1 and number not in new and new.replace(new[found[0][0]:found[0][1]], "") == text.replace(number, "")


def test_two_numbers_in_one_run():
    text = "4111 1111 1111 1111 5500 0000 0000 0004 and BE71 0961 2345 6769 AT61 1904 3002 3457 3201"
    assert [text[a:b] for a, b, _, _ in pii.find(text)] == [
        "4111 1111 1111 1111", "5500 0000 0000 0004", "BE71 0961 2345 6769", "AT61 1904 3002 3457 3201"]


def test_names_are_replaced_wherever_they_stand():
    text = ("Smith was late. Mr. John Smith. Smith left. John Smith too, and JOHN SMITH's friend; Mr. John said so. "
            "A smith in Smithfield, Johnson.")
    new, n = pii.replace(text, KEY)
    assert n == 9 and not re.search(r"(?i)\bjohn\b", new) and not re.search(r"\bSmith\b|\bSMITH\b", new)
    given, family = re.search(r"Mr\. (\w+) (\w+)\.", new).groups()
    assert new == (f"{family} was late. Mr. {given} {family}. {family} left. {given} {family} too, and {given.upper()} "
                   f"{family.upper()}'s friend; Mr. {given} said so. A smith in Smithfield, Johnson.")


@pytest.mark.parametrize("text, names", [
    ("Sir Arthur Ignatius Conan Doyle wrote.", ["Arthur", "Ignatius", "Conan", "Doyle"]),
    ("Mr. J. R. Smith and Mrs. A.B. Jones: J. stays", ["J", "R", "Smith", "A", "B", "Jones"]),
    ("Herr Dr. Müller Frau Schmidt's Haus", ["Müller", "Schmidt"]),
    ("Herr Weiß kam. Weiß ging, WEISS blieb", ["Weiß", "Weiß", "WEISS"]), ("Mr Smith's Paris, Mr Smith", ["Smith", "Smith"]), ("Sir Don Bradman", ["Bradman"])])
def test_runs_of_names(text, names):
    found = pii.find(text)
    assert [text[a:b] for a, b, _, _ in found] == names
    assert found[-1][2].startswith("family")


def test_a_filled_format_is_widened(spark):
    """All addresses of one figure an octet are real: the loop ends, with distinct surrogates outside of them."""
    addresses = [f"{a}.{b}.{c}.{d}" for a in range(1, 10) for b in range(1, 10) for c in range(1, 10) for d in range(1, 10)]
    entities = spark.createDataFrame([("ip", x) for x in addresses], "kind string, canonical string")
    moved = {r["canonical"]: r["attempt"] for r in pii.moved_entities(entities, KEY).collect()}
    new = [pii.surrogate(KEY, "ip", x, moved.get(x, 0)) for x in addresses]
    assert len(set(new)) == len(new) and not set(new) & set(addresses)
    assert all(pii.find(x) == [(0, len(x), "ip", x)] for x in new)


@pytest.mark.parametrize("kind, canonical", [
    ("ip", "1.2.3.4"), ("ip", "100.20.3.44"), ("phone", "1234567"), ("card", "4222222222222"), ("card", "36000000000008"),
    ("iban", "BE71096123456769"), ("email", "a@b.de"), ("ssn", "123-45-6789"), ("secret", "a1b2c3d4"), ("secret", "pass-123")])
def test_later_surrogates_have_a_wider_format(kind, canonical):
    drawn = [pii.surrogate(KEY, kind, canonical, k) for k in range(24)]
    assert len(set(drawn)) == 24 and len(drawn[23]) > len(canonical)
    for new in drawn:
        mention = pii._written_like(canonical, kind, new)
        if kind in ("phone", "card", "iban", "email"):
            assert re.sub(r"\W", "", mention).lower() == re.sub(r"\W", "", new).lower()
        if kind == "card":
            assert pii._is_card(new)
        if kind == "iban":
            assert pii._iban_number(new) % 97 == 1


@pytest.mark.parametrize("text, gone", [
    ("password: hunter2", ["hunter2"]), ("pwd=correcthorsebattery", ["correcthorsebattery"]), ("secret=x", ["x"]),
    ("Passwort: geheimeswort\nund mehr", ["geheimeswort"]), ('api_key: "so quoted"', ["so quoted"]), ("token: aB,", ["aB"]),
    ("host 2001:db8::1 is up", ["2001:db8::1"]), ("fe80::1ff:fe23:4567:890a, ::1", ["fe80::1ff:fe23:4567:890a", "::1"]),
    ("Ruf 0171 2345678 an", ["0171 2345678"]), ("au 01 42 68 53 00.", ["01 42 68 53 00"]), ("Tel. 030/1234567", ["030/1234567"]),
    ("teléfono: 612 345 678, gracias", ["612 345 678"]), ("call 020 7946 0958", ["020 7946 0958"]),
    ("Frau von der Leyen kam. Leyen ging.", ["Leyen", "Leyen"]), ("Señor Juan de la Cruz", ["Juan", "Cruz"]),
    ("Monsieur Jean du Bois, Bois", ["Jean", "Bois", "Bois"])])
def test_what_may_not_stay(text, gone):
    found = pii.find(text)
    assert [text[a:b] for a, b, _, _ in found] == gone
    new, _ = pii.replace(text, KEY)
    assert not any(re.search(rf"(?<!\w){re.escape(g)}(?!\w)", new) for g in gone)


@pytest.mark.parametrize("clean", [
    "Password: required by the policy.", "the secret: nobody knew", "token: the", "std::vec, Ace::Bad and a::b", "::", "12::30",
    "0171 234", "on 01 02 2024", "010 99 pieces", "0.171 234567", "phone 12", "Herr von und zu", "Frau der Stunde"])
def test_clean_texts_of_the_same_look(clean):
    clean_of_addresses = [x for x in pii.find(clean) if x[2] != "ipv6" or clean != "12::30"]
    assert clean_of_addresses == []


def test_compressed_addresses_are_one_entity():
    forms = "2001:db8::1 and 2001:0db8:0:0:0:0:0:1 and 2001:DB8::1"
    assert len({x[3] for x in pii.find(forms)}) == 1
    for k in range(24):
        new = pii.surrogate(KEY, "ipv6", "2001:db8::1", k)
        assert pii.find(new) == [(0, len(new), "ipv6", new)]


def independent(text):
    """Addresses, card and account numbers by splitting, arithmetic and the standard library."""
    import ipaddress
    out = set()
    for word in re.split(r"[\s,;()<>\"'=#$%&*|]+", text):
        word = word.strip(".:!?")
        left, at, right = word.rpartition("@")
        if at and left and "." in right and right.rpartition(".")[2].isalpha():
            out.add(word.lower())
        if word.count(".") == 3 and word.replace(".", "").isdigit():
            try:
                out.add(str(ipaddress.IPv4Address(word)))
            except ValueError:
                pass
        plain = word.replace("-", "")
        if plain.isdigit() and len(plain) == 16 and plain[0] in "45":
            doubled = [int(c) if i % 2 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(plain)]
            if sum(doubled) % 10 == 0:
                out.add(plain)
        if re.fullmatch("[A-Z]{2}[0-9]{2}[A-Z0-9]{8,}", word) and int("".join(str(int(c, 36)) for c in word[4:] + word[:4])) % 97 == 1:
            out.add(word)
    return out


def test_an_independent_finder_agrees(spark):
    from tests.llm.conftest import SF_CHECK
    kinds, n = ("email", "ip", "card", "iban"), 0
    for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").select("text").collect():
        want = independent(r["text"] or "")
        n += len(want)
        assert {x[3] for x in pii.find(r["text"] or "") if x[2] in kinds} == want
    assert n > 20


def test_secret_of_the_configuration(spark):
    first = pii.session_secret(spark)
    assert first == pii.session_secret(spark) and len(first) == 64
    spark.conf.set(pii.SECRET_SETTING, "ours")
    try:
        assert pii.session_secret(spark) == "ours"
    finally:
        spark.conf.unset(pii.SECRET_SETTING)
