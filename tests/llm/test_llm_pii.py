"""Pseudonyms: formats kept, one to one, equal values linked, and a second version of the permutation."""

import datetime
import hashlib
import random
import re

from lantern.llm import pii

KEY = "test"


def replaced(spark, values, key=KEY):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id long, text string")
    return [r.text for r in pii.pseudonymise(df, key).orderBy("doc_id").collect()]


def luhn(text):
    total = 0
    for i, sign in enumerate(reversed(re.sub(r"\D", "", text))):
        digit = int(sign) * (1 + i % 2)
        total += digit - 9 * (digit > 9)
    return total % 10 == 0


def card(rest):
    return next(rest + str(i) for i in range(10) if luhn(rest + str(i)))


def feistel(kind, left, right, lefts, rights):
    for i in range(1, 9):
        half = right if i % 2 else left
        mixed = int(hashlib.sha256(f"{KEY}|{kind}|{lefts}|{rights}|{i}|{half}".encode()).hexdigest()[:15], 16)
        if i % 2:
            left = (left + mixed) % lefts
        else:
            right = (right + mixed) % rights
    return left, right


def test_second_version(spark):
    draw = random.Random(1)
    addresses = [".".join(str(draw.randrange(256)) for _ in range(4)) for _ in range(200)]
    want = []
    for a in addresses:
        o = list(map(int, a.split(".")))
        left, right = feistel("address", o[0] * 256 + o[1], o[2] * 256 + o[3], 65536, 65536)
        want.append(f"{left >> 8}.{left & 255}.{right >> 8}.{right & 255}")
    assert replaced(spark, addresses) == want
    cards = [card("4" + "".join(draw.choice("0123456789") for _ in range(14))) for _ in range(200)]
    want = []
    for c in cards:
        left, right = feistel("card", int(c[1:8]), int(c[8:15]), 10**7, 10**7)
        want.append(card(f"4{left:07d}{right:07d}"))
    assert replaced(spark, cards) == want


def test_dates_stay_dates_one_to_one(spark):
    day = datetime.date(1990, 1, 1)
    dates = [day + datetime.timedelta(i) for i in range(900)]
    for form in ("%Y-%m-%d", "%d.%m.%Y", "%m/%d/%Y"):
        got = replaced(spark, [d.strftime(form) for d in dates])
        assert len(set(got)) == len(got)
        assert all(1800 <= datetime.datetime.strptime(g, form).year <= 2199 for g in got)
    late = [d.strftime("%d/%m/%Y") for d in dates if d.day > 12]
    got = replaced(spark, late)
    assert len(set(got)) == len(got) and all(datetime.datetime.strptime(g, "%d/%m/%Y").day > 12 for g in got)


def test_formats(spark):
    draw = random.Random(2)
    number = lambda n: "".join(draw.choice("0123456789") for _ in range(n))
    groups = {
        r"\+1 \([2-9]\d\d\) [2-9]\d\d-\d{4}": [f"+1 ({draw.randrange(200, 1000)}) {draw.randrange(200, 1000)}-{number(4)}" for _ in range(300)],
        r"\+1 \([01]\d\d\) [01]\d\d-\d{4}": [f"+1 ({draw.randrange(200):03d}) {draw.randrange(200):03d}-{number(4)}" for _ in range(200)],
        r"\+1 [01]\d\d-[2-9]\d\d-\d{4}": [f"+1 {draw.randrange(200):03d}-555-{number(4)}" for _ in range(200)],
        r"(?!000|666|9)\d{3}-(?!00)\d\d-(?!0000)\d{4}": [
            f"{draw.choice([*range(1, 666), *range(667, 900)]):03d}-{draw.randrange(1, 100):02d}-{draw.randrange(1, 10000):04d}"
            for _ in range(300)
        ],
        r"[a-z]+\.\d\d@mail\d\.example": [f"{''.join(draw.choices('abcdefgh', k=draw.randrange(2, 9)))}.{number(2)}@mail{draw.randrange(9)}.example" for _ in range(300)],
        r"token=[0-9a-f]{40}": ["token=" + "".join(draw.choices("0123456789abcdef", k=40)) for _ in range(100)],
        r"AKIA[A-Z0-9]{16}": ["AKIA" + "".join(draw.choices("ABCDEFGHIJ234567", k=16)) for _ in range(100)],
        r"\d{4}-\d{4}-\d{4}-\d{4}": ["-".join(re.findall("....", card("5" + number(14)))) for _ in range(100)],
        r"\+44 \d\d \d{4} \d{4}": [f"+44 {number(2)} {number(4)} {number(4)}" for _ in range(100)],
    }
    for pattern, values in groups.items():
        values = list(dict.fromkeys(values))
        got = replaced(spark, values)
        assert len(set(got)) == len(values), pattern
        assert all(re.fullmatch(pattern, g) for g in got), (pattern, got[:3])
        assert sum(g == v for g, v in zip(got, values)) <= 1, pattern
    assert all(luhn(g) for g in replaced(spark, groups[r"\d{4}-\d{4}-\d{4}-\d{4}"]))
    got = replaced(spark, ["GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"])
    for g in got:
        plain = g.replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in plain[4:] + plain[:4])) % 97 == 1
    assert got[0].startswith("GB") and " WEST " in got[0]


def test_what_is_not_valid_stays(spark):
    values = ["4041894974608796", "2020-02-30", "1.2.3", "300.1.1.1", "000-12-1234", "GB82 WEST 1234 5698 7654 33", "x@y", "12345", "", None]
    assert replaced(spark, values) == values


def test_linked_in_place(spark):
    one, two = "10.20.30.40", card("4" + "1" * 14)
    texts = [f"a {one} b {two}, {one}.", f"{two}", f"é{one}\n", f"{one} " * 3000, "no value", f"{one}"]
    got = replaced(spark, texts)
    new_one, new_two = got[5], got[1]
    assert new_one != one and new_two != two
    assert got == [t.replace(one, new_one).replace(two, new_two) for t in texts]
    assert replaced(spark, [one], "another key") != [new_one]


def test_odd_tables(spark):
    df = spark.createDataFrame([(1, "1.2.3.4", 7, "a"), (1, "1.2.3.4", 7, "a"), (None, None, None, None)], "doc_id long, text string, _found long, _rest string")
    out = pii.pseudonymise(df, KEY, count="n")
    assert out.columns == [*df.columns, "n"]
    rows = sorted(map(tuple, out.collect()), key=str)
    assert rows[0] == rows[1] and rows[0][2:] == (7, "a", 1) and rows[2] == (None, None, None, None, 0)
    assert pii.pseudonymise(df.limit(0), KEY).collect() == []


def test_secrets_after_names_in_any_writing(spark):
    value = "9233a8ec77b01f4d"
    texts = [f'x token = "{value}" y', f"token: {value}", f'token="{value}"', f"secret='{value}'", f'"api_key": "{value}",', f"passwd :{value}"]
    for before in (texts, [t.upper() for t in texts]):
        got = replaced(spark, before)
        new = {re.search(r"[0-9A-Za-z]{16}", t)[0] for t in got}
        assert len(new) == 1 and not new & {value, value.upper()}
        assert [t.replace(new.copy().pop(), "") for t in got] == [re.sub(f"(?i){value}", "", t) for t in before]
    assert replaced(spark, ['PASSWORD = "abcdefghij"']) != ['PASSWORD = "abcdefghij"']
    stays = ["the token was lost, a secret = b", "tokens 12345678", f"id={value}"]
    assert replaced(spark, stays) == stays


def test_secrets_of_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    secret = re.compile(r'(?i)token = "([0-9a-f]{8,64})"')
    before = {r.doc_id: r.text for r in docs.where("upper(text) LIKE '%TOKEN = %'").collect()}
    rows = docs.where("upper(text) LIKE '%TOKEN = %'")
    after = {r.doc_id: r.text for r in pii.pseudonymise(rows, KEY).collect()}
    assert any(secret.search(t) and t == t.upper() for t in before.values())
    assert all(v not in after[k] for k, t in before.items() for v in secret.findall(t))
