import re

import pytest
import regex
from pyspark.sql import functions as F

from landstrata.llm import pii

SCHEMA = "doc_id long, text string, n_ip string, extra int"
TEXT = (
    "Mr. John Smith met Mrs. Smith and Dr. Anna Кузнецова. Госпожа Иванова wrote a.b@c.example.org, A.B@c.example.org, a.b@c.example.org. "
    "Ssn 123-45-6789, DE44 5001 0517 5407 3249 31; +44 20 7946 0958 / 10.0.0.1, 4111 1111 1111 1111"
)
CLEAN = "clean text 12 3.4.5 v1.2.3.4.5 2024-01-01 at 10:30, Mr smith, 12345 a@b user@ @host 1-2-3"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], SCHEMA)


def shape(text):
    return re.sub(r"[^\W\d_]", "a", re.sub(r"\d", "0", text))


def luhn(number):
    digits = [int(c) for c in re.sub(r"\D", "", number)][::-1]
    return sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(digits)) % 10 == 0


def test_one_text(spark):
    (row,) = pii.replaced(frame(spark, [(1, TEXT)]), "key").collect()
    counts = {k: row[f"n_{k}"] for k in pii.KINDS}
    assert counts == {"email": 3, "phone": 1, "card": 1, "ip": 1, "identity": 1, "iban": 1, "name": 6}
    new = row.text
    for value in ("John", "Smith", "Anna", "Кузнецова", "Иванова", "a.b@c", "A.B@c", "123-45-6789", "5001 0517", "7946 0958", "10.0.0.1", "4111 1111"):
        assert value not in new
    m = re.fullmatch(
        r"Mr\. (\w+) (\w+) met Mrs\. (\w+) and Dr\. (\w+) (\w+)\. Госпожа (\w+) wrote (\S+), (\S+), (\S+)\. "
        r"Ssn (\S+), (DE[\d ]+); (\+44 [\d ]+) / ([\d.]+), ([\d ]+)", new,
    )
    given, family, same, anna, cyrillic, other, mail, upper, again, ssn, iban, phone, ip, card = m.groups()
    assert family == same and mail == again and mail != upper  # one person, one address
    assert re.fullmatch("[А-я]+", cyrillic) and re.fullmatch("[А-я]+", other) and cyrillic != other and given.endswith("en") and given.isascii()
    assert shape(mail) == shape("a.b@c.example.org") and mail.endswith(".org") and mail.islower()
    assert shape(ssn) == "000-00-0000" and shape(iban) == shape("DE44 5001 0517 5407 3249 31") and shape(phone) == shape("+44 20 7946 0958")
    assert all(0 <= int(x) <= 255 for x in ip.split(".")) and luhn(card) and card[0] == "4" and shape(card) == shape("4111 1111 1111 1111")


NAMES = {
    "Mr. John Michael Smith left.": "John Michael Smith", "Dr. J. Smith left": "J. Smith", "Mrs. O'Brien left": "O'Brien", "Mr. Jean-Pierre Dupont left": "Jean-Pierre Dupont",
    "Prof. Dr. J.R. Tolkien's book": "J.R. Tolkien", "Herr Ludwig van Beethoven kam": "Ludwig Beethoven", "Herr von Goethe kam": "Goethe", "Господин Иван Петрович Сидоров пришёл": "Иван Петрович Сидоров",
}


NUMBERS = {
    "phone": [
        "06 12 34 56 78", "+33 6 12 34 56 78", "+33 1 23 45 67 89", "01.23.45.67.89", "+7 (495) 123-45-67", "8 (495) 123-45-67", "+1 (415) 555-1234", "415-555-1234",
        "+44 20 7946 0958", "+49 30 901820", "+49 (30) 9018 2012", "+34 612 345 678", "612 345 678", "+39 06 1234 5678", "+81 3-1234-5678", "+4915112345678",
    ],
    "card": ["3782 822463 10005", "378282246310005", "4111 1111 1111 1111", "3056 930902 5904"],
    "ip": ["2001:0db8:85a3:0000:0000:8a2e:0370:7334", "fe80::1ff:fe23:4567:890a", "2001:db8::1", "fe80::1", "192.168.1.254"],
}
AMOUNTS = ["10 000 000 people", "1 000 000 000 people", "250 000 000 people", "12.345.678 euros", "1 234 567 890 people", "at 10:30:15", "std::vector", "aa:bb:cc", "12 345 678"]


def test_numbers_by_country(spark):
    rows = [(kind, v) for kind, values in NUMBERS.items() for v in values] + [(None, v) for v in AMOUNTS]
    out = {r.doc_id: r for r in pii.replaced(frame(spark, [(k, f"call {v}, now") for k, (_, v) in enumerate(rows)]), "key").collect()}
    for k, (kind, value) in enumerate(rows):
        new = out[k].text.removeprefix("call ").removesuffix(", now")
        assert {x for x in pii.KINDS if out[k][f"n_{x}"]} == ({kind} if kind else set()), (value, new)
        assert (new == value) == (kind is None) and sum(out[k][f"n_{x}"] for x in pii.KINDS) == bool(kind)
        if kind in ("phone", "card"):
            assert shape(new) == shape(value) and (kind == "phone" or luhn(new))
        elif kind == "ip" and ":" in value:
            assert re.sub("[0-9a-f]", "0", new) == re.sub("[0-9a-f]", "0", value)


def test_names_of_any_form(spark):
    texts = list(NAMES)
    out = {r.doc_id: r for r in pii.replaced(frame(spark, list(enumerate(texts))), "key").collect()}
    for k, text in enumerate(texts):
        names = NAMES[text].split()
        pattern, rest = "", text
        for name in names:
            before, _, rest = rest.partition(name)
            pattern += re.escape(before) + r"([\w]+)"
        m = re.fullmatch(pattern + re.escape(rest), out[k].text)
        assert m and not set(m.groups()) & set(names) and out[k].n_name == len(names), (text, out[k].text)


def test_later_mentions_are_replaced_alike(spark):
    rows = [(1, "Smith waited. Mr. John Smith came. John Smith said so, Smith's dog too; Smithson and smith did not."), (2, "John and Smith are not named here; a.b@example.com")]
    out = {r.doc_id: r for r in pii.replaced(frame(spark, rows), "key").collect()}
    m = re.fullmatch(r"(\w+) waited\. Mr\. (\w+) (\w+) came\. (\w+) (\w+) said so, (\w+)'s dog too; Smithson and smith did not\.", out[1].text)
    first, given, family, *later = m.groups()
    assert {given, family}.isdisjoint({"John", "Smith"}) and first == family and later == [given, family, family] and out[1].n_name == 6
    assert out[2].text.startswith("John and Smith are not named here; ") and out[2].n_name == 0


def test_rows_and_columns_stay(spark):
    rows = [(1, TEXT), (2, None), (2, ""), (2, ""), (3, CLEAN), (None, "mail x.y@example.com " * 2), (4, "10.0.0.1 Mr Smith " * 20_000), (4, "10.0.0.1")]
    out = pii.replaced(frame(spark, rows), "key")
    assert out.columns == ["doc_id", "text", "extra"] + [f"n_{k}" for k in pii.KINDS]
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=str)
    assert len(got) == len(rows) and [x for x in got if x[0] in (2, 3)] == [(2, ""), (2, ""), (2, None), (3, CLEAN)]
    one, four = next(t for k, t in got if k == 1), [t for k, t in got if k == 4]
    short, long = sorted(four, key=len)
    assert short in one and long == (f"{short} Mr {re.search('Mrs. (.*?) and', one)[1]} ") * 20_000  # the same all over the table
    assert pii.replaced(frame(spark, rows).limit(0), "key").collect() == []
    assert pii.replaced(frame(spark, rows), "other").where("doc_id = 1").first().text != one
    assert pii.replaced(frame(spark, rows), "key").where("doc_id = 1").first().text == one


@pytest.mark.parametrize("kind, values", [("name-family-Latin", [f"n{i}" for i in range(3000)]), ("identity", [f"{i:03d}-11-2222" for i in range(900)]), ("phone", [f"{i:02d}" for i in range(45)])])
def test_surrogates_differ(spark, kind, values):
    """Also where first attempts collide, with each other or with values of the table."""
    df = spark.createDataFrame([(kind, v) for v in values], "kind string, value string")
    rows = pii.surrogates(df, "key").collect()
    made = [r.surrogate for r in rows]
    assert len(rows) == len(values) and len(set(made)) == len(made) and not set(made) & set(values)


def test_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    out = pii.replaced(docs, "key")
    plan = spark._jvm.PythonSQLUtils.explainString(out._jdf.queryExecution(), "formatted")
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)
    old, new = ({r.doc_id: r.text for r in df.collect()} for df in (docs, out))
    value = re.compile(r"[\w.]+@[\w.]+\w|\+1 \(\d{3}\) \d{3}-\d{4}|(?<!\d)\d{16}(?!\d)|(?<![\d.])\d+\.\d+\.\d+\.\d+")
    hit = {k for k, t in old.items() if value.search(t)}
    assert hit and {k for k in old if old[k] != new[k]} == hit
    for k in hit:
        assert shape(value.sub("", old[k])) == shape(value.sub("", new[k])) and not set(value.findall(old[k])) & set(value.findall(new[k]))
    assert out.where(F.col("n_email") > 0).count() == sum("@mail" in t for t in old.values())


def test_a_full_space_gives_longer_surrogates(spark):
    """All 676 addresses of this form occur, so every surrogate has another length; all differ."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    rows = [(26 * i + j, f"{a}@{b}.io") for i, a in enumerate(letters) for j, b in enumerate(letters)]
    out = {r.doc_id: r.text for r in pii.replaced(frame(spark, rows), "key").collect()}
    assert len(set(out.values())) == 676 and not set(out.values()) & {t for _, t in rows}
    assert all(re.fullmatch(r"[a-z]+@[a-z]\.io", t) for t in out.values())


def test_scripts(spark):
    rows = [(1, "Dr. Γεώργιος Παπαδόπουλος spoke"), (2, "write to иван@почта.рф now"), (3, "Mr. 王小明 came, 王小明 left"), (4, "Mr John Smith, JOHN SMITH and John's smith"), (5, "Dr. משה כהן here")]
    out = {r.doc_id: r.text for r in pii.replaced(frame(spark, rows), "key").collect()}
    m = re.fullmatch(r"Dr\. ([Α-Ωα-ω]+) ([Α-Ωα-ω]+) spoke", out[1])
    assert m and "Γεώργιος" not in out[1] and "Παπαδόπουλος" not in out[1]
    assert re.fullmatch(r"write to [а-я]{4}@[а-я]{5}\.рф now", out[2]) and "иван" not in out[2]
    m = re.fullmatch(r"Mr\. ([\u4e00-\u9fff]{3,}) came, ([\u4e00-\u9fff]{3,}) left", out[3])
    assert m and m[1] == m[2] != "王小明"
    m = re.fullmatch(r"Mr (\w+) (\w+), (\w+) (\w+) and (\w+)'s smith", out[4])
    assert m and (m[3], m[4], m[5]) == (m[1].upper(), m[2].upper(), m[1]) and m[1].istitle() and "John" not in out[4]
    assert re.fullmatch(r"Dr\. [\u05d0-\u05ea]{3} כהן here", out[5])


def test_any_column_names(spark):
    names = ["given", "parts", "found", "kinds", "said", "row", "before", "new", "__row", "value", "kind", "place", "a.b"]
    df = spark.createDataFrame([(TEXT, *range(len(names)))], ["text", *names])
    out = pii.replaced(df, "key")
    assert out.columns == ["text", *names, *(f"n_{k}" for k in pii.KINDS)]
    assert list(out.first())[1 : len(names) + 1] == list(range(len(names)))


def test_tables_equal_a_plain_replacement(spark):
    """All documents of sf0.01: the values that the pattern finds, by another engine, and nothing else is
    replaced; one surrogate a value all over the table, and no two values share one."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    extra = [(-1, "mail x.y@mail.example, +44 20 7946 0958 and 10.0.0.1 or 4111 1111 1111 1111; 123-45-6789"), (-2, "10.0.0.1, x.y@mail.example")]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    old = {r.doc_id: r.text for r in docs.collect()}
    rows = {r.doc_id: r for r in pii.replaced(docs, "key").collect()}
    pattern, made, counted = regex.compile(pii.ANY), {}, 0
    for key, text in old.items():
        spans = [m.span() for m in pattern.finditer(text)]
        edges = [0, *(x for span in spans for x in span), len(text)]
        parts = [text[a:b] for a, b in zip(edges[::2], edges[1::2])]
        m = re.fullmatch("(.+?)".join(map(re.escape, parts)), rows[key].text, re.S)
        assert m and sum(rows[key][f"n_{k}"] for k in pii.KINDS) == len(spans), key
        for (a, b), surrogate in zip(spans, m.groups()):
            assert made.setdefault(text[a:b], surrogate) == surrogate
        counted += len(spans)
    assert counted > 60 and len(set(made.values())) == len(made) and not set(made.values()) & set(made)
