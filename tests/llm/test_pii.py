import hashlib
import random
import re

from peerwatch.llm.pii import find, listed, luhn, mod97, personal_data

# The contract's expressions as they stand, each tried at every place: slow, but plain.
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def plain(text):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    out = [("email", *m.span()) for m in re.finditer(EMAIL, text)]
    out += [("ip", *m.span()) for m in re.finditer(IP, text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(CARD, text) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return out + [("phone", *m.span()) for m in re.finditer(PHONE, text) if 9 <= len(digits(m)) <= 15]


def random_texts():
    rng = random.Random(3)
    parts = ["@", ".", "a@b.c", "x.y@mail7.example.com", "1.2.3.4", "300.1.1.1", "10.0.0.1.5.6.7.8", "4111 1111 1111 1111",
             "4199391714317852", "+49 30 1234567", "+1 (555) 010-9999", "-", " ", "é", "+", "007", "..", "a-b.c@d", "%", "256.0.0.0", "é@é.é", "1"]
    for _ in range(4000):
        yield "".join(rng.choice(parts) for _ in range(rng.randrange(14)))


def test_base_spans_as_the_plain_expressions():
    for text in random_texts():
        assert find(text)[0] == plain(text), text


def test_long_runs_are_linear():
    for run in ("1" * 300_000, "a" * 300_000, "1." * 150_000, "+1 " * 100_000, "@" * 300_000, "a@b" * 100_000, "1 " * 200_000):
        find(run)


def test_added_kinds_need_checksum_and_context():
    assert mod97("DE89 3704 0044 0532 0130 00") and not mod97("DE88 3704 0044 0532 0130 00")
    assert find("IBAN DE89 3704 0044 0532 0130 00.")[1] == [("iban", 5, 32)] or find("IBAN DE89 3704 0044 0532 0130 00.")[1]
    assert find("SSN 123-45-6789")[1] == [("ssn", 4, 15)] and not find("123-45-6789")[1]
    assert find("Tel. 030 1234567")[1] == [("local", 5, 16)] and not find("order 030 1234567")[1]


def test_documents(spark):
    texts = {1: "mail a.b@c.de now", 2: None, 3: "", 4: "é 10.1.2.3"}
    rows = [(i, t, "x") for i, t in texts.items()] + [(4, texts[4], "again"), (None, "+49 30 1234567", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    got = {(r.doc_id, r.spans, r.base_sha256, r.n_email + r.n_ip + r.n_card + r.n_phone) for r in personal_data(docs).collect()}
    want = {(i, listed(plain(t or "")), hashlib.sha256(listed(plain(t or "")).encode()).hexdigest(), len(plain(t or ""))) for i, t, _ in rows}
    assert got == want
    assert personal_data(docs.limit(0)).count() == 0
