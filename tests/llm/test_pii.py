"""Spans of personal data against the plain patterns of the contract."""

import hashlib
import random
import re

from fixtures import no_docs, odd_docs

from tidemark.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    def luhn(d):
        twice = [int(c) * (2 if k % 2 else 1) for k, c in enumerate(reversed(d))]
        return sum(n - 9 if n > 9 else n for n in twice) % 10 == 0

    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    found += [("card", *m.span()) for m in CARD.finditer(text) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
    return found + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m)) <= 15]


def base(text):
    return [s[:3] for s in pii.find_spans(text) if s[0] in pii.BASE_KINDS]


def test_base_spans_equal_the_patterns():
    rng = random.Random(5)
    parts = ["a@b.c", "@", ".", "x_y@d-e.f.g", "1.2.3.4", "256.1.1.1", "001.2.3.04", "4539 1488 0343 6467", "4539148803436467",
             "+1 (234) 555-0199", "+49.", "9", "12", "-", " ", "é", "_", "+", "(", ")", "a", "日本", "\n", "..", "@@", "1.2.3", "0" * 19]
    for _ in range(20_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(9)))
        assert base(text) == plain(text), text


def test_long_runs_take_linear_time():
    text = "a" * 200_000 + "@" + "b" * 200_000 + " " + "1" * 200_000 + " " + "1." * 100_000 + "+1" * 50_000
    assert isinstance(pii.find_spans(text), list)


def test_checksums_and_context_decide_on_added_kinds():
    def kinds(text):
        return [(s[0], text[s[1]:s[2]]) for s in pii.find_spans(text)]

    assert kinds("pay DE89 3704 0044 0532 0130 00 NOW") == [("iban", "DE89 3704 0044 0532 0130 00")]
    assert kinds("pay DE88370400440532013000") == []
    assert kinds("ssn 123-45-6789") == [("ssn", "123-45-6789")]
    assert kinds("part 123-45-6789") == []
    assert kinds("call (212) 555-0188 now") == [("local_phone", "(212) 555-0188")]
    assert kinds("size 212 555 0188") == []
    assert [k for k, _ in kinds("phone +1 (212) 555-0188")] == ["phone"]


def test_digests_and_redaction_over_odd_rows(spark):
    text = "é mail a@b.co, 10.0.0.1 or 4539148803436467 x"
    docs = odd_docs(spark, [(20, text, "en", "z", 1, None, None)])
    rows = pii.pii_digests(pii.find_pii(docs)).collect()
    assert len(rows) == docs.count()
    row = next(r for r in rows if r.doc_id == 20)
    listed = ",".join(f"{k}:{a}:{b}" for k, a, b in plain(text))
    assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest() and row.spans == listed
    assert (row.n_email, row.n_ip, row.n_card, row.n_phone) == (1, 1, 1, 0)
    masked = {(r.doc_id, r.source): r for r in pii.redact(docs).collect()}
    assert masked[20, "z"].text == "é mail <EMAIL>, <IP> or <CARD> x"
    assert masked[20, "z"].n_chars == len("é mail <EMAIL>, <IP> or <CARD> x")
    assert masked[3, None].text is None
    assert pii.redact(docs).columns == docs.columns and pii.redact(docs).count() == docs.count()
    assert pii.pii_digests(pii.find_pii(no_docs(spark))).count() == 0 and pii.redact(no_docs(spark)).count() == 0


def test_many_spans_take_linear_time():
    import time

    text = "a@b.co ssn 123-45-6789 " * 20_000
    start = time.perf_counter()
    assert len(pii.find_spans(text)) == 40_000
    assert time.perf_counter() - start < 20


def test_added_spans_never_overlap_base_ones():
    rng = random.Random(11)
    parts = ["call 212-555-0188", "+1 212-555-0188", "4539 1488 0343 6467", "ssn 123-45-6789", "1.2.3.4", "iban de89370400440532013000", " ", "-", "@b.co", "5"]
    for _ in range(3000):
        spans = pii.find_spans("".join(rng.choice(parts) for _ in range(rng.randrange(8))))
        taken = [s for s in spans if s[0] in pii.BASE_KINDS]
        for kind, a, b, score in spans:
            assert 0 < score <= 1
            if kind in pii.ADDED_KINDS:
                assert score >= pii.THRESHOLD and not any(a < d and c < b for _, c, d, _ in taken)


def test_context_words_count_whole():
    def kinds(text):
        return [s[0] for s in pii.find_spans(text)]

    for word, found in (("tel", ["local_phone"]), ("hotel", []), ("cell", ["local_phone"]), ("excell", [])):
        for gap in range(30, 45):
            near = gap + len(word) <= pii.NEARBY
            assert kinds(f"{word}{' ' * gap}212 555 0188") == (found if near else []), (word, gap)
            assert kinds(f"212 555 0188{' ' * gap}{word} x") == (found if near else []), (word, gap)
    assert kinds("call 112 555 0188") == [] and kinds("call 212 155 0188") == []


def test_ibans_in_small_letters_need_context():
    def found(text):
        return [text[a:b] for k, a, b, _ in pii.find_spans(text) if k == "iban"]

    assert found("konto de89370400440532013000 oder") == ["de89370400440532013000"]
    assert found("wort de89370400440532013000 oder") == [] and found("konto de88370400440532013000") == []
    assert found("IBAN DE89 3704 0044 0532 0130 00 GB82 WEST 1234 5698 7654 32") == ["DE89 3704 0044 0532 0130 00", "GB82 WEST 1234 5698 7654 32"]


def test_scores_are_returned(spark):
    docs = spark.createDataFrame([(1, "mail a@b.co or ssn 123-45-6789"), (2, None)], "doc_id long, text string")
    rows = {r.doc_id: r for r in pii.pii_digests(pii.find_pii(docs)).collect()}
    assert rows[1].spans == "email:5:11,ssn:19:30" and rows[1].scores == "1.0,0.7" and rows[2].scores == ""


def test_secrets_need_a_context_word():
    key = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    found = lambda text: [(k, text[a:b]) for k, a, b, _ in pii.find_spans(text) if k == "secret"]
    assert found(f'token = "{key}" x') == [("secret", key)] and found(f"commit {key}") == [] and found(f"token {key}z") == []
    assert found("key " + "1" * 40) == [] and found(f"API_KEY={key.upper()}") == [("secret", key.upper())]
