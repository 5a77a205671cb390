import hashlib
import random
import re

from strandweave.llm import pii

from .data import DOCS, clashing, documents

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
         "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card":
                total = sum(d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits))))
                if not 16 <= len(digits) <= 19 or total % 10:
                    continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def test_base_kinds_against_the_plain_patterns():
    r = random.Random(5)
    parts = ["a", "b.c", "@", "@x.y", ".", "-", " ", "+1", "4", "12", "255", "300", "4539 1488 0343 6467", "1.2.3.4", "x@y.zz@q.r",
             "+49 (30) 123-4567", "é", "4111-1111-1111-1111", "..", "0007", "+", "(", ")"]
    for _ in range(20000):
        text = "".join(r.choice(parts) for _ in range(r.randrange(14)))
        got = [(s["kind"], s["start"], s["end"]) for s in pii.spans_of(text) if s["kind"] in pii.BASE_KINDS]
        assert got == plain_spans(text), text


def test_long_runs_take_linear_time():
    for text in ("1" * 200_000, "a" * 200_000 + " @", "1." * 100_000, "+1" * 100_000, "1 " * 100_000, "a@" * 100_000):
        pii.spans_of(text)


def test_checks_and_context():
    kinds = lambda t: {s["kind"] for s in pii.spans_of(t)}
    assert kinds("IBAN GB82 WEST 1234 5698 7654 32") >= {"iban"} and "iban" not in kinds("GB83 WEST 1234 5698 7654 32")
    assert kinds("my ssn is 078-05-1120") == {"national_id"} and kinds("see 078-05-1120") == set()
    assert kinds("amex card 378282246310005") == {"short_card"} and kinds("n 378282246310005") == set()
    assert kinds("call (212) 555-0100") == {"local_phone"} and kinds("(212) 555-0100") == set()


def found(text, kind):
    return [text[s["start"]:s["end"]] for s in pii.spans_of(text) if s["kind"] == kind]


def test_ibans_before_capitals_and_digits():
    spaced, plain, british = "DE89 3704 0044 0532 0130 00", "DE89370400440532013000", "GB82 WEST 1234 5698 7654 32"
    for one in (spaced, plain, british, "NO93 8601 1117 947", "FR14 2004 1010 0505 0001 3M02 606"):
        for before in ("", "IBAN ", "AB12 ", "DE12 "):
            for after in ("", " BIC COBADEFFXXX", " EUR", " 0427", " 12 345 EUR", " X", " Bank", ". A", " ü"):
                assert found(before + one + after, "iban") == [one], before + one + after
    assert found(f"{spaced} {plain} {british} {plain}", "iban") == [spaced, plain, british, plain]
    # a country that is not in the registry
    assert found("XY18 3704 0044 0532 01 EUR", "iban") == ["XY18 3704 0044 0532 01"]
    for none in ("DE88 3704 0044 0532 0130 00 EUR", plain + "X", plain + "x", "A" + plain, "DE89 3704 0044"):
        assert found(none, "iban") == [], none


def test_long_runs_of_groups_take_linear_time():
    for text in ("AB12 " * 100_000, "DE89 " * 100_000, "1234 " * 100_000, "A1 " * 100_000):
        pii.spans_of(text)


def test_short_cards_beside_digits():
    for one in ("378282246310005", "3782 822463 10005", "30569309025904", "4222222222222"):
        for text in (f"amex card {one} 0427", f"card {one} 04/27", f"card 77 {one}", f"card {one} 123456789", f"card {one}-{'9' * 40}"):
            assert any(one in s for s in found(text, "short_card")), text
    assert found("card 378282246310005 371449635398431", "short_card") == ["378282246310005", "371449635398431"]
    assert found("card 378282246310006 0428", "short_card") == [] and found("card 3782822463100050", "short_card") == []


def test_rows_and_redaction(spark):
    docs = clashing(documents(spark, [(9, "to a.b@c.org, card 4111 1111 1111 1111!", "en", "a", 0)]), ["pii", "spans"])
    found = pii.find_pii(docs)
    assert found.count() == docs.count() and found.columns == docs.columns
    masked = {r["doc_id"]: r["text"] for r in pii.redact(found).collect()}
    assert masked[9] == "to [EMAIL], card [CARD]!" and masked[3] is None and masked[4] == ""
    assert pii.find_pii(spark.createDataFrame([], DOCS)).count() == 0


def test_query_digests(spark, tmp_path):
    documents(spark, [(9, "x a.b@c.org +4930123456 or 10.0.0.1", "en", "a", 0)]).write.parquet(f"{tmp_path}/documents.parquet")
    for r in pii.op10_pii_spans(spark, str(tmp_path)).collect():
        assert r["n_email"] == r["n_phone"] == r["n_ip"] == (r["doc_id"] == 9) and r["n_card"] == 0
        want = "email:2:11,ip:27:35,phone:12:23" if r["doc_id"] == 9 else ""
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest() and r["spans"] == want
