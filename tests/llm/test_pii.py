import datetime
import re

import pytest

from tillpoint.llm.pii import IBAN_LENGTHS, KINDS, pseudonymise

SPANS = {
    "card": ["4041894974608795", "4041-8949-7460-8795", "4041 8949 7460 8795", "378282246310005"],
    "ip": ["42.144.35.254", "0.0.0.0", "255.255.255.255"],
    "phone": ["+1 (988) 555-2485", "(988) 555-2485", "988-555-2485", "+49 988 555 2485"],
    "ssn": ["123-45-6789"], "iban": ["GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"],
    "date": ["1980-02-29", "29.02.1980", "31/12/2399", "1600-01-01"],
    "email": ["bosbt.42@mail8.example.com", "a@b.org", "UPPER_case-9@x.de"],
}
FALSE = ["4041894974608796", "256.1.1.1", "1981-02-29", "GB83 WEST 1234 5698 7654 32", "12345", "a@b",
         "29.02/1980", "1599-12-31"]


KEY = "a key"


def run(spark, texts, key=KEY, **kw):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return sorted(pseudonymise(df, key, **kw).collect())


def luhn(digits):
    return sum(d if k % 2 == 0 else sum(divmod(2 * d, 10)) for k, d in enumerate(map(int, digits[::-1]))) % 10


def test_format_validity_and_way_back(spark):
    texts = [f"x {s}, y" for kind in SPANS for s in SPANS[kind]]
    kinds = [kind for kind in SPANS for _ in SPANS[kind]]
    new = run(spark, texts)
    for old, r, kind in zip(texts, new, kinds):
        assert r[f"n_{kind}"] == r.n_spans == 1 and r.text != old, (old, r)
        assert re.sub("[0-9]", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", r.text))) == re.sub(
            "[0-9]", "9", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", old))) or kind == "ip"
        bare = re.sub("[^0-9A-Za-z]", "", r.text[2:-3])
        if kind == "card":
            assert luhn(bare) == 0
        if kind == "iban":
            assert int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97 == 1
        if kind == "date":
            iso = r.text[2:-3] if "-" in r.text else "-".join(re.split("[./]", r.text[2:-3])[::-1])
            datetime.date.fromisoformat(iso)
    assert [r.text for r in run(spark, [r.text for r in new], back=True)] == texts


def test_invalid_spans_stay(spark):
    texts = [f"x {s}, y" for s in FALSE]
    assert [(r.text, r.n_spans) for r in run(spark, texts)] == [(t, 0) for t in texts]


def test_values_next_to_other_numbers(spark):
    values = ["4041894974608795", "42.144.35.254", "+1 (988) 555-2485", "4041 8949 7460 8795",
              "3782 822463 10005"]
    pairs = [(a, b) for a in values for b in [*values, "42", "7 apples", "12.5"]]
    for (a, b), r in zip(pairs, run(spark, [f"{a} {b}." for a, b in pairs])):
        assert r.n_spans == (2 if b in values else 1) and a not in r.text, (a, b, r)


def test_equal_values_stay_linked(spark):
    a, b, c = run(spark, ["card 4041894974608795.", "4041-8949-7460-8795 twice 4041894974608795",
                          "4041894974608795"])
    value = a.text[5:21]
    assert re.sub("-", "", b.text[:19]) == value == b.text[-16:] == c.text
    other = run(spark, ["card 4041894974608795."], key="another")[0]
    assert other.text != a.text


def test_small_domain_is_permuted(spark):
    """Dates of one cycle: the permutation is one to one."""
    start = datetime.date(2000, 1, 1)
    days = [str(start + datetime.timedelta(k)) for k in range(0, 3000)]
    out = run(spark, [" ".join(days)])[0].text.split(" ")
    assert len(set(out)) == len(days)


def test_whole_table_and_edges(spark, documents, texts, edge_docs, no_docs):
    new = {r.doc_id: r for r in pseudonymise(documents, KEY).collect()}
    assert len(new) == len(texts)
    for i, text in texts:
        cards = [m for m in re.findall(r"(?<![0-9A-Za-z])[0-9]{16}(?![0-9A-Za-z])", text) if luhn(m) == 0]
        mails = re.findall(r"[a-z.0-9]+@[a-z0-9]+\.example\.com", text)
        ips = re.findall(r"(?<![0-9A-Za-z.])(?:[0-9]{2,3}\.){3}[0-9]{2,3}(?![0-9A-Za-z.])", text)
        for value in cards + mails + ips:
            assert value not in new[i].text
        if not re.search("[0-9@]", text):
            assert new[i].text == text
    assert sorted(len(r.text) for r in pseudonymise(edge_docs, KEY).collect()) == sorted(
        len(r.text or "") for r in edge_docs.collect())
    assert pseudonymise(no_docs, KEY).count() == 0


@pytest.mark.parametrize("text", ["", "\\1 $1 \\E +1 (988) 555-2485 $0"])
def test_odd_characters(spark, text):
    assert run(spark, [run(spark, [text])[0].text], back=True)[0].text == text


def test_dates_of_timestamps_stay_linked(spark):
    texts = ["at 1980-02-29T10:00:00Z, 1980-02-29", "1980-02-29T10:00", "1980-02-29 10:00",
             "1981-02-29T10:00:00Z", "1980-02-29Tx", "x1980-02-29T10:00"]
    out = run(spark, texts)
    day = out[0].text[3:13]
    assert day != texts[0][3:13] and out[0].text == f"at {day}T10:00:00Z, {day}"
    assert (out[1].text, out[2].text) == (f"{day}T10:00", f"{day} 10:00")
    assert [r.n_date for r in out] == [2, 1, 1, 0, 0, 0]
    assert [r.text for r in out[3:]] == texts[3:]
    assert [r.text for r in run(spark, [r.text for r in out], back=True)] == texts


CARD = r"[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1(?:[0-9]{4}\1[0-9]{1,3}(?![0-9A-Za-z_])|[0-9]{1,7})|[0-9]{4}([ -])[0-9]{6}\2[0-9]{5}"


def scan(text):
    """Spans (start, end, kind) by plain loops: at each place every kind is tried on its own."""
    def mod97(bare):
        return int("".join(str(int(c, 36)) for c in bare[4:] + bare[:4])) % 97

    def card(m):
        bare = re.sub("[ -]", "", m)
        if len(bare) > 16 and re.match(r"[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4}\1", m) and luhn(bare[:16]) == 0:
            return 19
        return len(m) if 13 <= len(bare) <= 19 and luhn(bare) == 0 else 0

    def iban(m):
        return len(m) if mod97(m.replace(" ", "")) == 1 else 0

    def date(m):
        parts = m.split("-") if "-" in m else re.split("[./]", m)[::-1]
        try:
            return len(m) if 1600 <= datetime.date(*map(int, parts)).year <= 2399 else 0
        except ValueError:
            return 0

    word, number = r"(?<![A-Za-z0-9_])(?<![0-9]\.)", r"(?<![A-Za-z0-9_.+])"
    end, strict = r"(?![0-9A-Za-z_])", r"(?![0-9A-Za-z_]|[.-][0-9])"
    kinds = [
        ("email", r"(?<![A-Za-z0-9])[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9_%+-])?@[A-Za-z0-9]"
                  r"(?:[A-Za-z0-9-]{0,62}\.)+[A-Za-z]{2,24}", len),
        ("card", f"{word}(?:{CARD}){end}", card),
        ("date", f"{number}(?:[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}(?:{strict}|(?=T[0-9]{{2}}))"
                 rf"|[0-9]{{2}}([./])[0-9]{{2}}\1[0-9]{{4}}{strict})", date),
        ("ip", rf"{number}[0-9]{{1,3}}(?:\.[0-9]{{1,3}}){{3}}{strict}",
         lambda m: len(m) if max(map(int, m.split("."))) < 256 else 0),
        ("ssn", f"{number}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{strict}", len),
        ("phone", rf"{number}(?:(?:\+[0-9]{{1,3}}[ .-]?)?\([0-9]{{3}}\)[ .-]?[0-9]{{3}}[ .-]?[0-9]{{4}}"
                  r"|\+[0-9]{1,3}[ .-]?[0-9]{3}[ .-]?[0-9]{3}[ .-]?[0-9]{4}"
                  rf"|[0-9]{{3}}([-.])[0-9]{{3}}\1[0-9]{{4}}){strict}", len)]
    kinds += [("iban", f"{word}{c}[0-9]{{2}}(?: ?[A-Z0-9]){{{n - 4}}}{end}", iban)
              for n, cs in IBAN_LENGTHS.items() for c in cs.split()]
    patterns = [(k, re.compile(p), test) for k, p, test in kinds]
    out, at = [], 0
    while at < len(text):
        if text[at] in "+(" or text[at].isascii() and text[at].isalnum():
            for kind, pattern, test in patterns:
                m = pattern.match(text, at)
                if m and (size := test(m[0])):
                    out.append((at, at + size, kind))
                    at += size - 1
                    break
        at += 1
    return out


def agrees(text, row):
    """The same spans: as many of each kind, and nothing outside them is changed."""
    spans, at, pieces = scan(text), 0, []
    for a, b, kind in spans:
        pieces.append(re.escape(text[at:a]))
        pieces.append("[0-9.]{7,15}" if kind == "ip" else f".{{{b - a}}}")
        at = b
    assert re.fullmatch("".join(pieces) + re.escape(text[at:]), row.text, re.DOTALL), (text, row.text)
    assert [row[f"n_{k}"] for k in KINDS] == [sum(s[2] == k for s in spans) for k in KINDS], (text, row)
    return spans


def test_every_kind_beside_every_other(spark):
    """Neighbours on both sides, with a blank, a hyphen, a point or a comma between."""
    values = [v for kind in SPANS.values() for v in kind] + [
        "2027", "BIC COBADEFFXXX", "12", "AB", "1111 1111", "6304 0000 0000 0000 000", "5.5"]
    pairs = [f"x {a}{sep}{b} y" for a in values for b in values for sep in (" ", ", ", "-", ". ")]
    for text, row in zip(pairs, run(spark, pairs)):
        agrees(text, row)


def test_valid_values_between_others_are_replaced(spark):
    texts = ["IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX", "2027 4111 1111 1111 1111",
             "DE89 3704 0044 0532 0130 00 2027", "GB82 WEST 1234 5698 7654 32 4111 1111 1111 1111",
             "4111 1111 1111 1111 2027", "DE88 3704 0044 4111 1111 1111 1111", "4111111111111111-2027"]
    counts = [(r.n_iban, r.n_card) for r in run(spark, texts)]
    assert counts == [(1, 0), (0, 1), (1, 0), (1, 1), (0, 1), (0, 1), (0, 1)]


def test_whole_table_agrees_with_a_plain_scanner(spark, documents, texts):
    new = {r.doc_id: r for r in pseudonymise(documents, KEY).collect()}
    assert sum(len(agrees(text, new[i])) for i, text in texts) > 20
