import hashlib
import re

from clickweave.llm.pii import BASE_KINDS, KINDS, automaton, find_pii, find_spans, luhn, show_spans

from .helpers import AWKWARD, awkward, empty

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base(text):
    """The contract's patterns, run as they stand."""
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            figures = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")):
                continue
            if kind == "card" and not (12 <= len(figures) <= 19 and luhn(figures)):
                continue
            if kind == "phone" and not 9 <= len(figures) <= 15:
                continue
            out.append((m.start(), KINDS.index(kind), m.end()))
    return sorted(out)


def found(text, anchors):
    return [s for s in find_spans(text, anchors) if s[1] < len(BASE_KINDS)]


def test_anchors_equal_the_patterns():
    from hypothesis import given, settings
    from hypothesis import strategies as st

    anchors = automaton()
    parts = ["a@b.c", "x.y@", "@", ".", "1", "25", "255", "256", "001", "+", "+1 ", "(", ")", " ", "-", "  ", "a", "é", "\n", "4111111111111111",
             "4111 1111-1111 1111", "10.0.0.1", "+49 30 123456", "%", "_", "٣", "378282246310005"]

    @settings(max_examples=1500, deadline=None)
    @given(st.lists(st.sampled_from(parts), max_size=14))
    def same(pieces):
        text = "".join(pieces)
        assert found(text, anchors) == base(text), text

    same()
    for text in ("1." * 50 + "1", "1-" * 50 + "1", "+1" * 20, "a@" * 20 + "b.c", "1 1" * 30, "0" * 300 + ".1.1.1", "1.2.3.4.5.6.7.8.9"):
        assert found(text, anchors) == base(text), text


def test_added_kinds():
    anchors = automaton()
    text = "IBAN: DE89 3704 0044 0532 0130 00, see https://bob:secret1@host.org/x and password=7602ad27cf; iban DE00 3704 0044 0532 0130 00"
    shown = show_spans([s for s in find_spans(text, anchors) if s[1] >= len(BASE_KINDS)])
    spans = {x.split(":")[0]: text[int(x.split(":")[1]) : int(x.split(":")[2])] for x in shown.split(",")}
    assert spans == {"account": "DE89 3704 0044 0532 0130 00", "url_login": "bob:secret1", "secret": "7602ad27cf"}


def test_whole_table_and_awkward_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    for frame in (docs, awkward(spark).selectExpr("*", "'x' as spans", "1 as n_ip")):
        texts = [(r.doc_id, r.text or "") for r in frame.collect()]
        want = sorted((str(i), *(sum(s[1] == k for s in base(t)) for k in range(4)), hashlib.sha256(show_spans(base(t)).encode()).hexdigest()) for i, t in texts)
        got = find_pii(frame).collect()
        assert sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in got) == want
        for r in got:
            assert r.spans or not (r.n_email + r.n_ip + r.n_card + r.n_phone)
    assert len(AWKWARD) == find_pii(awkward(spark)).count() and find_pii(empty(spark)).count() == 0


def test_the_anchors_named_exist():
    from clickweave.llm import pii

    anchors = automaton()
    first = pii.__doc__.split("A parser of")[0]
    assert all(name == "+" or anchors.exists(name) for name in re.findall("``(.+?)``", first))


def test_long_texts_of_cues_take_linear_time():
    import time

    anchors = automaton()
    for text in ("token=" * 200_000, "IBAN" * 300_000, "password:" * 150_000 + "'", "account " * 150_000, "secret = \"" * 100_000):
        began = time.time()
        spans = find_spans(text, anchors)
        assert time.time() - began < 6, text[:10]
        ends = {}
        for start, kind, end in spans:
            assert start >= ends.get(kind, 0)
            ends[kind] = end
    assert find_spans("token=" * 4000, anchors) == [(6, 6, 24_000)]


def test_ibans_end_at_the_run():
    anchors = automaton()
    code = "DE89 3704 0044 0532 0130 00"
    assert [(s, e) for s, k, e in find_spans(f"IBAN: {code} x", anchors) if k == 4] == [(6, 6 + len(code))]
    assert [(s, e) for s, k, e in find_spans(f"iban {code.replace(' ', '')}", anchors) if k == 4] == [(5, 27)]
    assert not [s for s in find_spans("iban " + code.replace(" ", "") + "A" * 60, anchors) if s[1] == 4]
