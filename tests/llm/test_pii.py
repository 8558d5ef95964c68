"""Base spans against the stated patterns, and disguises mapped back to their places."""

import re
import time

import pytest

from sparkrec.llm import pii as P


def plain(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t)
            if 13 <= len(re.sub("[^0-9]", "", m[0])) <= 19 and P.luhn(re.sub("[^0-9]", "", m[0]))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


BASE = ["", "a@b.c@d.e", "a@b.c_d@e.f", "@x.y a@b a@.c a@b..c", "1.2.3.4.5.6.7.8 999.1.2.3.4 00255.1.1.1 256.1.1.1", "4111 1111-1111 1111 4111111111111112 0000000000000",
        "+1 (988) 555-2485 +1 2 +123456789012345678", "1.1.1.1é2.2.2.2", "é😀 joe@x.org 10.0.0.1", "a" * 60_000 + "@", "1" * 60_000, "1." * 20_000, "+1 " * 9_000, "a@" * 20_000]


@pytest.mark.parametrize("text", BASE, ids=lambda t: t[:12])
def test_base(text):
    if len(text) < 10_000:
        assert P.spans(text) == plain(text)
    base, every = P.all_spans(text)
    assert set(base) <= set(every)


@pytest.mark.parametrize(("text", "kind", "source"), [
    ("mail john dot smith at example dot com ok", "email", "john dot smith at example dot com"),
    ("write to john [at] example (dot) org now", "email", "john [at] example (dot) org"),
    ("call plus four four two zero seven nine four six zero nine five eight today", "phone", "plus four four two zero seven nine four six zero nine five eight"),
    ("ｊｏｈｎ＠example．com", "email", "ｊｏｈｎ＠example．com"),
    ("x jоhn@exаmple.com y", "email", "jоhn@exаmple.com"),
    ("four one one one one one one one one one one one one one one one.", "card", "four one one one one one one one one one one one one one one one"),
    ("card double four triple one 1 1 1 1 1 1 1 1 1 1 1 end", None, None),
    ("ip 10[.]0[.]0[.]7 here", "ip", "10[.]0[.]0[.]7"),
    ("a​l​ice@mail.example.com", "email", "a​l​ice@mail.example.com"),
    ("٤111 1111 1111 1111", "card", "٤111 1111 1111 1111"),
])
def test_disguises(text, kind, source):
    more = [s for s in P.all_spans(text)[1] if s not in P.spans(text)]
    if kind is None:
        assert all(0 <= a < b <= len(text) for _, a, b in more)
    else:
        assert [(k, text[a:b]) for k, a, b in more] == [(kind, source)]


@pytest.mark.parametrize(("text", "kind", "source"), [
    ("write to 𝐣𝐨𝐡𝐧@𝐞𝐱𝐚𝐦𝐩𝐥𝐞.𝐜𝐨𝐦 now", "email", "𝐣𝐨𝐡𝐧@𝐞𝐱𝐚𝐦𝐩𝐥𝐞.𝐜𝐨𝐦"),
    ("ⓙⓞⓔ@ⓧ.ⓞⓡⓖ", "email", "ⓙⓞⓔ@ⓧ.ⓞⓡⓖ"),
    ("jane@oﬃce.org", "email", "jane@oﬃce.org"),
    *[(f"mail anna at firm dot {top} please", "email", f"anna at firm dot {top}") for top in "it jp cn in ca au nl ch ru us dev ai".split()],
    ("anna dot roe at firm dot photograph, thanks", "email", "anna dot roe at firm dot photograph"),
    ("anna at mail dot firm dot insurance", "email", "anna at mail dot firm dot insurance"),
    ("host 192 dot 168 dot 0 dot 17 answers", "ip", "192 dot 168 dot 0 dot 17"),
    ("one nine two dot one six eight dot zero dot seven", "ip", "one nine two dot one six eight dot zero dot seven"),
    ("10 dot 0.0 dot 7", "ip", "10 dot 0.0 dot 7"),
    ("ring +1 dot 988 dot 555 dot 2485", "phone", "+1 dot 988 dot 555 dot 2485"),
])
def test_disguises_of_any_fold_top_level_and_dotted_numbers(text, kind, source):
    test_disguises(text, kind, source)


@pytest.mark.parametrize("text", ["she pointed at polka dot dresses", "he looked at the dot in the picture", "version 2 dot 1 is out", "wait…", "brand™ ½ ﬁne"])
def test_more_prose_stays_clean(text):
    assert P.all_spans(text) == ([], [])


@pytest.mark.parametrize("text", ["look at the dot com bubble", "one two three go", "at noon (at home) dot matrix", "naïve café — “quotes” · dots…", "x at y", "seven of nine"])
def test_prose_stays_clean(text):
    assert P.all_spans(text) == ([], [])


def test_query_rows(make_docs):
    rows = [(1, None), (2, "joe@x.org and 10.0.0.1"), (2, "joe@x.org and 10.0.0.1"), (None, "+1 (988) 555-2485"), (3, "jane at x dot org")]
    got = sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256, r.spans) for r in P.scan(make_docs(rows)).collect())
    want = []
    for d, t in rows:
        base, every = P.all_spans(t or "")
        want.append((str(d), *[sum(k == x for x, _, _ in base) for k in P.KINDS], P.sha_hex(P.joined(base)), P.joined(every)))
    assert got == sorted(want)
    assert [w[-1] for w in want] == ["", "email:0:9,ip:14:22", "email:0:9,ip:14:22", "phone:0:17", "email:0:17"]
    assert P.scan(make_docs([])).count() == 0
    assert {r.text for r in P.redacted(make_docs(rows)).collect()} == {"", "[email] and [ip]", "[phone]", "[email]"}


@pytest.mark.parametrize("source", [
    "a dot b dot c dot d dot e dot f at mail dot example dot com",
    "anna at one dot two dot three dot four dot five dot six dot com",
    "anna   at   firm    dot   org", "anna    [  at  ]   firm   (   dot )    org",
    "x" * 80 + " at firm dot org", "joe@mail   dot firm dot org"])
def test_any_number_of_parts_and_spaces(source):
    text = f"write to: {source}, soon"
    lo = text.index(source)
    assert ("email", lo, lo + len(source)) in P.all_spans(text)[1]


def test_addresses_in_words_do_not_overlap():
    text = "a dot b at c dot com dot d at e dot org dot f"
    assert P._worded(text) == [(0, text.index(" at"), text.index("c dot"), text.index(" at e"))]
    text = "ann at firm dot org or bob dot lee at home dot net"
    assert [text[a:b] for a, _, _, b in P._worded(text)] == ["ann at firm dot org or bob dot lee"[:19], "bob dot lee at home dot net"]


@pytest.mark.parametrize("unit", ["a dot ", "at dot ", "dot ", " ", "a at ", "one ", "[ ", "1 dot ", "a@b dot ", "plus  "])
def test_long_repeats_take_time_in_proportion(unit):
    times = []
    for n in (20_000, 160_000):
        start = time.perf_counter()
        P.all_spans(unit * (n // len(unit)) + " dot [at] one two")
        times.append(time.perf_counter() - start)
    assert times[1] < 30 * times[0] + 0.5
