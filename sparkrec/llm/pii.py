"""Personal data, disguised or not, at its place in the source text.

Base spans come from patterns over the text as it is: e-mail addresses, IPv4
addresses, payment cards (Luhn) and phone numbers. Disguised ones are found in a
normalised text: three transducers, one after the other, write characters along
with the source interval each came from.

1. Look-alikes: full-width and other compatible forms, Cyrillic and Greek letters
   that look Latin, digits of other scripts, odd hyphens, dots, spaces; invisible
   characters vanish.
2. Disguised signs: "[at]", "(dot)", " at ... dot ..." become "@" and "."
   together with the spaces around them; "plus" before a number becomes "+".
3. Spelled digits: runs of digit words (double and triple too) become digits, and
   " dot " between groups of digits becomes ".".

The same patterns run over the result, and each match is mapped back to the
interval from the first to the last source character it came from. It is added
unless it lies within a base span of its kind.

Base patterns are leftmost and non-overlapping for each kind; failing matches are
dropped without another try. Only digits 0-9 and letters A-Z count there.

Defined cases: null text is empty; repeated rows each get a row; an empty table
gives an empty result. Map-only, one Arrow batch at a time; all scans are linear
in the text (runs are entered at their start only).
"""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

from pyspark.sql import DataFrame

from sparkrec.llm.common import map_rows, sha_hex, texts

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")  # a run of digits is entered at its start
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

# Letters of other scripts that look Latin, and signs that stand for plain ones.
LOOKS = dict(zip("аеорсухіјѕԁһӏвкмнтАВЕКМНОРСТУХІЈЅԌԛԝαονρτυικΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
                 "aeopcyxijsdhlbkmhtABEKMHOPCTYXIJSGqwaovptuikABEZHIKMNOPTYX", strict=True))
LOOKS |= dict.fromkeys("‐‑‒–—−﹘﹣", "-") | dict.fromkeys("․。．｡·∙⋅", ".") | {"﹫": "@", "＠": "@", "＋": "+"}
LOOKS |= dict.fromkeys("             　", " ")
HIDDEN = frozenset("­​‌‍⁠﻿")
DIGITS = dict(zip("zero one two three four five six seven eight nine".split(), "0123456789", strict=True)) | {"oh": "0"}
TIMES = {"double": 2, "triple": 3}

_DIGIT = "|".join([*DIGITS, *TIMES])
SPELLED = re.compile(rf"(?i)(?<![a-z])(?:{_DIGIT})(?:[\x20,-]{{1,2}}(?:{_DIGIT}|[0-9]+))+(?![a-z])")
PLUS = re.compile(r"(?i)(?<![a-z])plus[\x20]{1,2}(?=[0-9])")
# the sign in brackets of any kind, or as a word of its own between words
_LEAD = r"(?:(?<!\x20)\x20++)?"
AT = re.compile(rf"(?i){_LEAD}[\[({{<]\x20*+(?:at|@)\x20*+[\])}}>]\x20*+")
DOT = re.compile(rf"(?i){_LEAD}[\[({{<]\x20*+(?:dot|punkt|point|\.)\x20*+[\])}}>]\x20*+")
RUN = re.compile(r"[A-Za-z0-9._%+-]+")
WORDED_HOST = re.compile(r"(?i)[a-z0-9-]++(?:(?:\x20++dot\x20++|\.)[a-z0-9-]++)++")
WORD_DOT = re.compile(r"(?i)(?<!\x20)\x20++dot\x20++")
# an address in words ends in a top level: a country code, a common generic one, or another one if the address shows otherwise
TOP = frozenset("""
com net org edu gov mil int arpa info biz name pro mobi jobs travel museum coop aero asia cat tel post xxx
app dev page blog cloud online site store shop tech space website web xyz top club live life world today news media email mail
agency academy art bank bar bike bio build business cafe capital care careers cash center chat church city click clinic codes
coffee community company computer consulting cool credit data date deals delivery design digital direct directory domains earth
education energy engineering estate events exchange expert express family farm fashion film finance fit foundation fun fund fyi
gallery games garden global gmbh gold group guide guru health help host hosting house icu immo inc institute international
investments law legal link llc llp loan local lol love ltd management market marketing money network ngo ninja one ong
partners photo photography photos plus press productions properties pub recipes rent report rest restaurant reviews rocks run
school science security services show social software solar solutions studio style support systems team technology tips tools
tours town trade training university vet video vip wiki win wine work works zone example test invalid onion internal lan home
ac ad ae af ag ai al am ao aq ar as at au aw ax az ba bb bd be bf bg bh bi bj bm bn bo br bs bt bv bw by bz ca cc cd cf cg ch ci
ck cl cm cn co cr cu cv cw cx cy cz de dj dk dm do dz ec ee eg er es et eu fi fj fk fm fo fr ga gb gd ge gf gg gh gi gl gm gn gp
gq gr gs gt gu gw gy hk hm hn hr ht hu id ie il im in io iq ir is it je jm jo jp ke kg kh ki km kn kp kr kw ky kz la lb lc li lk
lr ls lt lu lv ly ma mc md me mg mh mk ml mm mn mo mp mq mr ms mt mu mv mw mx my mz na nc ne nf ng ni nl no np nr nu nz om pa pe
pf pg ph pk pl pm pn pr ps pt pw py qa re ro rs ru rw sa sb sc sd se sg sh si sj sk sl sm sn so sr ss st su sv sx sy sz tc td tf
tg th tj tk tl tm tn to tr tt tv tw tz ua ug uk us uy uz va vc ve vg vi vn vu wf ws ye yt za zm zw
""".split())
OTHER_TOP = re.compile(r"[a-z]{2,24}|xn--[a-z0-9-]+")
ARTICLES = frozenset("the a an this that these those my our your his her its their".split())
BRACKETED = re.compile(r"(?i)[\[({<]\x20*+(?:at|@|dot|punkt|point|\.)\x20*+[\])}>]")
# groups of digits, or single digit words, with dots between them
_GROUP = rf"(?:[0-9]++|{'|'.join(DIGITS)})"
DOTTED = re.compile(rf"(?i)(?<![a-z0-9]){_GROUP}(?:(?:\x20++dot\x20++|\.){_GROUP})+(?![a-z0-9])")
SPELLED_CUES = tuple(d + sep for d in [*DIGITS, *TIMES] for sep in " -,")


def _cued(text: str) -> bool:
    """May the text hold a disguise that the second and third transducer undo?"""
    low = text.lower()
    return (" dot " in low or "plus " in low or any(c in low for c in "[({<") and BRACKETED.search(low) is not None
            or any(d in low for d in SPELLED_CUES) and SPELLED.search(low) is not None)


def emails(text: str) -> list[tuple[int, int]]:
    """Matches of the local part, @ and the domain: each @ looks back over its run, not before the last match."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        if start < at and at >= last and (m := DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            last = m.end()
        at = text.find("@", at + 1)
    return out


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


def luhn(digits: str) -> bool:
    return sum(int(d) if i % 2 == 0 else sum(divmod(2 * int(d), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def _card(s: str) -> bool:
    d = s.replace(" ", "").replace("-", "")
    return 13 <= len(d) <= 19 and luhn(d)


def spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by kind as listed, then start."""
    out = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(map(_small, m.groups()))]
    out += [("card", *m.span()) for m in CARD.finditer(text) if m.end() - m.start() >= 13 and _card(m[0])]
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


# -- the transducers: (text, start, end) -> (text, start, end), where start[i] and end[i] are the source interval of character i


Tape = tuple[str, list[int], list[int]]


def tape(text: str) -> Tape:
    return text, list(range(len(text))), list(range(1, len(text) + 1))


@lru_cache(maxsize=1 << 16)
def folded(c: str) -> str:
    """What the first transducer writes for a character beyond ASCII; the character itself if it looks like no plain one."""
    if c in HIDDEN:
        return ""
    if c in LOOKS:
        return LOOKS[c]
    digit = unicodedata.digit(c, None)
    plain = str(digit) if digit is not None else unicodedata.normalize("NFKC", c)
    return plain if plain and plain.isascii() else c


def look_alikes(t: Tape) -> Tape:
    text, a, b = t
    out, x, y = [], [], []
    for i, c in enumerate(text):
        for n in c if c < "\x80" else folded(c):
            out.append(n)
            x.append(a[i])
            y.append(b[i])
    return "".join(out), x, y


def _rewritten(t: Tape, changes: list[tuple[int, int, str]]) -> Tape:
    """Replaces intervals by strings; each new character has the whole interval as its source."""
    text, a, b = t
    out, x, y, at = [], [], [], 0
    for lo, hi, new in sorted(changes):
        if lo < at or lo >= hi:
            continue
        out.append(text[at:lo] + new)
        x += a[at:lo] + [a[lo]] * len(new)
        y += b[at:lo] + [b[hi - 1]] * len(new)
        at = hi
    out.append(text[at:])
    return "".join(out), x + a[at:], y + b[at:]


def _address(local: str, host: list[str]) -> bool:
    """Is it an address in words, not prose: an unlisted top level needs a third part of the host or a sign in the local part."""
    if host[0] in ARTICLES:
        return False
    return host[-1] in TOP or OTHER_TOP.fullmatch(host[-1]) is not None and (len(host) > 2 or re.search(r"[^A-Za-z]", local) is not None)


def _worded(text: str) -> list[tuple[int, int, int, int]]:
    """(start, at, host, end) of addresses in words, leftmost and non-overlapping, with any number of parts.

    One pass over the words: each knows where the chain of words with dots between them began that it ends."""
    runs = [m.span() for m in RUN.finditer(text)]
    low = [text[a:b].lower() if b - a <= 3 else "" for a, b in runs]

    def apart(i: int) -> bool:
        """Are there spaces, and nothing else, behind run i?"""
        gap = text[runs[i][1]:runs[i + 1][0]]
        return bool(gap) and not gap.strip(" ")

    spaced = [apart(i) for i in range(len(runs) - 1)] + [False]
    first, out, free, last = list(range(len(runs))), [], 0, 0
    for i in range(len(runs) - 1):
        if i >= 2 and low[i - 1] == "dot" and spaced[i - 1] and spaced[i - 2]:
            first[i] = first[i - 2]
        if text[runs[i][1]:runs[i + 1][0]] == "@":
            host = runs[i + 1][0]
        elif low[i + 1] == "at" and spaced[i] and spaced[i + 1]:
            host = runs[i + 2][0]
        else:
            continue
        while free < len(runs) and runs[free][0] < last:
            free += 1
        start = max(first[i], first[i] + (free - first[i] + 1) // 2 * 2)  # what an address before it took is gone
        if start <= i and (m := WORDED_HOST.match(text, host)):
            last = m.end()
            out.append((runs[start][0], runs[i][1], host, last))
    return out


def signs(t: Tape) -> Tape:
    t = _rewritten(t, [(*m.span(), "@") for m in AT.finditer(t[0])] + [(*m.span(), ".") for m in DOT.finditer(t[0])])
    changes, text = [], t[0]
    for lo, at, host, end in _worded(text) if " dot " in text.lower() else ():
        dots = list(WORD_DOT.finditer(text, lo, at)) + list(WORD_DOT.finditer(text, host, end))
        if dots and _address(text[lo:at], re.split(r"\x20++dot\x20++|\.", text[host:end].lower())):
            changes += [(at, host, "@"), *((*d.span(), ".") for d in dots)]
    return _rewritten(t, changes)


def digit_words(t: Tape) -> Tape:
    """Spelled digits; each digit's source is its own word, so intervals stay narrow."""
    changes = []
    for m in SPELLED.finditer(t[0]):
        words, at = list(re.finditer(r"[A-Za-z]+|[0-9]+", m[0])), m.start()
        times = 1
        for i, w in enumerate(words):
            low = w[0].lower()
            if low in TIMES:
                times = TIMES[low]
                continue
            lo = at + (words[i - 1].start() if times > 1 else w.start())
            end = at + (words[i + 1].start() if i + 1 < len(words) else w.end())  # separators go with the word before them
            changes.append((lo, end, DIGITS.get(low, w[0]) * times))
            times = 1
    t = _digit_dots(_trimmed(t, changes))
    return _rewritten(t, [(*m.span(), "+") for m in PLUS.finditer(t[0])])


def _digit_dots(t: Tape) -> Tape:
    """" dot " between groups of digits, of which some may be single digit words."""
    changes = []
    for m in DOTTED.finditer(t[0]):
        if WORD_DOT.search(m[0]):
            changes += [(m.start() + d.start(), m.start() + d.end(), ".") for d in WORD_DOT.finditer(m[0])]
            changes += [(m.start() + w.start(), m.start() + w.end(), DIGITS[w[0].lower()])
                        for w in re.finditer(r"[A-Za-z]+", m[0]) if w[0].lower() in DIGITS]
    return _rewritten(t, changes)


def _trimmed(t: Tape, changes: list[tuple[int, int, str]]) -> Tape:
    """As ``_rewritten``, but a character's source ends before the separators that its interval ends with."""
    text, _, b = t
    ends = list(b)
    for lo, hi, _ in changes:
        last = hi
        while last > lo and text[last - 1] in " ,-":
            last -= 1
        ends[hi - 1] = b[max(last, lo + 1) - 1]
    return _rewritten((text, t[1], ends), changes)


def disguised(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) in source positions, of what shows only after normalising."""
    odd = not text.isascii() and any(folded(c) != c for c in set(text) if c >= "\x80")
    t = look_alikes(tape(text)) if odd else None
    if not odd and not _cued(text):
        return []
    t = digit_words(signs(t or tape(text)))
    return [(k, t[1][lo], t[2][hi - 1]) for k, lo, hi in spans(t[0])]


def all_spans(text: str) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
    """Base spans, and all spans, both by kind as listed, then start."""
    base = spans(text)
    more = [(k, a, b) for k, a, b in disguised(text) if not any(x == k and lo <= a and b <= hi for x, lo, hi in base)]
    return base, sorted({*base, *more}, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def joined(found: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in found)


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every document; the numbers count base spans."""
    def make():
        def step(b):
            out = {k: [] for k in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")}
            for t in b.column("text").to_pylist():
                base, every = all_spans(t)
                for k in KINDS:
                    out[f"n_{k}"].append(sum(x == k for x, _, _ in base))
                out["base_sha256"].append(sha_hex(joined(base)))
                out["spans"].append(joined(every))
            return {"doc_id": b.column("doc_id")} | out
        return step

    return map_rows(texts(docs, id_col, text_col), make,
                    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string")


def redacted(docs: DataFrame, mark: str = "[{}]") -> DataFrame:
    """(doc_id, text): every span replaced by its kind; of overlapping spans the earlier, longer one."""
    def make():
        def step(b):
            out = []
            for t in b.column("text").to_pylist():
                at, parts = 0, []
                for k, lo, hi in sorted(all_spans(t)[1], key=lambda s: (s[1], -s[2])):
                    if lo >= at:
                        parts += [t[at:lo], mark.format(k)]
                        at = hi
                out.append("".join(parts) + t[at:])
            return {"doc_id": b.column("doc_id"), "text": out}
        return step

    return map_rows(texts(docs), make, "doc_id long, text string")
