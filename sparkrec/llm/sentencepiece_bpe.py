"""SentencePiece (merge-type) encoding and decoding, exact, by backtracking.

The merge procedure keeps joining the best-scored adjacent pair, the leftmost of
equals. Its result is the only token sequence in which every pair of neighbours,
merged again from characters, gives back that same pair. So the encoder need not
merge whole texts. It takes the longest piece that starts at a position (one
Aho-Corasick pass finds all pieces), checks it against the token before it by
re-merging those two alone, falls to the next shorter piece when they don't fit,
and steps back when none is left, marking the position in a bitfield so that no
path ends there again. Each position fails at most once: time is linear.

A piece never has the space mark after another character, and some characters
are in no piece at all; nothing merges across such places. Texts are cut there,
and the chunks, which repeat, are kept in a bounded cache.

Decoding joins the pieces, turns the space mark into a space, drops the one
space that encoding puts first, and decodes runs of byte pieces as UTF-8 with
one U+FFFD for each byte that doesn't belong to a character.

Defined cases: null text is empty; the empty text has no ids and decodes to the
empty text; repeated rows each give a row; an empty table gives an empty result.
There is no shuffle and no group: each task holds one Arrow batch and the cache.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame

from sparkrec.llm.common import map_rows, texts

SPACE = "▁"
CACHE_CHUNKS = 300_000
CACHE_PAIRS = 1_000_000


def load_pieces(path: str) -> dict:
    """Vocabulary of a model file: pieces, scores and kinds by id (driver side, tens of thousands of rows)."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(sp.get_piece_size())
    probe = "  A ﬁ ① "
    if sp.normalize(probe) != SPACE + probe.replace(" ", SPACE):
        raise ValueError(f"{path}: only models that keep texts as they are, with a space put first, can be read")
    kinds = ["byte" if sp.is_byte(i) else "special" if sp.is_control(i) or sp.is_unknown(i) else "piece" for i in ids]
    if any(sp.is_unused(i) for i in ids):
        raise ValueError(f"{path}: models with unused pieces can't be read")
    return {"pieces": [sp.id_to_piece(i) for i in ids], "scores": [sp.get_score(i) for i in ids], "kinds": kinds,
            "unk": sp.unk_id()}


class Codec:
    """Encoder and decoder over a vocabulary from ``load_pieces``."""

    def __init__(self, vocab: dict):
        import ahocorasick

        self.pieces, kinds = vocab["pieces"], vocab["kinds"]
        self.id_of = {p: i for i, p in enumerate(self.pieces) if kinds[i] == "piece"}
        self.score = {p: vocab["scores"][i] for p, i in self.id_of.items()}
        self.own = set(self.id_of.values())
        self.byte_id = {int(self.pieces[i][3:5], 16): i for i, k in enumerate(kinds) if k == "byte"}
        self.byte_of = {i: b for b, i in self.byte_id.items()}
        self.silent = {i for i, k in enumerate(kinds) if k == "special" and i != vocab["unk"]}
        self.unk = vocab["unk"]
        self.auto = ahocorasick.Automaton()
        for p, i in self.id_of.items():
            self.auto.add_word(p, p)
        self.auto.make_automaton()
        self.known = set().union(*self.id_of) if self.id_of else set()
        self.shorter_of: dict[str, str | None] = {}
        self.fits: dict[tuple[str, str], bool] = {}
        self.chunks: dict[str, tuple[int, str, str]] = {}
        self.cut = self._cuts()

    def _cuts(self) -> re.Pattern:
        """Chunks that no piece reaches across, as far as this vocabulary allows."""
        if any(SPACE in p.lstrip(SPACE) for p in self.id_of):
            return re.compile(r"(?s).+")
        line = "" if "\n" in self.known else "\n"
        letter, odd = re.compile(r"[^\W\d_]"), set()
        pairs = {(a, b) for p in self.id_of for a, b in zip(p, p[1:], strict=False) if letter.match(a)}
        while more := {a for a, b in pairs if a not in odd and (b in odd or not letter.match(b))}:
            odd |= more  # some piece goes on from this letter to another kind of character
        if len(odd) > 20:
            return re.compile(f"{SPACE}+[^{SPACE}{line}]*|[^{SPACE}{line}]+" + f"|{line}" * bool(line))
        odd = re.escape("".join(sorted(odd)))
        rest, word = rf"(?:[^\w{SPACE}{line}]+|[\d_{odd}]+)", rf"[^\W\d_{odd}]"  # words end before anything but letters
        return re.compile(f"{SPACE}+{rest}*{word}*|{rest}+{word}*|{word}+" + f"|{line}" * bool(line))

    # -- encoding
    def merged(self, s: str) -> list[str]:
        """The merge procedure itself, for strings of two pieces at most."""
        parts, score = list(s), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                v = score.get(parts[i] + parts[i + 1])
                if v is not None and (best is None or v > best):
                    best, at = v, i
            if best is None:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def compatible(self, a: str, b: str) -> bool:
        """Do a and b, as neighbours, come back from re-merging? a is "" at the start."""
        key = (a, b)
        known = self.fits.get(key)
        if known is None:
            if len(self.fits) >= CACHE_PAIRS:
                self.fits.clear()
            known = self.fits[key] = self.merged(a + b) == ([a, b] if a else [b])
        return known

    def shorter(self, p: str) -> str | None:
        """The longest piece (or lone character) that p starts with and that isn't p."""
        if p in self.shorter_of:
            return self.shorter_of[p]
        found = None
        for k in range(len(p) - 1, 0, -1):
            if k == 1 or p[:k] in self.id_of:
                found = p[:k]
                break
        if len(p) <= 64:
            self.shorter_of[p] = found
        return found

    def tokens(self, s: str) -> list[str]:
        """Token strings of s."""
        longest: list[str] = list(s)
        for end, p in self.auto.iter(s):  # by end, so the longest comes last
            longest[end - len(p) + 1] = p
        n, pos, out, failed, prev, fits = len(s), 0, [], 0, "", self.fits  # failed: a bit for each position
        tok = longest[0] if n else ""
        while pos < n:
            end = pos + len(tok)
            if not (failed and failed >> end & 1):
                fit = fits.get((prev, tok))
                if fit or fit is None and self.compatible(prev, tok):
                    out.append(tok)
                    pos, prev = end, tok
                    if pos < n:
                        tok = longest[pos]
                    continue
            less = self.shorter(tok)
            while less is None:  # nothing fits here: the path to this position is wrong
                failed |= 1 << pos
                tok = out.pop()
                pos -= len(tok)
                less = self.shorter(tok)
            tok, prev = less, out[-1] if out else ""
        return out

    def chunk_ids(self, s: str) -> list[int]:
        ids = []
        for t in self.tokens(s):
            i = self.id_of.get(t)
            if i is not None:
                ids.append(i)
            elif self.byte_id:
                ids.extend(self.byte_id[b] for b in t.encode("utf-8", "surrogatepass"))
            else:
                ids.append(self.unk)
        return ids

    def pieces_of(self, text: str) -> list[str]:
        return self.cut.findall(SPACE + text.replace(" ", SPACE)) if text else []

    def encode(self, text: str) -> list[int]:
        return [i for c in self.pieces_of(text) for i in self.chunk_ids(c)]

    # -- decoding
    def joined(self, ids: list[int]) -> str:
        """Pieces of the ids as text, the first space included."""
        out, run = [], bytearray()
        for i in ids:
            b = self.byte_of.get(i)
            if b is not None:
                run.append(b)
                continue
            if run:
                out.append(_utf8(run))
                run = bytearray()
            if i == self.unk:
                out.append(" ⁇ ")
            elif i not in self.silent:
                out.append(self.pieces[i].replace(SPACE, " "))
        if run:
            out.append(_utf8(run))
        return "".join(out)

    def decode(self, ids: list[int]) -> str:
        first = next((i for i in ids if i not in self.silent), self.unk)
        text = self.joined(ids)
        return text[1:] if first in self.own and self.pieces[first][0] == SPACE else text

    # -- both, for whole texts of many repeated chunks
    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of ids, ids joined by commas, decoded text."""
        get, got = self.chunks.get, []
        for c in self.pieces_of(text):
            v = get(c)
            if v is None:
                ids = self.chunk_ids(c)
                v = (len(ids), ",".join(map(str, ids)), self.joined(ids))
                if len(c) <= 64:
                    if len(self.chunks) >= CACHE_CHUNKS:
                        self.chunks.clear()
                    self.chunks[c] = v
            got.append(v)
        if not got:
            return 0, "", ""
        n, ids, parts = zip(*got, strict=True)
        return sum(n), ",".join(ids), "".join(parts)[1:]


def _utf8(run: bytearray) -> str:
    """UTF-8 text with one U+FFFD for each byte outside a character."""
    try:
        return run.decode("utf-8")
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(run):
            for k in (1, 2, 3, 4):
                try:
                    out.append(bytes(run[i:i + k]).decode("utf-8"))
                    i += k
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                i += 1
        return "".join(out)


_CODECS: dict[str, Codec] = {}


def codec(vocab: dict) -> Codec:
    """One codec for each vocabulary in a worker, kept for its next tasks."""
    key = hashlib.sha256(repr([vocab[k] for k in ("pieces", "scores", "kinds", "unk")]).encode("utf-8", "surrogatepass")).hexdigest()
    if key not in _CODECS:
        _CODECS[key] = Codec(vocab)
    return _CODECS[key]


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids array<int>): every text's token ids."""
    sc = docs.sparkSession.sparkContext
    vocab = sc.broadcast(load_pieces(model_path))  # bounded: the vocabulary

    def make():
        c = codec(vocab.value)
        return lambda b: {"doc_id": b.column("doc_id"), "ids": [c.encode(t) for t in b.column("text").to_pylist()]}

    return map_rows(texts(docs, id_col, text_col), make, "doc_id long, ids array<int>")


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give the empty text."""
    sc = encoded.sparkSession.sparkContext
    vocab = sc.broadcast(load_pieces(model_path))

    def make():
        c = codec(vocab.value)
        return lambda b: {"doc_id": b.column("doc_id"), "text": [c.decode(x or []) for x in b.column("ids").to_pylist()]}

    return map_rows(encoded.select("doc_id", "ids"), make, "doc_id long, text string")


def round_trip(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of each text's ids and of their decoding."""
    sc = docs.sparkSession.sparkContext
    vocab = sc.broadcast(load_pieces(model_path))

    def make():
        c, sha = codec(vocab.value), hashlib.sha256

        def step(b):
            n, ids, back = [], [], []
            for t in b.column("text").to_pylist():
                k, joined, decoded = c.digest(t)
                n.append(k)
                ids.append(sha(joined.encode()).hexdigest())
                back.append(sha(decoded.encode("utf-8", "surrogatepass")).hexdigest())
            return {"doc_id": b.column("doc_id"), "n_tokens": n, "ids_sha256": ids, "decoded_sha256": back}

        return step

    return map_rows(texts(docs, id_col, text_col), make,
                    "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
