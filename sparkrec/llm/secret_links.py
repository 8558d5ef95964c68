"""Secret scans with multipart credential linking.

Patterns that are strong alone give base spans: assigned secrets, access key ids
and long hex strings. Other parts of a credential are weak: a user or client
name, an opaque token, a short password, an address of a service. They are
reported only when the parts that complete them are in the same scope. A scope
is an interval of the text: from a part to ``SCOPE_CHARS`` behind its end, within
its block of lines without an empty line. So two parts of a block share a scope
wherever they lie if the later one begins at most so many characters behind the
end of the earlier one. Parts are joined to the scopes that hold them (an interval
join on bins of the position), and each scope says which kinds of parts it holds.

Linked kinds: ``id`` (weak access identifier), ``key`` (weak secret) and
``endpoint``. An id is reported where a secret, weak or strong, is in its scope;
a key where an identifier is; an endpoint where both are.

Base patterns follow leftmost, non-overlapping matching for each kind; matches
that fail a kind's length are dropped and not tried again.

Defined cases: null text is empty; repeated rows each get a row (rows of one
doc_id are told apart by their texts); an empty table gives an empty result;
positions are code points, ends exclusive.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sparkrec.llm.common import hash64, map_rows, materialize, sha_hex, texts

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 12, 18, 16
BASE_KINDS = ("assign", "access", "hex")
ACCESS = re.compile(r"AKIA[A-Z0-9]{14,}")  # of 18 and more characters: a shorter run has no match of that length either
HEX = re.compile(r"[0-9a-f]{16,}")  # runs are maximal, so the same as runs of any length that are long enough

# Weak parts.
WEAK_KINDS = ("id", "key", "endpoint")
IDENT = re.compile(r"""(?i:\b(?:user(?:name)?|login|account(?:_id)?|client_?id|access_?key(?:_?id)?|key_?id))["']?\x20*[:=]\x20*["']?([A-Za-z0-9@_.-]{3,})""", re.ASCII)
SHORT = re.compile(r"""(?i:\b(?:pass(?:word|wd)?|pwd|secret|token|api_?key|credential))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=!@#$%-]{4,})""", re.ASCII)
OPAQUE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_-]{20,}={0,2}(?![A-Za-z0-9+/_=-])")
ENDPOINT = re.compile(r"(?:https?|ftp|jdbc|postgres(?:ql)?|mysql|mongodb|redis|amqp|s3)(?::[a-z]+)?://[^\s\"'<>]{3,}"
                      r"|\b(?i:host|endpoint|server|url)[\"']?\x20*[:=]\x20*[\"']?[A-Za-z0-9.-]+(?::[0-9]{2,5})?", re.ASCII)
CUES = ("user", "login", "account", "client", "access", "keyid", "key_id", "pass", "pwd", "secret", "token", "api", "credential",
        "://", "host", "endpoint", "server", "url")
SCOPE_CHARS = 2_000
BIN = 2_000
BLANK = re.compile(r"\n[\x20\t\r]*\n")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the base kinds, by start, then kind as listed."""
    out = []
    low = text.lower()
    if any(x in low for x in ("passw", "secret", "token", "api")):
        # the span is the whole match
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text)]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], BASE_KINDS.index(s[0])))


def entropy(s: str) -> float:
    return -sum(k / len(s) * math.log2(k / len(s)) for k in Counter(s).values())


def weak_parts(text: str, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """(kind, start, end) of weak parts outside the base spans."""
    low = text.lower()
    if not base and not any(x in low for x in CUES):
        return []
    starts, reach = [a for _, a, _ in base], list(accumulate((b for _, _, b in base), max))

    def free(a: int, b: int) -> bool:
        k = bisect_left(starts, b)  # base spans before k begin before b
        return not k or reach[k - 1] <= a

    out = [("id", *m.span(1)) for m in IDENT.finditer(text)]
    out += [("key", *m.span(1)) for m in SHORT.finditer(text)]
    out += [("endpoint", *m.span()) for m in ENDPOINT.finditer(text)]
    mixed = (m for m in OPAQUE.finditer(text) if re.search("[a-z]", m[0]) and re.search("[A-Z]", m[0]) and re.search("[0-9]", m[0]))
    out += [("key", *m.span()) for m in mixed if entropy(m[0]) >= 3.5]
    kept, last = [], {}
    for kind, a, b in sorted(out, key=lambda s: (s[1], -s[2])):
        if a >= last.get(kind, 0) and free(a, b):
            kept.append((kind, a, b))
            last[kind] = b
    return kept


def scopes(text: str, found: list[tuple[str, int, int]] | None = None) -> list[tuple[int, int]]:
    """From each part to SCOPE_CHARS behind its end, within its block; scopes whose parts an earlier one holds are left out."""
    if found is None:
        found = base_spans(text)
        found = found + weak_parts(text, found)
    out, spans = [], sorted((a, b) for _, a, b in found)
    starts, ends = [a for a, _ in spans], [m.start() for m in BLANK.finditer(text)] + [len(text)]
    held = 0  # parts that begin in the scopes so far
    for a, b in spans:
        hi = min(b + SCOPE_CHARS + 1, ends[bisect_right(ends, a)])
        last = bisect_left(starts, hi)
        if last > held:
            out.append((a, hi))
            held = last
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def parts(docs: DataFrame) -> DataFrame:
    """(doc_id, h, n_assign, n_access, n_hex, base_sha256, base, weak, blocks): one pass over the texts."""
    def make():
        def step(b):
            out = {k: [] for k in ("doc_id", "h", "n_assign", "n_access", "n_hex", "base_sha256", "base", "weak", "blocks")}
            for d, t in zip(b.column("doc_id").to_pylist(), b.column("text").to_pylist(), strict=True):
                base = base_spans(t)
                weak = weak_parts(t, base)
                near = scopes(t, base + weak) if weak else []
                row = (d, hash64(t) if weak else 0, *[sum(k == x for k, _, _ in base) for x in BASE_KINDS], sha_hex(joined(base)),
                       [{"kind": k, "a": x, "b": y} for k, x, y in base], [{"kind": k, "a": x, "b": y} for k, x, y in weak],
                       [{"a": x, "b": y} for x, y in near])
                for col, v in zip(out.values(), row, strict=True):
                    col.append(v)
            return out
        return step

    span = "array<struct<kind:string,a:long,b:long>>"
    return map_rows(texts(docs), make, f"doc_id long, h long, n_assign long, n_access long, n_hex long, base_sha256 string, "
                                       f"base {span}, weak {span}, blocks array<struct<a:long,b:long>>")


def linked(found: DataFrame) -> DataFrame:
    """(doc_id, h, kind, a, b): weak parts that a scope completes, from ``parts``."""
    some = found.where(F.size("weak") > 0).dropDuplicates(["doc_id", "h"])
    part = some.select("doc_id", "h", F.explode(F.concat("base", "weak")).alias("p")).select("doc_id", "h", "p.kind", "p.a", "p.b")
    part = part.withColumn("bin", F.floor(F.col("a") / BIN))
    block = some.select("doc_id", "h", F.explode("blocks").alias("s")).select("doc_id", "h", F.col("s.a").alias("lo"), F.col("s.b").alias("hi"))
    block = block.select("*", F.explode(F.sequence(F.floor(F.col("lo") / BIN), F.floor((F.col("hi") - 1) / BIN))).alias("bin"))
    # interval join: parts that begin within a scope, by bins of the position
    inside = block.join(part, ["doc_id", "h", "bin"]).where("a >= lo and a < hi")
    is_id, is_key = F.col("kind").isin("id", "access"), F.col("kind").isin("key", "assign", "hex")
    held = inside.groupBy("doc_id", "h", "lo", "hi").agg(
        F.max(is_id.cast("int")).alias("ids"), F.max(is_key.cast("int")).alias("keys"))
    weak = inside.where(F.col("kind").isin(*WEAK_KINDS)).select("doc_id", "h", "lo", "hi", "kind", "a", "b")
    complete = (F.when(F.col("kind") == "id", F.col("keys") > 0).when(F.col("kind") == "key", F.col("ids") > 0)
                .otherwise((F.col("ids") > 0) & (F.col("keys") > 0)))
    return weak.join(held, ["doc_id", "h", "lo", "hi"]).where(complete).select("doc_id", "h", "kind", "a", "b").distinct()


def scan(docs: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked) of every document."""
    found = materialize(parts(docs), "secret-parts")
    more = linked(found).groupBy("doc_id", "h").agg(F.collect_list(F.struct("kind", "a", "b")).alias("more"))  # of one text
    rows = found.join(more.withColumnRenamed("doc_id", "__d").withColumnRenamed("h", "__h"),
                      found["doc_id"].eqNullSafe(F.col("__d")) & (found["h"] == F.col("__h")), "left")
    extra = F.coalesce("more", F.array().cast("array<struct<kind:string,a:long,b:long>>"))
    order = F.array(*[F.lit(k) for k in BASE_KINDS + WEAK_KINDS])
    spans = F.transform(F.concat("base", extra), lambda s: F.struct(s["a"].alias("a"), F.array_position(order, s["kind"]).alias("o"),
                                                                     s["b"].alias("b"), s["kind"].alias("kind")))
    text = F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", s["kind"], s["a"], s["b"])), ",")
    return rows.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", text.alias("spans"), F.size(extra).cast("long").alias("n_linked"))
