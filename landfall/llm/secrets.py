"""Secrets in texts: fixed patterns, and spans of high entropy.

Base patterns are an assignment to a telling name, an access key, and a long run of
hex digits. The entropy scan slides a window over candidate strings, keeps the
count of every character in it, and corrects the Shannon entropy by the two
characters that change at each step. Each character class has a threshold of its
own. An allow-list takes out what is harmless, segment by segment: names, joined words,
numbers, identifiers in a public form; so a key in a path or behind a name is found.

Edge cases: a NULL text is an empty one and has no spans. A NULL id is kept.
Repeated rows get equal results, an empty table an empty one. Texts are scanned
whole, whatever their length. Other columns are never looked at.
"""

from __future__ import annotations

import hashlib
import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import text_of

Span = tuple[str, int, int]

# Fixed patterns of the contract. Assignments and access keys below a least length
# are matched and then dropped, so that they still use up the text they cover.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "entropy")

WINDOW = 20
CANDIDATE = re.compile(rf"[A-Za-z0-9+/_=-]{{{WINDOW},}}")
# Least bits a character in a window, by class of the string: a random one of that class
# has them but for a few in a hundred.
THRESHOLDS = {"hex": 3.0, "letters": 3.55, "alphanumeric": 3.55, "base64": 3.7}
# Allow-list: forms of public identifiers, words (also joined ones), and numbers.
PUBLIC = re.compile(r"(?<![0-9a-fA-F])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![0-9a-fA-F])")
SEGMENT = re.compile(r"[A-Za-z0-9]+")
NAME = re.compile(r"([A-Za-z]+)[0-9]{0,4}|[0-9]+")
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
# Letters that make one sound, and rows of sounds that words do not have.
SOUND = re.compile(r"sch|ch|ck|gh|ng|ph|sh|st|th|tz")
UNLIKE_WORDS = re.compile(r"[^aeiouy]{6}|[aeiouy]{5}|^[^aeiouy]{3,}$")
# Characters that are left of a stretch once the allow-list has been through it.
LEAST_LEFT = 16
_TERM = [0.0, 0.0] + [n * math.log2(n) for n in range(2, WINDOW + 1)]
_HINTS = ("passw", "secret", "token", "api")


def class_of(string: str) -> str:
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", string):
        return "hex"
    if string.isalpha():
        return "letters"
    return "alphanumeric" if string.isalnum() else "base64"


def harmless(segment: str) -> bool:
    """Whether letters and digits between two signs read as a name or a number."""
    m = NAME.fullmatch(segment)
    if m is None:
        return False
    if m[1] is None or len(m[1]) <= 4:
        return True
    parts = PART.findall(m[1])
    if len(m[1]) < 3 * len(parts):
        return False
    return not any(UNLIKE_WORDS.search(SOUND.sub("t", part.lower())) for part in parts)


def window_spans(candidate: str, threshold: float, window: int = WINDOW) -> list[tuple[int, int]]:
    """Stretches of a string that windows with at least this entropy cover."""
    counts: dict[str, int] = {}
    spent = 0.0  # sum of n * log2(n) over the counts in the window
    spans: list[tuple[int, int]] = []
    for end, new in enumerate(candidate, 1):
        n = counts.get(new, 0)
        counts[new] = n + 1
        spent += _TERM[n + 1] - _TERM[n]
        if end < window:
            continue
        if math.log2(window) - spent / window >= threshold - 1e-9:
            if spans and spans[-1][1] >= end - window:
                spans[-1] = (spans[-1][0], end)
            else:
                spans.append((end - window, end))
        old = candidate[end - window]
        n = counts[old]
        counts[old] = n - 1
        spent += _TERM[n - 1] - _TERM[n]
    return spans


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns; an assignment's span is the whole match."""
    found: list[Span] = []
    low = text.lower()
    if any(hint in low for hint in _HINTS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= 6:
                found.append(("assign", m.start(), m.end()))
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return found


def entropy_spans(text: str) -> list[Span]:
    """Stretches of high entropy in candidate strings, less what the allow-list knows of them.

    Windows slide over each long segment of a candidate, and over the candidate as a
    whole. The allow-list looks at single segments: of a stretch those go that read as
    names or numbers, at both ends, and the stretch goes if little is left of it.
    """
    found: list[Span] = []
    for m in CANDIDATE.finditer(text):
        candidate = PUBLIC.sub(lambda u: "-" * len(u[0]), m.group())
        segments = [(s.start(), s.end()) for s in SEGMENT.finditer(candidate) if not harmless(s[0])]
        if not segments:
            continue
        stretches = []
        if any(c in candidate for c in "+/_=-"):
            stretches = window_spans(candidate, THRESHOLDS["base64"])
        for start, end in segments:
            if end - start >= WINDOW:
                piece = candidate[start:end]
                spans = window_spans(piece, THRESHOLDS[class_of(piece)])
                stretches += [(start + a, start + b) for a, b in spans]
        kept: list[tuple[int, int]] = []
        for start, end in sorted(stretches):
            inside = [(max(a, start), min(b, end)) for a, b in segments if a < end and b > start]
            if sum(b - a for a, b in inside) < LEAST_LEFT:
                continue
            start, end = inside[0][0], inside[-1][1]
            if kept and start <= kept[-1][1]:
                start, before = kept.pop()
                end = max(end, before)
            kept.append((start, end))
        found += [("entropy", m.start() + a, m.start() + b) for a, b in kept]
    return found


def in_order(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def written(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


SPANS_TYPE = T.ArrayType(
    T.StructType(
        [
            T.StructField("kind", T.StringType(), False),
            T.StructField("start", T.LongType(), False),
            T.StructField("end", T.LongType(), False),
        ]
    ),
    False,
)
_SPANS_ARROW = pa.list_(
    pa.field(
        "element",
        pa.struct(
            [
                pa.field("kind", pa.string(), False),
                pa.field("start", pa.int64(), False),
                pa.field("end", pa.int64(), False),
            ]
        ),
        False,
    )
)


def secret_spans(text: str = "text") -> Column:
    """All spans of each text in order, as an array of kind, start and end (code points)."""

    @F.arrow_udf(returnType=SPANS_TYPE)
    def spans(texts: pa.Array) -> pa.Array:
        found = []
        for x in texts:
            body = x.as_py()
            each = in_order(base_spans(body) + entropy_spans(body))
            found.append([{"kind": k, "start": s, "end": e} for k, s, e in each])
        return pa.array(found, _SPANS_ARROW)

    return spans(text_of(text))


def _as_text(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )


def scan_secrets(documents: DataFrame) -> DataFrame:
    """Counts, digest and spans of every document."""
    found = documents.select("doc_id", secret_spans().alias("found"))
    of = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("found", lambda s: s["kind"] != "entropy")
    return found.select(
        "doc_id",
        *(of(kind).alias(f"n_{kind}") for kind in KINDS),
        F.sha2(_as_text(base), 256).alias("base_sha256"),
        _as_text(F.col("found")).alias("spans"),
    )


def masked(text: str, mark: str = "[SECRET]") -> str:
    """The text with each stretch that spans cover replaced by a mark."""
    out, at = [], 0
    for _, start, end in sorted(base_spans(text) + entropy_spans(text), key=lambda s: s[1]):
        if start >= at:
            out += [text[at:start], mark]
        at = max(at, end)
    return "".join(out) + text[at:] if out else text


def mask_secrets(documents: DataFrame) -> DataFrame:
    """The documents with their secrets masked and `n_chars` counted anew where a text changed.

    A NULL text stays NULL. All rows stay, with all their columns.
    """

    @F.arrow_udf(returnType=T.StringType())
    def mask(texts: pa.Array) -> pa.Array:
        return pa.array([None if (t := x.as_py()) is None else masked(t) for x in texts], pa.string())

    changed = {"text": mask(F.col("text"))}
    out = documents.withColumns(changed)
    if "n_chars" in documents.columns:
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), F.col("n_chars")))
    return out.select(*(F.col(f"`{name}`") for name in documents.columns))


def digest(spans: list[Span]) -> str:
    """The digest of spans as `base_sha256` states it."""
    return hashlib.sha256(written(spans).encode()).hexdigest()
