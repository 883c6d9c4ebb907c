"""Personal data by rules and by bootstrapped contexts.

Rules find e-mail addresses, IP addresses, card and phone numbers. These, and strings whose
shape alone tells an identifier (``SHAPES``), are the seeds of a bootstrap. Places are the
rules' matches and all candidates: words with a digit, runs of them a space apart, and
whatever is assigned to a name (``name = "value"``, ``name: value``). The lexical patterns
of a place are the one, two and three words to its left (line breaks count as words, and
what is attached to the place before it as one), and the nearest ones on both sides. Spark
holds the graph of patterns and instances (distinct values) and scores it in rounds: a
pattern is trusted if it holds enough distinct known identifiers and these are most of its
instances; an instance becomes known when a trusted pattern holds it. Candidates that a
trusted pattern holds are the discovered identifiers.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keyline.llm.common import materialize, table

KINDS = ("email", "ip", "card", "phone", "id")  # "id": found by context
KNOWN_VALUES = 5  # distinct known identifiers that a trusted pattern holds at least
PRECISION = 0.6  # share of known ones among the distinct values of a trusted pattern

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# The look-behind and possessive runs change no match; they keep long runs linear.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
NOT_DIGIT = re.compile(r"[^0-9]+")
IDENTIFIER = re.compile(r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]++")
TOKEN = r"(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]++"
GROUPS = re.compile(rf"(?<![A-Za-z0-9_-]){TOKEN}(?: {TOKEN})++")
ASSIGNED = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z_][A-Za-z0-9_-]*+[ \t]*+[:=][ \t]*+[\"']?+([^\s\"',;]++)")
CANDIDATES = ((IDENTIFIER, 0), (GROUPS, 0), (ASSIGNED, 1))
# Shapes that tell an identifier by themselves.
SHAPES = re.compile(
    r"(?=[0-9]*[a-f])(?=[a-f]*[0-9])[0-9a-f]{32,}"
    r"|[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}"
    r"|AKIA[0-9A-Z]{16}|gh[opsu]_[0-9A-Za-z]{36}"
)
WORD = re.compile(r"\S+")
DIGITS = re.compile(r"[0-9]+")
KEY_CHARS = 64  # a longer word or value is known by its digest


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each "@" with the run of local characters before it (not into an earlier match) and
    a dotted domain after it."""
    free, at = 0, text.find("@")
    while at >= 0:
        run = text[free:at]
        start = at - (len(run) - len(run.rstrip(LOCAL)))
        m = DOMAIN.match(text, at + 1) if start < at else None
        free = m.end() if m else at + 1
        if m:
            yield start, m.end()
        at = text.find("@", free)


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the rules' matches, by start, then kind."""
    out = [(s, 0, e) for s, e in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append((m.start(), 1, m.end()))
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m.group())
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    for m in PHONE.finditer(text):
        if 9 <= len(NOT_DIGIT.sub("", m.group())) <= 15:
            out.append((m.start(), 3, m.end()))
    return sorted(out)


def _key(word: str) -> str:
    """A word or value of bounded length: itself, or a digest that is longer."""
    return word if len(word) <= KEY_CHARS else "sha256:" + hashlib.sha256(word.encode("utf-8", "surrogatepass")).hexdigest()


class _Words:
    """The words of a text, for the patterns around its places."""

    def __init__(self, text: str):
        self.text = text
        self.spans = [m.span() for m in WORD.finditer(text)]
        self.starts = [a for a, _ in self.spans]
        self._keys: dict[int, str] = {}
        self._breaks: dict[int, bool] = {}

    def _key(self, a: int, b: int) -> str:
        return _key(DIGITS.sub("0", self.text[a:b].lower()))

    def _word(self, at: int) -> str:
        if at not in self._keys:
            self._keys[at] = self._key(*self.spans[at])
        return self._keys[at]

    def _broken(self, at: int) -> bool:
        """Whether a line break lies before word ``at``."""
        if at not in self._breaks:
            before = self.spans[at - 1][1] if at else 0
            self._breaks[at] = self.text.find("\n", before, self.spans[at][0]) >= 0
        return self._breaks[at]

    def _side(self, at: int, step: int, n: int) -> list[str]:
        """Up to ``n`` words from word ``at`` on, line breaks among them, nearest first."""
        out: list[str] = []
        while len(out) < n and 0 <= at < len(self.spans):
            if self._broken(at + 1 if step < 0 else at):
                out.append("\n")
            out.append(self._word(at))
            at += step
        return out[:n]

    def patterns(self, start: int, end: int) -> list[str]:
        """The patterns of the place, from one word to both sides; none for a whole text."""
        first = bisect_right(self.starts, start) - 1
        last = bisect_right(self.starts, end - 1) - 1
        a, b = self.spans[first][0], self.spans[last][1]
        # What is attached to the place, its nearest characters, is a word of its own.
        left = ([self._key(max(a, start - KEY_CHARS), start)] if a < start else []) + self._side(first - 1, -1, 3)
        right = ([self._key(end, min(b, end + KEY_CHARS))] if end < b else []) + self._side(last + 1, 1, 2)
        out = [" ".join(reversed(left[:n])) + " *" for n in range(1, min(3, len(left)) + 1)]
        if right:
            out.append(" ".join([*reversed(left[:1]), "*", *right[: 1 if left else 2]]))
        return out


def places(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, list[str], str, bool, bool]]:
    """``(start, end, patterns, value, known, by rule)``: the rules' spans and the candidates
    that overlap none."""
    words = _Words(text)
    held = {(s, e): True for s, _, e in spans}
    for pattern, group in CANDIDATES:
        for place in _candidates(pattern, group, text, spans):
            held.setdefault(place, False)
    out = []
    for (s, e), rule in held.items():
        value = text[s:e]
        out.append((s, e, words.patterns(s, e), _key(value.lower()), rule or SHAPES.fullmatch(value) is not None, rule))
    return out


def _candidates(pattern: re.Pattern, group: int, text: str, spans: list[tuple[int, int, int]]) -> Iterator[tuple[int, int]]:
    """Places of ``pattern`` that overlap no span."""
    covered, reach, at = sorted((s, e) for s, _, e in spans), 0, 0
    for m in pattern.finditer(text):
        start, end = m.span(group)
        while at < len(covered) and covered[at][0] < end:
            reach = max(reach, covered[at][1])
            at += 1
        if reach <= start:
            yield start, end


_SPAN = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
_PLACE = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("patterns", pa.list_(pa.string())), ("value", pa.string()), ("known", pa.bool_()), ("rule", pa.bool_())])
FOUND = (
    "row long, doc_id long, base array<struct<start:long,kind:int,end:long>>, "
    "places array<struct<start:long,end:long,patterns:array<string>,value:string,known:boolean,rule:boolean>>, base_sha256 string"
)


def _found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    row = TaskContext.get().partitionId() << 40
    for batch in batches:
        base, around, digests = [], [], []
        for text in batch.column(1).to_pylist():
            spans = base_spans(text) if text else []
            base.append([{"start": s, "kind": k, "end": e} for s, k, e in spans])
            around.append([dict(zip(("start", "end", "patterns", "value", "known", "rule"), p)) for p in places(text, spans)] if text else [])
            digests.append(hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest())
        n = len(base)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(row, row + n), pa.int64()), batch.column(0), pa.array(base, pa.list_(_SPAN)), pa.array(around, pa.list_(_PLACE)), pa.array(digests)],
            names=["row", "doc_id", "base", "places", "base_sha256"],
        )
        row += n


def trusted_patterns(edges: DataFrame, rounds: int | None = None) -> DataFrame:
    """``pattern, score`` from the graph ``edges(pattern, value, known)``, each pair once.

    The score is the share of known values among all values of the pattern. Only patterns
    that hold ``KNOWN_VALUES`` known ones can be trusted in any round, and what a pattern
    holds only grows, so the rounds go on until nothing changes (or ``rounds`` are done).
    Joins are by shuffle: neither table has a bound.
    """
    known = edges.filter("known").select("value").distinct()
    trusted = None
    for done in itertools.count(1):
        marked = edges.join(known.withColumn("is_known", F.lit(True)).hint("merge"), "value", "left")
        scores = marked.groupBy("pattern").agg(F.count("*").alias("n"), F.count("is_known").alias("hits"))
        trusted = scores.filter((F.col("hits") >= KNOWN_VALUES) & (F.col("hits") >= PRECISION * F.col("n")))
        trusted = materialize(trusted.select("pattern", (F.col("hits") / F.col("n")).alias("score")), "pii-patterns")
        more = edges.join(trusted.hint("merge"), "pattern", "left_semi").select("value")
        grown = materialize(known.union(more).distinct(), "pii-known")
        if done == rounds or grown.count() == known.count():
            break
        known = grown
    return trusted


def find_pii(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", rounds: int | None = None) -> DataFrame:
    """``doc_id, spans, base, base_sha256`` for every row: arrays of ``(start, kind, end)``
    in code points, end exclusive, by start, then kind; ``base`` has the rules' alone.

    Null text counts as empty and has no spans. Texts of any length are searched whole.
    Rules apply to each row by itself, so repeated rows give the same base spans; a place
    that is the whole text has no pattern. Of ``id`` spans that lie in one another the
    longest stays; none overlaps a base span. Null ids stay null. An empty table gives an
    empty result; other columns are ignored.
    """
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    found = materialize(docs.mapInArrow(_found, FOUND), "pii-found")
    at = found.filter(F.size("places") > 0).select("row", F.explode("places").alias("place")).select("row", "place.*")
    at = at.withColumn("pattern", F.explode("patterns")).drop("patterns")
    edges = at.groupBy("pattern", "value").agg(F.max("known").alias("known"))
    trusted = trusted_patterns(materialize(edges, "pii-edges"), rounds)
    held = at.filter("not rule").join(trusted.hint("merge"), "pattern", "left_semi").select("row", "start", "end").distinct()
    extra = held.groupBy("row").agg(F.collect_list(F.struct("start", F.lit(KINDS.index("id")).alias("kind"), "end")).alias("extra"))
    wider = lambda x, y: (y["start"] <= x["start"]) & (y["end"] >= x["end"]) & (y != x)
    extra = extra.select("row", F.filter("extra", lambda x: ~F.exists("extra", lambda y: wider(x, y))).alias("extra"))
    spans = F.array_sort(F.when(F.col("extra").isNull(), F.col("base")).otherwise(F.concat("base", "extra")))
    return found.join(extra, "row", "left").select("doc_id", spans.alias("spans"), "base", "base_sha256")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    names = F.array(*[F.lit(k) for k in KINDS])
    text = F.transform("spans", lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")))
    count_of = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    counts = [count_of(k).alias(f"n_{KINDS[k]}") for k in range(4)]
    return found.select("doc_id", *counts, "base_sha256", F.array_join(text, ",").alias("spans"))
