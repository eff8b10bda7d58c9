"""Personal data by candidate gradient boosting, in DataFrame and SQL functions only.

*Base spans* are found by fixed patterns and checks, leftmost and non-overlapping for each kind;
a match that fails its check is dropped without another try. *Candidates* come from
looser patterns that may overlap each other and the base spans. Each candidate has format and
context features (bits); whether it overlaps a base span of its kind is its weak label.
The label is what the check decides, and no feature repeats a check (octets, Luhn), so the model learns which
looks go with real data. Spark counts candidates and positives of every bit pattern over all texts;
that table is bounded by the number of patterns, and boosting trees of depth two on it is
boosting on all candidates. The trees are then one SQL expression. A kind's threshold is the lowest
score from which on at least ``PRECISION`` of ``SUPPORT`` or more candidates are positive;
without such a score nothing is added. Candidates above it that overlap no base span are added, the better-scored first.

Positions are code points, ends exclusive. Patterns are written so that neither time nor
stack grows badly with the length of a text: runs are taken possessively from their first
character (or from the end of the previous match), and separators that can't belong to a match
are replaced by others of the same length beforehand, which makes loops over groups needless.

Edge cases: null texts are empty and have no spans; an empty table yields no model and no
rows; repeated rows each get their result; other columns are kept by ``redact`` and ignored by ``spans``.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
PRECISION, SUPPORT = 0.98, 200
ROUNDS, RATE = 24, 0.3

_SPAN = "array<struct<start:int,end:int,body:string>>"
_LOCAL = "A-Za-z0-9._%+-"
# What may be personal data. Equal in effect to the patterns of the kinds, see the module's text.
_BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]+\.[A-Za-z0-9.-]+",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]+",
    "card": r"(?<![0-9\x20-])[0-9][0-9\x20-]{11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_PREPARED = {
    "email": r"regexp_replace(body, '\\.(?![A-Za-z0-9-])|(?<![A-Za-z0-9-])\\.', '%')",
    "card": r"regexp_replace(body, '[ -](?![0-9])|(?<![0-9])[ -]', '_')",
}
_IN_TEXT = {"email": "contains(body, '@')", "ip": "body rlike '[0-9][.][0-9]'", "card": "body rlike '[0-9]'", "phone": "contains(body, '+')"}
_OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
_CHECK = {
    "email": "true",
    "ip": f"x.body rlike '^{_OCTET}([.]{_OCTET}){{3}}$'",
    # Luhn: from the right, every second digit doubled, less nine if above nine
    "card": """char_length(regexp_replace(x.body, '[^0-9]', '')) between 12 and 19 and
        aggregate(transform(sequence(1, char_length(regexp_replace(x.body, '[^0-9]', ''))),
            i -> int(substring(reverse(regexp_replace(x.body, '[^0-9]', '')), i, 1)) * if(i % 2 = 0, 2, 1)),
          0, (sum, d) -> sum + if(d > 9, d - 9, d)) % 10 = 0""",
    "phone": "char_length(regexp_replace(x.body, '[^0-9]', '')) between 9 and 15",
}
_LOOSE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]{{1,64}}+ ?(?:@|\(at\)|\[at\]) ?[A-Za-z0-9-]{{1,63}}(?: ?(?:\.|\(dot\)|\[dot\]) ?[A-Za-z0-9-]{{1,63}}){{0,8}}",
    "ip": r"(?<![0-9])[0-9]{1,4}(?: ?\. ?[0-9]{1,4}){3}(?![0-9])",
    "card": r"(?<![0-9])[0-9]{3,6}(?:[ .-]?[0-9]{2,6}){2,4}(?![0-9])",
    "phone": r"(?<![0-9A-Za-z])\+?\(?[0-9]{1,4}\)?(?:[ ./-]{0,2}\(?[0-9]{2,4}\)?){2,4}(?![0-9A-Za-z])",
}
_MAY = {"email": "body rlike '@|[(\\\\[]at[)\\\\]]'", "ip": _IN_TEXT["ip"], "card": _IN_TEXT["card"], "phone": _IN_TEXT["card"]}
# Features of a candidate: x.body, with 24 characters before it (b) and one after (a).
_FEATURES = (
    "x.body rlike '[@+]'",
    "x.body rlike '[ ()/-]'",
    "x.body rlike '[.]'",
    "char_length(regexp_replace(x.body, '[^0-9]', '')) >= 12",
    "char_length(regexp_replace(x.body, '[^0-9]', '')) between 9 and 15",
    "b rlike '[A-Za-z0-9]$' or a rlike '[A-Za-z0-9]'",
    "lower(b) rlike 'mail|contact|phone|tel|call|mobil|fax|card|visa|credit|pay|host|addr|server|[^a-z]ip'",
    "x.body rlike '[.][A-Za-z]{2,}$|^[0-9]{4}[ -]?[0-9]{4}[ -]?[0-9]{4}|^[0-9]{1,3}[.][0-9]{1,3}[.]'",
)


def _lit(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _found(text: str, pattern: str) -> str:
    """SQL for all matches of a pattern with their places: from what lies between and what matches."""
    return f"""aggregate(
      zip_with(slice(split({text}, {_lit(pattern)}), 1, size(regexp_extract_all({text}, {_lit(pattern)}, 0))), regexp_extract_all({text}, {_lit(pattern)}, 0),
        (g, h) -> named_struct('gap', char_length(g), 'hit', h)),
      cast(named_struct('pos', 0, 'out', array()) as struct<pos:int,out:{_SPAN}>),
      (s, y) -> cast(named_struct('pos', s.pos + y.gap + char_length(y.hit), 'out', concat(s.out, array(named_struct(
        'start', s.pos + y.gap, 'end', s.pos + y.gap + char_length(y.hit), 'body', y.hit)))) as struct<pos:int,out:{_SPAN}>),
      s -> s.out)"""


def _none(type_: str) -> str:
    return f"cast(array() as {type_})"


def _with_base(docs: DataFrame, text: str) -> DataFrame:
    """``body`` and ``base``, the base spans as (start, kind, end), sorted."""
    docs = docs.withColumn("body", F.coalesce(F.col(text).cast("string"), F.lit("")))
    for kind in KINDS:
        shown = f"if({_IN_TEXT[kind]}, {_PREPARED.get(kind, 'body')}, '')"
        docs = docs.withColumn("shown", F.expr(shown)).withColumn(f"raw_{kind}", F.expr(f"if(shown = '', {_none(_SPAN)}, {_found('shown', _BASE[kind])})"))
    parts = ", ".join(f"transform(filter(raw_{k}, x -> {_CHECK[k]}), x -> named_struct('start', x.start, 'kind', {i}, 'end', x.end))" for i, k in enumerate(KINDS))
    return docs.withColumn("base", F.expr(f"array_sort(concat({parts}))")).drop("shown", *(f"raw_{k}" for k in KINDS))


def _with_candidates(docs: DataFrame) -> DataFrame:
    """``candidates``: (start, kind, end, bits, known), known if it overlaps a base span of its kind, other if of another."""
    for kind in KINDS:
        docs = docs.withColumn(f"raw_{kind}", F.expr(f"if({_MAY[kind]}, {_found('body', _LOOSE[kind])}, {_none(_SPAN)})"))
    bits = " + ".join(f"if({f}, {1 << i}, 0)" for i, f in enumerate(_FEATURES))
    around = "substring(body, greatest(x.start - 23, 1), least(x.start, 24)) as b, substring(body, x.end + 1, 1) as a"
    before, after = (p.rsplit(" as ", 1)[0] for p in around.split(" as b, "))
    bits = bits.replace("lower(b)", f"lower({before})").replace("b rlike", f"{before} rlike").replace("a rlike", f"{after} rlike")
    parts = ", ".join(f"""transform(raw_{k}, x -> named_struct('start', x.start, 'kind', {i}, 'end', x.end, 'bits', {bits} + {1 << (len(_FEATURES) + i)},
        'known', exists(base, s -> s.kind = {i} and s.start < x.end and x.start < s.end),
        'taken', exists(base, s -> s.start < x.end and x.start < s.end)))""" for i, k in enumerate(KINDS))
    return docs.withColumn("candidates", F.expr(f"concat({parts})")).drop(*(f"raw_{k}" for k in KINDS))


@dataclass(frozen=True)
class Model:
    """Trees as (bit, bit if set, bit if not, values of not-not, not-set, set-not, set-set) and a threshold per kind."""

    prior: float = 0.0
    trees: tuple = ()
    thresholds: dict[str, float] = field(default_factory=dict)

    def score(self, bits: int) -> float:
        return self.prior + sum(v[2 * (bits >> i & 1) + (bits >> (j, k)[1 - (bits >> i & 1)] & 1)] for i, j, k, v in self.trees)

    def sql(self, bits: str) -> str:
        on = lambda i: f"({bits} & {1 << i}) <> 0"
        return " + ".join([f"{self.prior!r}D", *(
            f"if({on(i)}, if({on(j)}, {v[3]!r}D, {v[2]!r}D), if({on(k)}, {v[1]!r}D, {v[0]!r}D))" for i, j, k, v in self.trees)])


def boost(cells: list[tuple[int, int, int]], rounds: int = ROUNDS, rate: float = RATE) -> Model:
    """Gradient boosting (log loss, Newton steps, trees of depth two) on (bits, candidates, positives)."""
    cells = sorted(cells)
    total, good = sum(c[1] for c in cells), sum(c[2] for c in cells)
    if not total:
        return Model()
    prior = math.log((good + 1) / (total - good + 1))
    score = [prior] * len(cells)
    n_bits = len(_FEATURES) + len(KINDS)
    trees = []
    for _ in range(rounds):
        p = [1 / (1 + math.exp(-s)) for s in score]
        grad = [y - n * q for (_, n, y), q in zip(cells, p, strict=True)]
        curve = [n * q * (1 - q) for (_, n, _), q in zip(cells, p, strict=True)]

        def value(part, grad=grad, curve=curve):
            g, h = sum(grad[c] for c in part), sum(curve[c] for c in part)
            return g / (h + 1.0), g * g / (h + 1.0)

        def split(part, value=value):
            """The bit that lowers the loss most, and its two sides."""
            def sides(i):
                return [c for c in part if not cells[c][0] >> i & 1], [c for c in part if cells[c][0] >> i & 1]
            best = max(range(n_bits), key=lambda i: (sum(value(s)[1] for s in sides(i)), -i))
            return best, sides(best)

        i, (low, high) = split(range(len(cells)))
        (k, low_sides), (j, high_sides) = split(low), split(high)
        leaves = [rate * value(s)[0] for s in (*low_sides, *high_sides)]
        trees.append((i, j, k, tuple(leaves)))
        for v, side in zip(leaves, (*low_sides, *high_sides), strict=True):
            for c in side:
                score[c] += v
    model, thresholds = Model(prior, tuple(trees)), {}
    for at, kind in enumerate(KINDS):
        seen = right = 0
        own = sorted(((model.score(b), n, y) for b, n, y in cells if b >> (len(_FEATURES) + at) & 1), reverse=True)
        for s, n, y in own:
            seen, right = seen + n, right + y
            if seen >= SUPPORT and right >= PRECISION * seen:
                thresholds[kind] = s - 1e-9
    return Model(prior, tuple(trees), thresholds)


def fit(docs: DataFrame, text: str = "text") -> Model:
    """Counts every candidate of ``docs`` by its bits; trees and thresholds follow from the counts."""
    found = _with_candidates(_with_base(docs.select(F.col(text).alias("text")), "text"))
    cells = (found.select(F.explode_outer("candidates").alias("c")).where("c is not null").groupBy("c.bits").agg(F.count("*").alias("n"), F.sum(F.col("c.known").cast("long")).alias("y")).collect())
    return boost([(r["bits"], r["n"], r["y"]) for r in cells])


def _with_spans(docs: DataFrame, model: Model, text: str) -> DataFrame:
    """``base`` and ``spans`` (start, kind, end), sorted."""
    docs = _with_base(docs, text)
    kinds = [k for k in KINDS if k in model.thresholds]
    if not kinds:
        return docs.withColumn("spans", F.col("base"))
    above = " or ".join(f"(x.kind = {KINDS.index(k)} and score >= {model.thresholds[k]!r}D)" for k in kinds)
    docs = _with_candidates(docs).withColumn("scored", F.expr(
        f"transform(filter(candidates, x -> not x.taken), x -> named_struct('score', {model.sql('x.bits')}, 'start', x.start, 'kind', x.kind, 'end', x.end))"))
    docs = docs.withColumn("open", F.expr(f"filter(scored, x -> {above.replace('score >=', 'x.score >=')})"))
    added = """transform(filter(open, x -> not exists(open, y -> y.start < x.end and x.start < y.end and
        (y.score > x.score or y.score = x.score and (y.start < x.start or y.start = x.start and (y.end > x.end or y.end = x.end and y.kind < x.kind))))),
        x -> named_struct('start', x.start, 'kind', x.kind, 'end', x.end))"""
    return docs.withColumn("spans", F.expr(f"array_sort(concat(base, {added}))")).drop("candidates", "scored", "open")


def _joined(spans: str) -> Column:
    names = "array(" + ", ".join(f"'{k}'" for k in KINDS) + ")"
    return F.expr(f"array_join(transform({spans}, x -> concat({names}[x.kind], ':', x.start, ':', x.end)), ',')")


def spans(docs: DataFrame, model: Model, id_: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) of every document."""
    found = _with_spans(docs.select(F.col(id_).alias("doc_id"), F.col(text).alias("text")), model, "text")
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = {i})) as long)").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(_joined("base").cast("binary"), 256).alias("base_sha256"), _joined("spans").alias("spans"))


def redact(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with each span of ``text`` replaced by ``[EMAIL]``, ``[IP]``, ``[CARD]`` or ``[PHONE]``
    (spans that overlap become one, named after the first). A null text stays null."""
    own = {c: f"kept_{i}" for i, c in enumerate(docs.columns)}  # the columns in between can't clash
    found = _with_spans(docs.select(*(F.col(f"`{c}`").alias(a) for c, a in own.items())), model, own[text])
    names = "array(" + ", ".join(f"'[{k.upper()}]'" for k in KINDS) + ")"
    new = F.expr(f"""aggregate(spans, named_struct('pos', 0, 'out', ''),
      (s, x) -> named_struct('pos', greatest(s.pos, x.end), 'out',
        if(x.start < s.pos, s.out, concat(s.out, substring(body, s.pos + 1, x.start - s.pos), {names}[x.kind]))),
      s -> concat(s.out, substring(body, s.pos + 1)))""")
    changed = F.when(F.size("spans") > 0, new).otherwise(F.col(own[text]))
    return found.select(*((changed if c == text else F.col(a)).alias(c) for c, a in own.items()))
