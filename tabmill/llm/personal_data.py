"""Personal data in texts by weak supervision, in DataFrame functions alone.

Every match of a kind's pattern, and of looser ones (a spelled-out address, a number without its plus sign), is a candidate.
Labelers vote on candidates: the strict pattern with its check, a gazetteer (top-level domains, card issuers, calling codes,
address blocks), words before the candidate, and the characters around it. Expectation-maximisation over the counts of vote
patterns estimates how often each labeler says what about real and unreal spans, without any labels; a logistic classifier
over votes and kind is then trained on its posteriors. Spans of the strict patterns always stay; candidates that the
classifier accepts and that overlap none of them are added.

The texts are read once. The driver sees counts per vote pattern, of which there are at most 4 * 2 * 3^3 * 3.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import materialize

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("strict", "gazetteer", "context", "edges")
BEFORE = 40  # characters before a candidate that are read for its context

# Patterns. Possessive loops and look-behinds give the leftmost matches of the plain patterns in linear time.
_NAME = "[A-Za-z0-9._%+-]"
_LABEL = "[A-Za-z0-9-]"
STRICT = {
    "email": rf"(?:(?<!{_NAME})|\G){_NAME}++@{_LABEL}++(?:\.{_LABEL}++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){15,18}(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": rf"(?<!{_NAME}){_NAME}++ ?(?:\(at\)|\[at\]) ?{_LABEL}++(?: ?(?:\.|\(dot\)|\[dot\]) ?{_LABEL}++)++",
    "phone": r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[-.])[0-9]{3}[-.][0-9]{4}(?![0-9.-])",
}
HINTS = {"email": "@", "phone": "+"}  # a text without it has no strict match

# Gazetteers and context words: fixed values.
DOMAINS = "com|org|net|edu|gov|mil|int|info|biz|io|co|me|eu|de|fr|es|it|uk|us|ca|ch|at|nl|be|pl|se|no|fi|dk|pt|br|mx|ar|jp|cn|in|ru|au"
CONTEXT = {
    "email": "mail|contact|write|reach|e-mail|correo|courriel|kontakt",
    "ip": "ip|host|server|address|from|ping|login|gateway",
    "card": "card|visa|master|amex|credit|debit|karte|carte|tarjeta",
    "phone": "phone|call|tel|mobile|fax|cell|text|ring|anruf|llama",
}
AGAINST = "version|release|isbn|issn|doi|section|chapter|order|invoice|figure|page"


def _spans(df: DataFrame, text: str, pattern: str, hint: str | None, out: str) -> DataFrame:
    """All matches of a pattern as structs: start, end (in code points), text, and what is before and behind."""
    held = F.col(text).contains(hint) if hint else F.col(text).rlike("[0-9]") if "0-9" in pattern else F.lit(True)
    none = F.array().cast("array<string>")
    found = F.when(held, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(none)
    df = df.withColumn("_m", found)
    df = df.withColumn("_p", F.when(F.size("_m") > 0, F.split(text, pattern, -1)).otherwise(none))
    zipped = F.arrays_zip(F.col("_m").alias("m"), F.col("_p").alias("p"), F.slice("_p", 2, F.greatest(F.size("_p"), F.lit(1))).alias("q"))
    kind = "array<struct<start:int,end:int,text:string,before:string,behind:string>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(kind).alias("out"))

    def step(acc: Column, x: Column) -> Column:
        a = acc["at"] + F.length(x["p"])
        b = a + F.length(x["m"])
        span = F.struct(
            a.alias("start"), b.alias("end"), x["m"].alias("text"), F.lower(F.right(x["p"], F.lit(BEFORE))).alias("before"),
            F.left(x["q"], F.lit(1)).alias("behind"),
        )
        return F.when(x["m"].isNull(), acc).otherwise(F.struct(b.alias("at"), F.array_append(acc["out"], span).alias("out")))

    done = F.when(F.size("_m") > 0, F.aggregate(zipped, start, step, lambda acc: acc["out"])).otherwise(F.array().cast(kind))
    return df.withColumn(out, done).drop("_m", "_p")


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(text: Column) -> Column:
    digits = F.reverse(_digits(text))
    each = lambda i: F.substring(digits, i, F.lit(1)).cast("int")
    value = lambda i: F.when(i % 2 == 1, each(i)).otherwise(each(i) * 2 - F.when(each(i) > 4, 9).otherwise(0))
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda acc, i: acc + value(i)) % 10 == 0


def _octets(text: Column) -> Column:
    """The parts of an address without leading zeros."""
    return F.transform(F.split(text, r"\."), lambda o: F.regexp_replace(o, "^0+(?=.)", ""))


def _passes(kind: str, text: Column) -> Column:
    if kind == "ip":
        return F.forall(_octets(text), lambda o: (F.length(o) < 3) | ((F.length(o) == 3) & (o <= "255")))
    if kind == "card":
        return _luhn(text)
    if kind == "phone":
        return F.length(_digits(text)).between(8, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column) -> Column:
    return F.when(yes, 1).when(no, -1).otherwise(0).cast("int")


def _gazetteer(kind: str, text: Column) -> Column:
    if kind == "email":
        known = F.lower(text).rlike(rf"(?:\.|dot\W{{1,2}})(?:{DOMAINS})$")
    elif kind == "ip":
        first = F.element_at(_octets(text), 1)
        known = (F.length(first) < 3) & (first != "0") | first.between("100", "223") & (F.length(first) == 3)
    elif kind == "card":
        known = _digits(text).rlike("^(?:4|5[1-5]|2[2-7]|3[47]|6(?:011|5))")
    else:
        known = _digits(text).rlike("^(?:1|7|2[07]|3[0-9]|4[0-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])")
    return _vote(known, ~known)


def _voted(spans: Column, kind: str, strict: bool) -> Column:
    """Candidates with their votes; `base` marks the strict ones that pass the kind's check."""

    def one(s: Column) -> Column:
        passes = _passes(kind, s["text"]) if strict else F.lit(False)
        context = _vote(s["before"].rlike(rf"\b(?:{CONTEXT[kind]})"), s["before"].rlike(rf"\b(?:{AGAINST})"))
        glued = s["before"].rlike(r"[\p{L}\p{N}_]$") | s["behind"].rlike(r"^[\p{L}\p{N}_]")
        strong = _vote(passes, ~passes) if strict else F.lit(0)
        return F.struct(
            F.lit(KINDS.index(kind)).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), passes.alias("base"),
            strong.alias("strict"), _gazetteer(kind, s["text"]).alias("gazetteer"), context.alias("context"), _vote(~glued, glued).alias("edges"),
        )

    return F.transform(spans, one)


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with `_found`: all candidates of all kinds with their votes."""
    df = docs.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    parts = []
    for kind in KINDS:
        df = _spans(df, "_text", STRICT[kind], HINTS.get(kind), f"_strict_{kind}")
        parts.append(_voted(F.col(f"_strict_{kind}"), kind, True))
        if kind in LOOSE:
            df = _spans(df, "_text", LOOSE[kind], "at" if kind == "email" else None, f"_loose_{kind}")
            parts.append(_voted(F.col(f"_loose_{kind}"), kind, False))
    keep = [c for c in docs.columns]
    return df.select(*keep, F.concat(*parts).alias("_found"))


def estimate(patterns: list[tuple[tuple[int, ...], int, float]], rounds: int = 40) -> dict[tuple[int, ...], float]:
    """Posterior that a span is real, for vote patterns (votes, kind, count), by expectation-maximisation.

    Each labeler has its own chances of saying yes, no or nothing about real and about unreal spans. It starts from the
    majority of votes. Without patterns the result is empty.
    """
    belief = {(v, k): 0.9 if sum(v) > 0 else 0.1 for v, k, _ in patterns}
    for _ in range(rounds):
        total = {1: 1.0, 0: 1.0}
        said = {(j, y, v): 0.5 + (1.0 if (v > 0) == (y == 1) and v else 0.0) for j in range(len(LABELERS)) for y in (0, 1) for v in (-1, 0, 1)}
        for votes, kind, n in patterns:
            for y in (0, 1):
                p = n * (belief[votes, kind] if y else 1 - belief[votes, kind])
                total[y] += p
                for j, v in enumerate(votes):
                    said[j, y, v] += p
        prior = {y: total[y] / (total[0] + total[1]) for y in (0, 1)}
        sums = {(j, y): sum(said[j, y, v] for v in (-1, 0, 1)) for j in range(len(LABELERS)) for y in (0, 1)}
        for votes, kind, _ in patterns:
            log = [math.log(prior[y]) + sum(math.log(said[j, y, v] / sums[j, y]) for j, v in enumerate(votes)) for y in (0, 1)]
            belief[votes, kind] = 1 / (1 + math.exp(min(50.0, max(-50.0, log[0] - log[1]))))
    return belief


def classifier(patterns: list[tuple[tuple[int, ...], int, float]], belief: dict, steps: int = 400) -> dict[str, float]:
    """Weights of a logistic regression of the posteriors on votes and kind; without patterns it accepts nothing."""
    names = [f"{l}{v}" for l in LABELERS for v in (-1, 1)] + [f"kind{k}" for k in range(len(KINDS))]
    weight = dict.fromkeys([*names, "one"], 0.0)
    weight["one"] = -1.0
    size = sum(n for _, _, n in patterns) or 1.0
    active = [(["one", f"kind{k}", *[f"{l}{v}" for l, v in zip(LABELERS, votes) if v]], belief[votes, k], n / size) for votes, k, n in patterns]
    for _ in range(steps):
        gradient = {k: 1e-4 * w for k, w in weight.items()}
        for on, target, share in active:
            p = 1 / (1 + math.exp(-max(-50.0, min(50.0, sum(weight[f] for f in on)))))
            for f in on:
                gradient[f] += share * (p - target)
        for f, g in gradient.items():
            weight[f] -= 2.0 * g
    return weight


def _accepted(span: Column, weight: dict[str, float]) -> Column:
    total = F.lit(weight["one"])
    for k in range(len(KINDS)):
        total = total + F.when(span["kind"] == k, weight[f"kind{k}"]).otherwise(0.0)
    for l in LABELERS:
        total = total + F.when(span[l] == 1, weight[f"{l}1"]).when(span[l] == -1, weight[f"{l}-1"]).otherwise(0.0)
    return total >= 0


def find(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` without its text, with `base` and `spans`: arrays of (kind, start, end, base), by kind and start.

    Positions are code points, ends exclusive. Nulls are empty texts; empty texts and tables have no spans; repeated rows
    are treated alike. Other columns pass through unchanged.
    """
    rest = [c for c in docs.columns if c != text]
    held = materialize(candidates(docs, text).select(*rest, "_found"), "candidates")
    votes = held.select(F.explode("_found").alias("s")).groupBy("s.kind", *[f"s.{l}" for l in LABELERS]).count().collect()
    patterns = sorted((tuple(r[l] for l in LABELERS), r["kind"], float(r["count"])) for r in votes)
    weight = classifier(patterns, estimate(patterns))
    short = lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["base"].alias("base"))
    with_base = held.withColumn("base", F.transform(F.filter("_found", lambda s: s["base"]), short))
    free = lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"]))
    more = F.transform(F.filter("_found", lambda s: ~s["base"] & _accepted(s, weight) & free(s)), short)
    return with_base.select(*rest, "base", F.array_sort(F.concat("base", more)).alias("spans"))


def joined(spans: Column) -> Column:
    """kind:start:end of all spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(spans, one), ",")


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans) for every row of `docs` (doc_id, text)."""
    found = find(docs.select("doc_id", "text"))
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == KINDS.index(k))).cast("bigint").alias(f"n_{k}")
    return found.select("doc_id", *[count(k) for k in KINDS], F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def masked(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with every span of `text` replaced by its kind in brackets; overlapping spans become one.

    Rows need not be unique: texts and spans stay together. A null text stays null.
    """
    found = find(docs.withColumn("_whole", F.col(text)), text)
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    order = F.array_sort(F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    names = F.array(*[F.lit(f"[{k}]") for k in KINDS])

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(F.col("_whole"), acc["at"] + 1, s["start"] - acc["at"])
        put = F.concat(acc["out"], gap, F.element_at(names, s["kind"] + 1))
        inside = s["start"] < acc["at"]
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(inside, acc["out"]).otherwise(put).alias("out"))

    whole = F.aggregate(order, start, step, lambda acc: F.concat(acc["out"], F.substring(F.col("_whole"), acc["at"] + 1, F.length("_whole"))))
    replaced = F.when(F.size("spans") > 0, whole).otherwise(F.col("_whole"))
    return found.withColumn(text, replaced).select(*docs.columns)
