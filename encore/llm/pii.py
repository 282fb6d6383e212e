"""Personal data: proposed spans judged by boosted trees.

Base kinds (email, ip, card, phone) are found by their formats and always kept.
High-recall generators propose further spans, which may overlap: assigned values
(``name = value``), long mixed tokens, digit groups and written-out addresses. Each
proposal has format and context features with few values. Gradient-boosted trees,
fitted to a weak rule (a credential word before an assigned value or a written-out
address, against everything else proposed), give it a log odds; a proposal is redacted when its probability reaches the threshold at which the held
part of the sample shows ``precision``. The trees do not see the words of the rule,
so a value without such a word is judged by its format.

DataFrame expressions only: spans come from splitting a text at a pattern and
summing the lengths, the sample is reduced by Spark to one row per distinct feature
vector (a bounded number of them) before the trees are fitted, and the trees are
applied as CASE expressions. About ``max_texts`` texts, taken by hash, are used for
fitting; every text is searched whole.

Defined results: NULL and empty texts have no spans; offsets count code points and
ends are exclusive; repeated rows each get a row; proposals that overlap a base span
are dropped, assigned values only if it covers them; without proposals nothing is fitted and only base spans are returned;
an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

# The base kinds in order, their formats, and those of the generators.
# Each pattern starts only where a run of its first class starts, or where the last
# match ended, and does not back up inside runs, so it takes linear time.
BASE = ("email", "ip", "card", "phone")
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
NEEDS = {"email": "@", "ip": ".", "phone": "+"}  # a text without it has no such span
PROPOSALS = {
    # A quoted value ends at its quote, another at white space or where another name is assigned.
    "assigned": r"(?:(?<![A-Za-z0-9_])|\G)[A-Za-z_][A-Za-z0-9_]{1,40}+[\"']?+[\x20]?+[=:][\x20]?+"
                r"(?:\"(?:[^\"\\\n]|\\[^\n]){8,}+(?=\")|'(?:[^'\\\n]|\\[^\n]){8,}+(?=')|[\"']?+"
                r"(?:(?![&;,?|{}][\"']?+[A-Za-z_][A-Za-z0-9_]{1,40}+[\"']?+[=:])"
                r"(?:[^\x20\x09-\x0D\"']|[\"'](?![\x20\x09-\x0D,;:)\]}>\"']|$))){8,}+)",
    "token": r"(?:(?<![A-Za-z0-9_-])|\G)(?=[A-Za-z_-]*+[0-9])(?=[0-9_-]*+[A-Za-z])[A-Za-z0-9_-]{12,}+",
    "digits": r"(?:(?<![0-9])|\G)[0-9]{2,6}+(?:[ ./-][0-9]{2,6}+){1,7}+",
    "written": r"(?i)(?:(?<![a-z0-9._-])|\G)[a-z0-9._-]{2,64}+[\x20]?+[(\[]at[)\]][\x20]?+[a-z0-9-]{2,64}+(?:[\x20]?+[(\[]dot[)\]][\x20]?+[a-z0-9-]{2,64}+)++",
}
# What a text holds if a generator can match in it.
MAY_HOLD = {"assigned": "[=:]", "token": "[0-9]", "digits": "[0-9]", "written": r"[(\[][Aa][Tt][)\]]"}
CREDENTIAL = r"(?i)^(?:[a-z0-9_]*_)?(?:token|password|passwd|pwd|secret|api_?key|key|auth|credential)s?[\"']?[\x20]?[=:]"
NAME = r"^[A-Za-z_][A-Za-z0-9_]*[\"']?[\x20]?[=:][\x20]?[\"']?"
KINDS = (*BASE, "private")


def luhn(digits: Column) -> Column:
    """Whether a digit string passes the Luhn check."""
    def value(i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = d * 2
        return F.when((F.length(digits) - i) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(d)

    total = F.aggregate(F.transform(F.sequence(F.lit(1), F.length(digits)), value), F.lit(0), lambda a, x: a + x)
    return total % 10 == 0


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def _valid(kind: str, s: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(s, r"\."), lambda p: let(
            F.regexp_replace(p, "^0+", ""), lambda q: (F.length(q) < 3) | (
                (F.length(q) == 3) & (q <= F.lit("255")))))
    if kind == "card":
        return let(_digits(s), lambda d: F.when(F.length(d).between(12, 19), luhn(d)).otherwise(False))
    if kind == "phone":
        return F.length(_digits(s)).between(9, 15)
    return F.lit(True)


def matches(text: Column, pattern: str) -> Column:
    """Array of (start, end, s) of a pattern's matches, in order."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    # Between two matches lies one piece of the split text; the starts are running sums.
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,s:string>>").alias("out"))

    def spans(ms: Column, pieces: Column) -> Column:
        def step(a: Column, i: Column) -> Column:
            s = F.get(ms, i)
            return let(a["at"] + F.length(F.get(pieces, i)), lambda start: F.struct(
                (start + F.length(s)).alias("at"),
                F.array_append(a["out"], F.struct(start.alias("start"), (start + F.length(s)).alias("end"),
                                                  s.alias("s"))).alias("out")))
        return F.aggregate(F.sequence(F.lit(0), F.size(ms) - 1), zero, step, lambda a: a["out"])

    none = F.array().cast("array<struct<start:int,end:int,s:string>>")
    return let(found, lambda ms: F.when(F.size(ms) == 0, none).otherwise(
        let(F.split(text, pattern, -1), lambda pieces: spans(ms, pieces))))


def _of_kind(text: Column, k: int) -> Column:
    """(start, k, end) of the valid spans of a base kind."""
    kind = BASE[k]
    good = F.filter(matches(text, PATTERNS[kind]), lambda m: _valid(kind, m["s"]))
    return F.transform(good, lambda m: F.struct(m["start"].alias("start"), F.lit(k).alias("k"), m["end"].alias("end")))


def base_spans(text: Column) -> Column:
    """Array of (start, kind number, end) of the base kinds, ordered."""
    none = F.array().cast("array<struct<start:int,k:int,end:int>>")
    return F.sort_array(F.concat(*[
        F.when(text.contains(NEEDS[kind]) if kind in NEEDS else F.rlike(text, F.lit("[0-9]")), _of_kind(text, k))
        .otherwise(none) for k, kind in enumerate(BASE)]))


def _proposed(text: Column, g: int, pattern: str) -> Column:
    return F.transform(matches(text, pattern), lambda m: F.struct(
        m["start"].alias("start"), m["end"].alias("end"), m["s"].alias("s"), F.lit(g).alias("g"),
        F.substr(text, F.greatest(m["start"] - 7, F.lit(1)), F.least(F.lit(8), m["start"])).alias("before")))


def proposals(text: Column) -> Column:
    """Array of (start, end, s, g, before) of the generators' spans; ``before`` is
    what stands up to 8 characters ahead."""
    none = F.array().cast("array<struct<start:int,end:int,s:string,g:int,before:string>>")
    return F.concat(*[F.when(F.rlike(text, F.lit(MAY_HOLD[kind])), _proposed(text, g, p)).otherwise(none)
                      for g, (kind, p) in enumerate(PROPOSALS.items())])


def span_features(s: Column, before: Column) -> dict[str, Column]:
    """Format and context features of a span's text, small whole numbers."""
    value = F.regexp_replace(s, NAME, "")
    n = F.length(value)
    digits = F.length(F.regexp_replace(value, "[^0-9]", ""))
    letters = F.length(F.regexp_replace(value, "[^A-Za-z]", ""))
    turns = F.size(F.split(value, "(?<=[0-9])(?=[A-Za-z])|(?<=[A-Za-z])(?=[0-9])"))
    level = lambda x, cuts: reduce(lambda a, c: a + (x >= c).cast("int"), cuts, F.lit(0))
    return {
        "length": level(n, (10, 14, 18, 24, 36)),
        "digit_share": level(F.floor(100 * digits / F.greatest(n, F.lit(1))), (1, 25, 50, 75, 100)),
        "turns": level(turns, (2, 4, 6, 9)),
        "hex": F.rlike(value, F.lit("^[0-9a-f]{12,}$")).cast("int"),
        "other": level(n - digits - letters, (1, 2, 4)),
        "assigned": (n < F.length(s)).cast("int"),
        "after_colon": F.rlike(before, F.lit(r"[:=#]\s*[\"']?$")).cast("int"),
        "at": F.rlike(s, F.lit(r"(?i)[(\[]at[)\]]")).cast("int"),
    }


def _stump(rows, residual, weight, names):
    """Best split (feature, cut) of weighted rows for squared residuals, with leaf values."""
    best = None
    for f, name in enumerate(names):
        for cut in sorted({r[f] for r in rows})[1:]:
            sums = [[0.0, 0.0, 0.0], [0.0, 0.0, 0.0]]
            for r, g, (h, n) in zip(rows, residual, weight, strict=True):
                side = sums[r[f] >= cut]
                side[0] += g
                side[1] += h
                side[2] += n
            gain = sum(s[0] * s[0] / (s[1] + 1.0) for s in sums)
            if best is None or gain > best[0] + 1e-12:
                best = (gain, f, cut, [s[0] / (s[1] + 1.0) for s in sums])
    return best


def _tree(rows, residual, weight, names, depth):
    found = _stump(rows, residual, weight, names)
    if found is None:
        total = sum(residual) / (sum(h for h, _ in weight) + 1.0)
        return total
    _, f, cut, leaves = found
    if depth == 1:
        return (names[f], cut, leaves[0], leaves[1])
    sides = []
    for right in (False, True):
        keep = [i for i, r in enumerate(rows) if (r[f] >= cut) == right]
        sides.append(_tree([rows[i] for i in keep], [residual[i] for i in keep], [weight[i] for i in keep],
                           names, depth - 1))
    return (names[f], cut, *sides)


def _value(tree, row: dict) -> float:
    while isinstance(tree, tuple):
        tree = tree[3] if row[tree[0]] >= tree[1] else tree[2]
    return tree


def fit_trees(counts: list[dict], names: list[str], rounds: int = 20, depth: int = 2, rate: float = 0.4,
              precision: float = 0.9) -> tuple[float, list, float]:
    """(start, trees, threshold) of a boosted logistic model over distinct feature
    vectors with counts n_yes, n_no (fitted) and h_yes, h_no (held for the threshold)."""
    rows = [tuple(c[n] for n in names) for c in counts]
    yes, no = sum(c["n_yes"] for c in counts), sum(c["n_no"] for c in counts)
    start = math.log((yes + 0.5) / (no + 0.5))
    score, trees = [start] * len(rows), []
    for _ in range(rounds):
        p = [1 / (1 + math.exp(-s)) for s in score]
        residual = [c["n_yes"] * (1 - q) - c["n_no"] * q for c, q in zip(counts, p, strict=True)]
        weight = [((c["n_yes"] + c["n_no"]) * q * (1 - q), 1) for c, q in zip(counts, p, strict=True)]
        tree = _tree(rows, residual, weight, names, depth)
        trees.append(tree)
        score = [s + rate * _value(tree, dict(zip(names, r, strict=True))) for s, r in zip(score, rows, strict=True)]
    # The lowest score above which the held rows are right often enough.
    order = sorted(range(len(rows)), key=lambda i: -score[i])
    hit = total = 0
    threshold = None
    for i in order:
        hit += counts[i]["h_yes"]
        total += counts[i]["h_yes"] + counts[i]["h_no"]
        if total and hit / total >= precision:
            threshold = score[i]
    return start, [(rate, t) for t in trees], threshold if threshold is not None else math.inf


def _expression(tree, features: dict[str, Column]) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    return F.when(features[tree[0]] >= tree[1], _expression(tree[3], features)).otherwise(
        _expression(tree[2], features))


def log_odds(model, features: dict[str, Column]) -> Column:
    start, trees, _ = model
    return reduce(lambda a, t: a + F.lit(t[0]) * _expression(t[1], features), trees, F.lit(start))


def _overlaps(p: Column, spans: Column) -> Column:
    """Whether a base span covers an assigned value, or meets another proposal."""
    value = p["end"] - F.length(F.regexp_replace(p["s"], NAME, ""))
    assigned = p["g"] == list(PROPOSALS).index("assigned")
    return F.exists(spans, lambda b: F.when(assigned, (b["start"] <= value) & (p["end"] <= b["end"])).otherwise(
        (b["start"] < p["end"]) & (p["start"] < b["end"])))


def fit(docs: DataFrame, text: str = "text", max_texts: int = 20_000, precision: float = 0.9):
    """A model from the proposals of about ``max_texts`` texts, or None without any."""
    rows = max(docs.count(), 1)
    t = F.coalesce(F.col(text), F.lit(""))
    picked = F.pmod(F.xxhash64(t), F.lit(1_000_000)) < min(1.0, max_texts / rows) * 1_000_000
    made = (docs.where(picked).select(t.alias("t")).select(
        F.xxhash64("t").alias("h"), base_spans(F.col("t")).alias("base"), proposals(F.col("t")).alias("p"))
        .select("h", "base", F.explode("p").alias("p")).where(~_overlaps(F.col("p"), F.col("base"))))
    features = span_features(F.col("p.s"), F.col("p.before"))
    sure = F.rlike("p.s", F.lit(CREDENTIAL)) | (F.col("p.g") == list(PROPOSALS).index("written"))
    names = list(features)
    labelled = made.select(*[c.alias(n) for n, c in features.items()], sure.alias("yes"),
                           (F.pmod("h", F.lit(5)) == 0).alias("held"))
    counts = labelled.groupBy(*names).agg(*[
        F.count(F.when((F.col("yes") == y) & (F.col("held") == h), 1)).alias(a)
        for a, y, h in (("n_yes", True, False), ("n_no", False, False), ("h_yes", True, True), ("h_no", False, True))])
    found = [r.asDict() for r in counts.orderBy(*names).collect()]  # at most one row per feature vector
    return fit_trees(found, names, precision=precision) if found else None


def find_spans(docs: DataFrame, text: str = "text", out: str = "pii", model=None, **options) -> DataFrame:
    """``docs`` with ``out``: array of (start, k, end), ordered; k is the place of the
    span's kind in ``KINDS``, base kinds first."""
    model = model or fit(docs, text, **options)
    t = F.coalesce(F.col(text), F.lit(""))
    if model is None or model[2] == math.inf:
        return docs.withColumn(out, base_spans(t))

    def judged(p: Column) -> Column:
        return F.struct(log_odds(model, span_features(p["s"], p["before"])).alias("score"),
                        (-p["start"]).alias("first"), p["end"].alias("end"), p["start"].alias("start"))

    def added(base: Column) -> Column:
        free = F.filter(proposals(t), lambda p: ~_overlaps(p, base))
        good = F.filter(F.transform(free, judged), lambda p: p["score"] >= model[2])
        # Of overlapping proposals the one of the best score (the first, the longest) stays.
        best = let(good, lambda every: F.filter(every, lambda p: ~F.exists(
            every, lambda q: (q["start"] < p["end"]) & (p["start"] < q["end"]) & (q > p))))
        return F.transform(F.array_distinct(best), lambda p: F.struct(
            p["start"].alias("start"), F.lit(len(BASE)).alias("k"), p["end"].alias("end")))

    return docs.withColumn(out, let(base_spans(t), lambda base: F.sort_array(F.concat(base, added(base)))))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["k"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with every span replaced by its kind in brackets; spans that overlap
    an earlier one are cut down to what sticks out of it."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])
    state = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(a: Column, s: Column) -> Column:
        piece = F.substr(text, a["at"] + 1, F.greatest(s["start"] - a["at"], F.lit(0)))
        more = F.array_append(F.array_append(a["out"], piece), F.get(names, s["k"]))
        return F.struct(F.greatest(a["at"], s["end"]).alias("at"),
                        F.when(s["end"] > a["at"], more).otherwise(a["out"]).alias("out"))

    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        spans, state, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substr(text, a["at"] + 1, F.length(text)))))


def pii_query(docs: DataFrame) -> DataFrame:
    found = find_spans(docs.select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["k"] < len(BASE))
    counts = [F.size(F.filter("pii", _is(k))).cast("long").alias(f"n_{kind}") for k, kind in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("pii")).alias("spans"))


def _is(k: int):
    return lambda s: s["k"] == k
