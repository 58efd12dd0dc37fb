"""Operator 9, PII: overlapping candidates, boosted trees, calibrated thresholds.

Built-in functions only.  The trees are fitted on counts of distinct feature vectors,
of which there are at most ``VECTORS`` whatever the input, and are written as SQL
expressions.
"""

from __future__ import annotations

from itertools import groupby
from math import exp, inf, log

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

# The patterns of the base spans.  Repeats that cannot match in another
# way are possessive, and a match begins where a run begins or the last match ended, so
# that long runs are read once.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[\x20-]?[0-9]){11,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}

# High-recall generators: what the base rules pass over because something is glued to
# it, spelled out, or grouped in another way.
MORE = {
    "email": r"(?i)(?<![a-z0-9._%+-])[a-z0-9][a-z0-9._%+-]{0,63}+\x20?[\[({]at[\])}]\x20?[a-z0-9-]{1,63}+(?:\x20?(?:[\[({]dot[\])}]|\.)\x20?[a-z0-9-]{1,63}+){1,8}+",
    "ip": r"(?<![0-9])[0-9]{1,3}+(?:\.[0-9]{1,3}+){3}(?![0-9])",
    "card": r"(?<![0-9])(?:[0-9]{12,19}+|[0-9]{4}(?:[\x20.-][0-9]{4}){3}|3[0-9]{3}[\x20-][0-9]{6}[\x20-][0-9]{5})(?![0-9])",
    "phone": r"(?<![0-9+])(?:\+?[0-9]{1,3}[\x20.-]?)?(?:\([0-9]{3}\)|[0-9]{3})[\x20.-]?[0-9]{3}[\x20.-][0-9]{4}(?![0-9])",
}

# Cheap tests that a text must pass before a pattern is tried on it.
NEEDS = {"email": "@|(?i)[\\[({]at[\\])}]", "ip": "[0-9]\\.[0-9]", "card": "[0-9][\\x20.-]?[0-9]", "phone": "[0-9][\\x20.-][0-9]|\\+[0-9]|\\)"}

HINT = r"(?i)(?:mail|contact|call|phone|tel|fax|mobile|card|visa|pay|ip|host|addr|server)[^a-z0-9]{0,4}$"
FEATURES = ("kind", "digits", "luhn", "octets", "plus", "paren", "spaced", "glued_left", "glued_right", "hint")
VECTORS = 4 * 7 * 2**8
CONTEXT = 16


def found(text: Column, pattern: str) -> Column:
    """All matches with their place: array of (start, end, value), in code points.

    The text between matches comes from splitting at the same pattern.
    """
    hits = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)
    size = lambda parts, n: F.aggregate(
        F.slice(parts, F.lit(1), n), F.lit(0), lambda a, x: a + F.length(x)
    )
    return F.transform(
        hits,
        lambda x, i: F.struct(
            (size(gaps, i + 1) + size(hits, i)).alias("start"),
            (size(gaps, i + 1) + size(hits, i) + F.length(x)).alias("end"),
            x.alias("value"),
        ),
    )


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits pass the Luhn check; false beyond 19 digits."""
    digits = F.split(F.reverse(F.substring(digits_of(value), 1, 20)), "")
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    total = F.aggregate(
        F.transform(
            F.filter(digits, lambda d: d != ""),
            lambda d, i: F.when(i % 2 == 1, doubled(d.cast("int"))).otherwise(d.cast("int")),
        ),
        F.lit(0),
        lambda a, d: a + d,
    )
    return (total % 10 == 0) & (F.length(digits_of(value)) <= 19)


def octets(value: Column) -> Column:
    """Whether all parts between dots are numbers up to 255."""
    parts = F.split(value, "\\.")
    return F.forall(
        parts,
        lambda p: p.rlike("^0*[0-9]{1,3}$")
        & (F.right(F.concat(F.lit("000"), p), F.lit(3)).try_cast("int") <= 255),
    )


def valid(kind: str, value: Column) -> Column:
    """The check of a base match."""
    n = F.length(digits_of(value))
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return octets(value)
    if kind == "card":
        return n.between(12, 19) & luhn(value)
    return n.between(9, 15)


def candidates(text: Column, patterns: dict[str, str], checked: bool | None) -> Column:
    """Matches of all kinds as one array of (kind, start, end, value)."""
    none = F.array().cast("array<struct<kind:int,start:int,end:int,value:string>>")

    def of_kind(k: int, kind: str) -> Column:
        spans = found(text, patterns[kind])
        if checked is not None:
            spans = F.filter(spans, lambda s: valid(kind, s["value"]) == checked)
        typed = F.transform(
            spans,
            lambda s: F.struct(
                F.lit(k).alias("kind"), *[s[c].alias(c) for c in ("start", "end", "value")]
            ),
        )
        return F.when(text.rlike(NEEDS[kind]), typed).otherwise(none)

    return F.concat(*[of_kind(k, kind) for k, kind in enumerate(KINDS)])


def described(span: Column, text: Column) -> dict[str, Column]:
    """Format and context features of a candidate, whole numbers of few values."""
    value = span["value"]
    n = F.length(digits_of(value))
    before = F.substring(text, F.greatest(span["start"] + 1 - CONTEXT, F.lit(1)), F.least(span["start"], F.lit(CONTEXT)))
    after = F.substring(text, span["end"] + 1, F.lit(1))
    flag = lambda c: F.when(c, 1).otherwise(0)
    return {
        "kind": span["kind"],
        "digits": F.when(n < 9, 0).when(n < 12, 1).when(n == 12, 2).when(n < 16, 3).when(n == 16, 4).when(n < 20, 5).otherwise(6),
        "luhn": flag(luhn(value)),
        "octets": flag(octets(value)),
        "plus": flag(value.startswith("+")),
        "paren": flag(value.rlike(r"[()\[\]{}]")),
        "spaced": flag(value.rlike(r"[\x20-]")),
        "glued_left": flag(before.rlike(r"[\p{L}\p{N}.]$")),
        "glued_right": flag(after.rlike(r"[\p{L}\p{N}]")),
        "hint": flag(before.rlike(HINT)),
    }


Row = tuple[tuple[int, ...], float, float]  # features, positive weight, negative weight


def boosted(rows: list[Row], trees: int = 24, rate: float = 0.3) -> tuple[float, list]:
    """Gradient boosting of trees with two levels for the logistic loss, on counts."""
    good, bad = sum(r[1] for r in rows), sum(r[2] for r in rows)
    base = log((good + 1) / (bad + 1))
    score = [base] * len(rows)
    cuts = [(f, v) for f in range(len(FEATURES)) for v in sorted({r[0][f] for r in rows})[:-1]]

    def best(at: list[int], g: list[float], h: list[float]) -> tuple | None:
        total_g, total_h = sum(g[i] for i in at), sum(h[i] for i in at)
        top, choice = total_g**2 / (total_h + 1) + 1e-9, None
        for f, v in cuts:
            gl = sum(g[i] for i in at if rows[i][0][f] <= v)
            hl = sum(h[i] for i in at if rows[i][0][f] <= v)
            gain = gl**2 / (hl + 1) + (total_g - gl) ** 2 / (total_h - hl + 1)
            if gain > top:
                top, choice = gain, (f, v)
        return choice

    forest = []
    for _ in range(trees):
        p = [1 / (1 + exp(-max(-30.0, min(30.0, s)))) for s in score]
        g = [r[1] * (1 - q) - r[2] * q for r, q in zip(rows, p, strict=True)]
        h = [(r[1] + r[2]) * q * (1 - q) for r, q in zip(rows, p, strict=True)]
        every = list(range(len(rows)))
        root = best(every, g, h)
        if root is None:
            break
        tree = [root]
        for side in (True, False):
            at = [i for i in every if (rows[i][0][root[0]] <= root[1]) == side]
            split = best(at, g, h)
            leaves = []
            for low in (True, False):
                leaf = [i for i in at if split is None or (rows[i][0][split[0]] <= split[1]) == low]
                step = rate * sum(g[i] for i in leaf) / (sum(h[i] for i in leaf) + 1)
                leaves.append(step)
                if split is None and not low:
                    break
                for i in leaf:
                    score[i] += step
            tree.append((split, leaves))
        forest.append(tree)
    return base, forest


def sum_of_trees(base: float, forest: list, x: dict[str, Column]) -> Column:
    out = F.lit(base)
    for root, *sides in forest:
        branch = []
        for split, leaves in sides:
            if split is None:
                branch.append(F.lit(leaves[0]))
            else:
                branch.append(F.when(x[FEATURES[split[0]]] <= split[1], leaves[0]).otherwise(leaves[1]))
        out = out + F.when(x[FEATURES[root[0]]] <= root[1], branch[0]).otherwise(branch[1])
    return out


def value_of(base: float, forest: list, features: tuple[int, ...]) -> float:
    out = base
    for root, *sides in forest:
        split, leaves = sides[0 if features[root[0]] <= root[1] else 1]
        out += leaves[0 if split is None or features[split[0]] <= split[1] else 1]
    return out


def calibrated(base: float, forest: list, rows: list[Row], precision: float) -> list[float]:
    """For each kind the lowest score from which on at least ``precision`` is right.

    Candidates of one score are accepted or refused together; a kind of which no score
    is accepted has an infinite limit.
    """
    limits = []
    for k in range(len(KINDS)):
        mine = sorted(
            ((value_of(base, forest, r[0]), r[1], r[2]) for r in rows if r[0][0] == k), reverse=True
        )
        good = bad = 0.0
        limit = inf
        for s, same in groupby(mine, key=lambda r: r[0]):
            for _, p, n in same:
                good, bad = good + p, bad + n
            if s < 0 or good < precision * (good + bad):
                break
            limit = s
        limits.append(limit)
    return limits


def find_personal_data(docs: DataFrame, precision: float = 0.98) -> DataFrame:
    """``docs`` with _pii_base and _pii_spans, the base spans and all spans.

    Base spans are the matches of the base patterns that pass their checks; they all
    stay.  The generators propose more spans, which may overlap.  Boosted trees learn
    from all base matches of the corpus, those that passed against those that failed,
    which formats and contexts are personal data; a proposal is taken if its score
    reaches the limit of its kind and it overlaps no base span and no proposal taken
    before it (from left to right).  Spans are arrays of (start, kind, end), sorted;
    kind is the place in KINDS, offsets are code points, the end is not included.

    Null and empty texts have no spans.  Rows that repeat, or have no doc_id, have
    their own results.  Without matches nothing is added.  An empty table gives an
    empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    both = docs.withColumns({
        "_pii_found": candidates(text, BASE, True),
        "_pii_more": candidates(text, MORE, None),
    })
    base, forest, limits = _learnt(docs, text, precision)

    def taken(span: Column) -> Column:
        x = described(span, text)
        limit = F.element_at(F.array(*[F.lit(v) for v in limits]), span["kind"] + 1)
        return sum_of_trees(base, forest, x) >= limit - 1e-9

    apart = lambda a, b: (a["end"] <= b["start"]) | (b["end"] <= a["start"])
    place = lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["end"].alias("end"))
    # beside a base span first, as that is cheap
    free = F.filter("_pii_more", lambda m: F.forall("_pii_found", lambda b: apart(m, b)))
    scored = F.array_sort(F.transform(F.filter(F.col("_pii_free"), taken), place))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    chosen = F.aggregate(
        F.col("_pii_scored"),
        F.struct(F.lit(0).alias("upto"), none.alias("kept")),
        lambda a, s: F.when(
            s["start"] >= a["upto"],
            F.struct(s["end"].alias("upto"), F.concat(a["kept"], F.array(s)).alias("kept")),
        ).otherwise(a),
    )["kept"]
    return (
        both.withColumn("_pii_free", free)
        .withColumn("_pii_scored", F.when(F.size("_pii_free") > 0, scored).otherwise(none))
        .withColumn("_pii_base", F.array_sort(F.transform("_pii_found", place)))
        .withColumn(
            "_pii_spans",
            F.array_sort(F.concat("_pii_base", F.when(F.size("_pii_scored") > 0, chosen).otherwise(none))),
        )
        .drop("_pii_found", "_pii_more", "_pii_free", "_pii_scored")
    )


def _learnt(docs: DataFrame, text: Column, precision: float) -> tuple[float, list, list[float]]:
    """Trees and limits from all base matches of the corpus, as counts of feature vectors."""
    passed, failed = candidates(text, BASE, True), candidates(text, BASE, False)
    near = lambda s, good: F.struct(
        F.lit(good).alias("good"), *[c.alias(n) for n, c in described(s, text).items()]
    )
    marked = docs.select(passed.alias("_p"), failed.alias("_f"), text.alias("text")).select(
        F.explode(
            F.concat(
                F.transform("_p", lambda s: near(s, 1)), F.transform("_f", lambda s: near(s, 0))
            )
        ).alias("_s")
    )
    counted = marked.groupBy(*[F.col(f"_s.{n}").alias(n) for n in FEATURES]).agg(
        F.sum("_s.good").alias("good"), F.count("*").alias("n")
    )
    rows = [
        (tuple(r[n] for n in FEATURES), float(r["good"]), float(r["n"] - r["good"]))
        for r in counted.limit(VECTORS).collect()  # there are no more different vectors
    ]
    if not rows:
        return -1.0, [], [inf] * len(KINDS)
    rows.sort()
    base, forest = boosted(rows)
    return base, forest, calibrated(base, forest, rows, precision)


def joined(spans: Column) -> Column:
    """kind:start:end of sorted spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string")),
        ),
        ",",
    )


def report(docs: DataFrame) -> DataFrame:
    """doc_id, counts of base spans, base_sha256 and all spans as text."""
    found = find_personal_data(docs.select("doc_id", "text"))
    count = lambda k: F.size(F.filter("_pii_base", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.sha2(joined(F.col("_pii_base")), 256).alias("base_sha256"),
        joined(F.col("_pii_spans")).alias("spans"),
    )


def redact(docs: DataFrame) -> DataFrame:
    """The documents with every span replaced by its kind in angle brackets.

    Overlapping spans are replaced together, by the kind of the first.  n_chars
    follows the new text; texts without spans, and null texts, are as they were.
    """
    found = find_personal_data(docs)
    names = F.array(*[F.lit(f"<{k}>") for k in KINDS])
    text = F.col("text")
    piece = lambda a, b: F.substring(text, a + 1, F.greatest(b - a, F.lit(0)))
    folded = F.aggregate(
        F.col("_pii_spans"),
        F.struct(F.lit(0).alias("upto"), F.lit("").alias("out")),
        lambda a, s: F.struct(
            F.greatest(a["upto"], s["end"]).alias("upto"),
            F.when(
                s["start"] >= a["upto"],
                F.concat(a["out"], piece(a["upto"], s["start"]), F.element_at(names, s["kind"] + 1)),
            ).otherwise(a["out"]).alias("out"),
        ),
        lambda a: F.concat(a["out"], F.substring(text, a["upto"] + 1, F.length(text))),
    )
    new = F.when(F.size("_pii_spans") > 0, folded).otherwise(text)
    columns = {"text": new} | (
        {"n_chars": F.when(F.size("_pii_spans") > 0, F.length(new).cast("long")).otherwise(F.col("n_chars"))}
        if "n_chars" in docs.columns
        else {}
    )
    return found.withColumns(columns).select(docs.columns)
