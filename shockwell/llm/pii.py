"""Personal data: fixed kinds by pattern, further identifiers by bootstrapped contexts.

All expressions are SQL functions.  The fixed kinds (email, ip, card, phone)
are found by their patterns.  They seed a graph between lexical patterns (the
one or two words in front of a mention) and instances (the mention's own text;
besides the fixed kinds any run that looks like an identifier).  Rounds
score both sides in turn: a pattern by the share of its instances that are
trusted, an instance by the patterns it occurs with, until nothing changes any
more.  Patterns that end with enough support and confidence mark the identifiers behind them as found spans
of kind ``context-<kind>``.  Spans of the fixed kinds always stay.

The graph holds distinct (pattern, instance) pairs, summed up before they are
shuffled; joins to scores keep hot patterns and instances apart.

Defined results: null and empty text have no spans; identifiers and other
columns may be null; repeated rows get the same spans each; an empty table
gives an empty result; other columns are ignored unless ``carry`` asks for
them, and then travel in a column of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shockwell.llm import common
from shockwell.plans.storage import delete, work_folder, written

KINDS = ("email", "ip", "card", "phone")

# The contract's patterns.  Possessive repeats and the conditions in front only
# spare the search from trying each place within a long run again: a match can
# begin at the run's start or where the match before it ended.
LOCAL = "A-Za-z0-9._%+-"
PATTERNS = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?<![0-9])(?<![0-9][ -])[0-9](?:[ -]?[0-9]){13,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
BYTE = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9][0-9]?)?"
VALID = {
    "email": "true",
    "ip": rf"m rlike '^(?=0|[1-9]){BYTE}(?:[.](?=[0-9]){BYTE}){{3}}$'",
    "card": "length(translate(m, ' -', '')) BETWEEN 14 AND 19 AND luhn_check(translate(m, ' -', ''))",
    "phone": "length(translate(m, '+ ().-', '')) BETWEEN 10 AND 15",
}
#: What a mention of another kind can look like: a run of identifier characters with a digit or an at sign.
#: A long run is one match, so the search stays linear.
CANDIDATE_RUN = r"(?<![A-Za-z0-9_@./+-])[A-Za-z_./+-]*+[0-9@][A-Za-z0-9_@./+-]*+"
CANDIDATE_TEXT = r"length(m) >= 5 AND (m rlike '[0-9].*[0-9].*[0-9]' OR m rlike '.@.')"
#: Instances longer than this are told apart in the graph by their hash, so rows stay small.
LONG_INSTANCE = 200
#: Characters of left context that are read, and the support and confidence of the scoring.
CONTEXT_CHARS = 60
LEAST_SUPPORT = 3.0
LEAST_CONFIDENCE = 0.7
#: A score that moves by no more than this counts as unchanged.  Scoring takes a
#: round per hop of a chain of contexts and some to settle; so many are an error.
SETTLED = 1e-6
MOST_ROUNDS = 1000


def literal(pattern: str) -> str:
    return "r'" + pattern.replace("'", "\\'") + "'"


def found(pattern: str, guard: str) -> str:
    """SQL: array of (start, end, m) of all matches in ``text``, in code points.

    The pieces between the matches and the matches themselves, laid end to end,
    give the positions.
    """
    p = literal(pattern)
    return f"""if({guard} AND text rlike {p},
        aggregate(zip_with(split(text, {p}, -1), regexp_extract_all(text, {p}, 0), (p, m) -> struct(p, m)),
            struct(0L AS at, cast(array() AS array<struct<start: bigint, end: bigint, m: string>>) AS out),
            (a, x) -> if(x.m IS NULL, a, struct(
                a.at + char_length(x.p) + char_length(x.m) AS at,
                array_append(a.out, struct(a.at + char_length(x.p) AS start,
                    a.at + char_length(x.p) + char_length(x.m) AS end, x.m AS m)) AS out)),
            a -> a.out),
        cast(array() AS array<struct<start: bigint, end: bigint, m: string>>))"""


def base_kind(kind: str) -> str:
    """SQL: valid spans of a fixed kind as (start, rank, end, m); failing matches are dropped, without retries."""
    guards = {"email": "contains(text, '@')", "phone": "contains(text, '+')"}
    valid = VALID[kind].replace("(m", "(s.m").replace("m rlike", "s.m rlike")
    spans = f"filter({found(PATTERNS[kind], guards.get(kind, 'true'))}, s -> {valid})"
    return f"transform({spans}, s -> struct(s.start, {KINDS.index(kind)} AS rank, s.end, s.m))"


def span_text(spans: str) -> str:
    """SQL: ``kind:start:end`` of spans, comma-joined, by start and then kind as listed."""
    names = ", ".join(repr(k) for k in (*KINDS, *(f"context-{k}" for k in KINDS)))
    return f"array_join(transform({spans}, s -> concat_ws(':', element_at(array({names}), s.rank + 1), s.start, s.end)), ',')"


def spans_of(rows: DataFrame) -> DataFrame:
    """With ``base``, the fixed kinds' spans, and ``mentions``: those and the
    candidates apart from them, each with its context patterns."""
    base = rows.selectExpr("*", f"array_sort(concat({', '.join(base_kind(k) for k in KINDS)})) AS base")
    valid = CANDIDATE_TEXT.replace("(m)", "(s.m)").replace("m rlike", "s.m rlike")
    other = base.selectExpr("*", f"""transform(filter({found(CANDIDATE_RUN, 'true')},
        s -> {valid} AND NOT exists(base, b -> b.start < s.end AND s.start < b.end)),
        s -> struct(s.start, -1 AS rank, s.end, s.m)) AS others""")
    left = f"lower(substring(text, cast(greatest(1, s.start - {CONTEXT_CHARS - 1}) AS INT), cast(least({CONTEXT_CHARS}, s.start) AS INT)))"
    words = f"filter(split({left}, '[ \\\\t-\\\\r]+', -1), w -> w <> '')"
    # no mention holds a colon, so a hash is never the text of another
    instance = f"if(length(s.m) > {LONG_INSTANCE}, concat('sha256:', sha2(s.m, 256)), s.m)"
    return other.selectExpr("*", f"""transform(concat(base, others), s -> named_struct(
        'start', s.start, 'rank', s.rank, 'end', s.end, 'instance', {instance}, 'left', slice({words}, -2, 2))) AS mentions""").drop("others", "text")


def graph(stored: DataFrame) -> DataFrame:
    """Distinct ``(pattern, instance, rank)``; rank -1 where the instance is no seed."""
    mentions = stored.selectExpr("explode(mentions) AS s").selectExpr("s.instance", "s.rank", f"{patterns('s')} AS p")
    return mentions.selectExpr("explode(p) AS pattern", "instance", "rank").groupBy("pattern", "instance").agg(F.max("rank").alias("rank"))


def patterns(s: str) -> str:
    """SQL: the lexical patterns of a mention, the last word in front and the last two."""
    last, two = f"element_at({s}.left, -1)", f"array_join({s}.left, ' ')"
    return f"CASE size({s}.left) WHEN 0 THEN cast(array() AS array<string>) WHEN 1 THEN array({last}) ELSE array({last}, {two}) END"


def scored(edges: DataFrame, folder: str, rounds: int, support: float, confidence: float) -> DataFrame:
    """``(pattern, rank, score)`` of the patterns that are trusted in the end.

    ``score = mass / (instances + 1)``, the mass being the trust in its distinct
    instances of a kind; only patterns with enough mass and score pass trust on.
    Trust only grows from round to round.  The end is reached when the trusted
    patterns and their scores stay as they are: while scores still grow, a round
    without a new pattern can be followed by one with.  Without an end within
    ``rounds`` an error is raised.
    """
    spark = edges.sparkSession
    total = edges.count()
    by_pattern = edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))
    by_instance = written(edges.groupBy("instance").agg(F.count(F.lit(1)).alias("n"), F.max("rank").alias("seed")), f"{folder}/instances")
    by_pattern = written(by_pattern, f"{folder}/patterns")
    seeds = by_instance.filter("seed >= 0").selectExpr("instance", "n", "seed AS kind", "1.0D AS trust")
    trusted, before = seeds, None
    pairs = edges.select("pattern", "instance")
    for r in range(rounds):
        reached = common.join_to_groups(pairs, trusted, ["instance"], "n", total)
        mass = reached.groupBy("pattern", "kind").agg(F.sum("trust").alias("mass"))
        good = mass.join(by_pattern, "pattern").selectExpr("pattern", "n", "kind", "mass", "mass / (n + 1) AS score")
        good = written(good.filter(f"mass >= {support} AND score >= {confidence}"), f"{folder}/trusted-{r}")
        if before is None:
            changed = good
        else:
            old = before.selectExpr("pattern", "kind", "score AS old")
            changed = good.join(old, ["pattern", "kind"], "left").filter(f"old IS NULL OR abs(score - old) > {SETTLED}")
        if changed.isEmpty():
            return good.selectExpr("pattern", "n", "kind", "score")
        if before is not None:  # what the round before has left is not read again
            delete(spark, f"{folder}/trusted-{r - 1}")
            delete(spark, f"{folder}/instances-{r - 1}")
        spread = common.join_to_groups(pairs, good.select("pattern", "n", "kind", "score"), ["pattern"], "n", total)
        found_trust = spread.groupBy("instance", "kind").agg(F.expr("1 - exp(sum(ln(1 - score)))").alias("trust"))
        others = found_trust.join(by_instance, "instance").filter("seed < 0").select("instance", "n", "kind", "trust")
        trusted, before = written(seeds.unionByName(others), f"{folder}/instances-{r}"), good
    raise RuntimeError(f"the trusted patterns still change after {rounds} rounds; allow more rounds")


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False, rounds: int = MOST_ROUNDS,
             support: float = LEAST_SUPPORT, confidence: float = LEAST_CONFIDENCE) -> DataFrame:
    """One row per input row: ``doc_id, base, found`` and, with ``carry``, the
    whole row in ``source``.

    ``base`` and ``found`` are arrays of (start, rank, end); ranks count
    through the fixed kinds and then their context kinds.  Scoring that has not
    ended after ``rounds`` rounds is an error.
    """
    folder = work_folder(docs.sparkSession)
    whole = [F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("source")] if carry else []
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *whole)
    stored = written(spans_of(common.numbered(rows)), f"{folder}/spans")
    edges = written(graph(stored), f"{folder}/graph")
    good = scored(edges, folder, rounds, support, confidence)
    others = stored.selectExpr("row_id", "explode(mentions) AS s").filter("s.rank < 0").selectExpr(
        "row_id", "s.start", "s.end", f"explode({patterns('s')}) AS pattern")
    hits = common.join_to_groups(others, good, ["pattern"], "n", edges.count())
    best = hits.groupBy("row_id", "start", "end").agg(F.expr("max_by(kind, struct(score, -kind))").alias("kind"))
    per_row = best.groupBy("row_id").agg(F.expr(f"array_sort(collect_list(struct(start, kind + {len(KINDS)} AS rank, end)))").alias("found"))
    # Rows without a candidate have nothing to join.
    none = "cast(array() AS array<struct<start: bigint, rank: int, end: bigint>>)"
    candidate = "exists(mentions, s -> s.rank < 0)"
    joined = stored.filter(candidate).drop("mentions").join(per_row, "row_id", "left").withColumn("found", F.expr(f"coalesce(found, {none})"))
    plain = stored.filter(f"NOT {candidate}").drop("mentions").withColumn("found", F.expr(none))
    return plain.unionByName(joined).selectExpr(
        "doc_id", *(["source"] if carry else []), "transform(base, s -> struct(s.start, s.rank, s.end)) AS base", "found")


def digest(spans: DataFrame) -> DataFrame:
    """Counts per fixed kind, the digest of the fixed kinds' spans, and all spans as text."""
    counts = [f"cast(size(filter(base, s -> s.rank = {k})) AS BIGINT) AS n_{kind}" for k, kind in enumerate(KINDS)]
    return spans.selectExpr("doc_id", *counts, f"sha2({span_text('base')}, 256) AS base_sha256",
                            f"{span_text('array_sort(concat(base, found))')} AS spans")


def redacted(text: str, spans: str) -> str:
    """SQL: the text with every span, or run of overlapping spans, replaced by its kind in angle brackets."""
    names = ", ".join(f"'<{k.upper()}>'" for k in KINDS * 2)
    return f"""if(size({spans}) = 0, {text}, aggregate({spans}, struct(0L AS at, '' AS out), (a, s) -> if(s.start >= a.at,
        struct(s.end AS at, concat(a.out, substring({text}, cast(a.at + 1 AS INT), cast(s.start - a.at AS INT)),
            element_at(array({names}), s.rank + 1)) AS out),
        struct(greatest(a.at, s.end) AS at, a.out AS out)),
        a -> concat(a.out, substring({text}, cast(a.at + 1 AS INT)))))"""
