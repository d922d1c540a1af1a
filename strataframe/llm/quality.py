"""Operator 6: quality by weak supervision.

Each rule looks at a text and votes bad (0), good (1) or abstains (null). Rules
with nothing to go on (too few words or lines) abstain. Two or three rules look for each kind of
damage, in different ways, so that a damage is vouched for by votes that agree and a rule
that errs alone is outvoted. The votes of all documents are counted by pattern;
expectation-maximisation over the patterns estimates the share of good documents and, for
each rule, how often it is right on good and on bad documents, under weak Beta priors and
without bounds (abstentions count as missing). A document's quality is the posterior
probability that it is good; it is kept from ``THRESHOLD`` on. Neither one bad vote nor
many good ones decide alone.

Defined cases: a null, empty or blank text has no votes, so its quality is the
prior; it is kept only if the prior says so. A very long text is counted whole, in
linear time. A posterior equal to the threshold keeps. Repeated rows count once each. An
empty table has no result. Extra columns are ignored by the query, carried by
the stage.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strataframe.plans.runtime import pick

THRESHOLD = 0.5
ROUNDS = 25
#: Votes that every rule is given beforehand: (right, wrong) on good and on bad documents.
PRIOR_GOOD, PRIOR_BAD = (19.0, 1.0), (1.0, 4.0)
#: The first guess of a document is bad from so many bad votes on.
AGREE = 2
SYMBOLS = "#$%&*|{}<>\\^~=+_@!"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZÄÖÜÉÈÊÇÀÂÎÔÛÑÁÍÓÚ"

#: rule -> (SQL value, SQL condition under which it votes, votes bad when the value is over, votes good when it is at most)
RULES = {
    "symbols": ("symbols / chars", "chars >= 4", 0.06, 0.02),
    "marked": ("marked / words", "words >= 5", 0.15, 0.05),
    "letters": ("1 - letters / chars", "chars >= 40", 0.35, 0.25),
    "capitals": ("capitals / chars", "chars >= 4", 0.4, 0.2),
    "shouted": ("shouted / words", "words >= 5", 0.4, 0.1),
    "repeats": ("repeats / words", "words >= 10", 0.2, 0.05),
    "returns": ("returns / words", "words >= 10", 0.2, 0.05),
    "thirds": ("thirds / words", "words >= 10", 0.2, 0.05),
    "tables": ("bars / words", "words >= 10", 0.1, 0.02),
    "barred": ("barred / lines", "words >= 10", 0.3, 0.05),
    "lines": ("1 - distinct_lines / lines", "lines >= 5", 0.5, 0.2),
    "line_chars": ("1 - distinct_chars / line_chars", "lines >= 5", 0.5, 0.2),
    "length": ("chars / words", "words >= 5", 14.0, 11.0),
    "long_words": ("long_words / words", "words >= 5", 0.2, 0.05),
}

#: What the rules' values are made of, in Spark SQL and in DuckDB SQL. Words are runs of other characters than blanks, tabs and line ends.
W = r"[^ \t\n\r]"
B = r"[ \t\n\r]"
_CLASS = "[" + SYMBOLS.replace("\\", r"\\").replace("^", r"\^") + "]"
PATTERNS = {  # matches of a pattern in the text
    "words": f"{W}+",
    "marked": f"{_CLASS}{W}*",
    "shouted": f"[{UPPER}][{UPPER}]{W}*",
    "long_words": f"{W}" + "{21}" + f"{W}*",
    "barred": r" \| [^\n]*",
    "lines": r"[^\n]+",
    "letters": r"[\p{L}\p{N}]",  # digits as well
}
#: In Spark, of the text ``t``, its words ``w``, its lines ``l`` and the distinct lines ``d``; what leaves out characters in runs is faster than what counts them one by one.
SPARK = {
    "chars": "length(t)",
    "symbols": f"length(t) - length(regexp_replace(t, r'{_CLASS}+', ''))",
    "capitals": f"length(t) - length(regexp_replace(t, r'[{UPPER}]+', ''))",
    "repeats": "size(filter(w, (x, i) -> i > 0 and x = w[i - 1]))",
    "returns": "size(filter(w, (x, i) -> i > 1 and x = w[i - 2]))",
    "thirds": "size(filter(w, (x, i) -> i > 2 and x = w[i - 3]))",
    "bars": "size(filter(w, x -> x = '|'))",
    "distinct_lines": "size(d)",
    "line_chars": "length(array_join(l, ''))",
    "distinct_chars": "length(array_join(d, ''))",
    "words": "size(w)",
    "long_words": "size(filter(w, x -> length(x) > 20))",
    "barred": "size(filter(l, x -> contains(x, ' | ')))",
    "lines": "size(l)",
    "letters": f"length(t) - length(regexp_replace(t, r'{PATTERNS['letters']}+', ''))",
    **{k: f"regexp_count(t, r'{PATTERNS[k]}')" for k in ("marked", "shouted")},
}
DUCK = {
    "chars": "length(t)",
    "symbols": "length(t) - length(translate(t, {symbols}, ''))",
    "capitals": "length(t) - length(translate(t, {upper}, ''))",
    "repeats": "len(list_filter(w, lambda x, i: i > 1 and x = w[i - 1]))",
    "returns": "len(list_filter(w, lambda x, i: i > 2 and x = w[i - 2]))",
    "thirds": "len(list_filter(w, lambda x, i: i > 3 and x = w[i - 3]))",
    "bars": "len(list_filter(w, lambda x: x = '|'))",
    "distinct_lines": "len(list_distinct(l))",
    "line_chars": "length(array_to_string(l, ''))",
    "distinct_chars": "length(array_to_string(list_distinct(l), ''))",
    **{k: f"len(regexp_extract_all(t, '{p}'))" for k, p in PATTERNS.items()},
}


def _counts(of: dict[str, str], quote) -> dict[str, str]:
    """Each count as a double."""
    fill = {"symbols": quote(SYMBOLS), "upper": quote(UPPER)}
    return {k: f"cast({v.format(**fill) if '{symbols}' in v or '{upper}' in v else v} as double)" for k, v in of.items()}


def _vote(rule: str) -> str:
    value, when, bad, good = RULES[rule]
    return f"case when not ({when}) then null when {value} > {bad} then 0 when {value} <= {good} then 1 end"


def votes(texts: DataFrame, *keep: str) -> DataFrame:
    """Columns ``keep`` and one vote column a rule, of a frame with a ``t`` text column; JVM-side expressions only."""
    t = "coalesce(t, '')"
    words, lines = rf"array_remove(split({t}, r'{B}+'), '')", rf"array_remove(split({t}, r'\n'), '')"
    # a generator of one row keeps the optimiser from copying the splits and the counts into every use of them
    split = texts.selectExpr(*keep, f"inline(array(named_struct('t', {t}, 'w', {words}, 'l', {lines})))").selectExpr(*keep, "t", "w", "l", "array_distinct(l) as d")
    counts = ", ".join(f"'{k}', {v}" for k, v in _counts(SPARK, lambda s: f"r'{s}'").items())
    return split.selectExpr(*keep, f"inline(array(named_struct({counts})))").selectExpr(*keep, *[f"{_vote(r)} as {r}" for r in RULES])


Pattern = tuple[int | None, ...]


def estimate(patterns: list[tuple[Pattern, int]]) -> tuple[float, list[tuple[float, float]], dict[Pattern, float]]:
    """The prior, each rule's rates of being right on good and on bad documents, and each vote pattern's posterior, by ``ROUNDS`` rounds of expectation-maximisation."""
    if not patterns:
        return 0.5, [], {}
    rules = range(len(patterns[0][0]))
    q = {p: 0.1 if p.count(0) >= AGREE else 0.9 for p, _ in patterns}
    total = sum(n for _, n in patterns)
    prior, right = 0.5, []
    for _ in range(ROUNDS):
        prior = (sum(n * q[p] for p, n in patterns) + 0.5) / (total + 1)
        right = []
        for r in rules:
            good = sum(n * q[p] for p, n in patterns if p[r] is not None)
            bad = sum(n * (1 - q[p]) for p, n in patterns if p[r] is not None)
            right.append(
                (
                    (sum(n * q[p] for p, n in patterns if p[r] == 1) + PRIOR_GOOD[0]) / (good + sum(PRIOR_GOOD)),
                    (sum(n * (1 - q[p]) for p, n in patterns if p[r] == 0) + PRIOR_BAD[0]) / (bad + sum(PRIOR_BAD)),
                )
            )
        for p, _ in patterns:
            g, b = prior, 1 - prior
            for r in rules:
                if p[r] is not None:
                    g *= right[r][0] if p[r] else 1 - right[r][0]
                    b *= 1 - right[r][1] if p[r] else right[r][1]
            q[p] = g / (g + b)
    return prior, right, q


def _posterior(counted: DataFrame) -> Column:
    """The posterior as an expression of the vote columns: the sum of the log-odds that each vote gives, whatever the number of patterns."""
    names = list(RULES)
    rows = counted.groupBy(*names).agg(F.count("*").alias("n")).collect()  # one a pattern of votes that is met
    prior, right, _ = estimate(sorted(((tuple(r[c] for c in names), r["n"]) for r in rows), key=str))
    if not right:
        return F.lit(None).cast("double")
    odds = F.lit(math.log(prior / (1 - prior)))
    for c, (g, b) in zip(names, right):
        odds = odds + F.when(F.col(c) == 1, math.log(g / (1 - b))).when(F.col(c) == 0, math.log((1 - g) / b)).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def quality_scores(docs: DataFrame) -> DataFrame:
    """``(doc_id, <votes>, quality, keep)`` for every row."""
    d = pick(docs, doc_id="bigint", text="string").withColumnRenamed("text", "t")
    v = votes(d, "doc_id")
    return v.withColumn("quality", F.round(_posterior(v), 6)).withColumn("keep", F.col("quality") >= THRESHOLD)


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose quality reaches the threshold, decided row by row: no join, no shuffle of texts."""
    names = docs.columns
    flat = docs.toDF(*[f"__c{i}" for i in range(len(names))])
    own = [f"__c{i}" for i in range(len(names))]
    text = pick(docs, text="string").select(F.col("text").alias("t"))
    at = next((i for i, c in enumerate(names) if c == "text"), None)
    at = next(i for i, c in enumerate(names) if c.lower() == "text") if at is None else at
    v = votes(flat.withColumn("t", F.col(f"__c{at}").try_cast("string")), *own)
    return v.filter(F.round(_posterior(votes(text)), 6) >= THRESHOLD).select(*own).toDF(*names)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def _sql() -> str:
    names = list(RULES)
    features = ", ".join(f"{v} as {k}" for k, v in _counts(DUCK, lambda s: f"'{s}'").items())
    ctes = [
        r"split as (select doc_id, t, list_filter(regexp_split_to_array(t, '[ \t\n\r]+'), lambda x: x <> '') as w, list_filter(string_split(t, chr(10)), lambda x: x <> '') as l from (select doc_id, coalesce(text, '') as t from documents))",
        f"features as (select doc_id, {features} from split)",
        f"votes as materialized (select doc_id, {', '.join(f'{_vote(r)} as {r}' for r in names)} from features)",
        f"patterns as (select {', '.join(names)}, count(*)::double as n from votes group by all)",
        f"q0 as (select *, case when {' + '.join(f'case {r} when 0 then 1 else 0 end' for r in names)} >= {AGREE} then 0.1::double else 0.9::double end as q from patterns)",
    ]
    for k in range(ROUNDS):
        acc = ", ".join(
            f"(coalesce(sum(n * q) filter ({r} = 1), 0) + {PRIOR_GOOD[0]}) / (coalesce(sum(n * q) filter ({r} is not null), 0) + {sum(PRIOR_GOOD)}) as g_{r}, "
            f"(coalesce(sum(n * (1 - q)) filter ({r} = 0), 0) + {PRIOR_BAD[0]}) / (coalesce(sum(n * (1 - q)) filter ({r} is not null), 0) + {sum(PRIOR_BAD)}) as b_{r}"
            for r in names
        )
        ctes.append(f"m{k} as materialized (select (sum(n * q) + 0.5) / (sum(n) + 1) as prior, {acc} from q{k})")
        g = " * ".join(["prior", *[f"case {r} when 1 then g_{r} when 0 then 1 - g_{r} else 1 end" for r in names]])
        b = " * ".join(["(1 - prior)", *[f"case {r} when 1 then 1 - b_{r} when 0 then b_{r} else 1 end" for r in names]])
        ctes.append(f"q{k + 1} as materialized (select {', '.join(names)}, n, ({g}) / (({g}) + ({b})) as q from q{k}, m{k})")
    on = " and ".join(f"v.{r} is not distinct from p.{r}" for r in names)
    return (
        "with " + ",\n".join(ctes) + f"\nselect doc_id, {', '.join(f'v.{r}' for r in names)}, round(q, 6) as quality, round(q, 6) >= {THRESHOLD} as keep"
        f" from votes v join q{ROUNDS} p on {on}"
    )


SQL = _sql()
