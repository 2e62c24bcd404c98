"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

A rule is a ratio of counts over the whole text and a cutoff: a document whose
ratio lies above the cutoff of its stratum is rejected. Cutoffs come from labelled
documents, split by a hash of doc_id into a tuning and a holdout half. The tuning
half proposes, per stratum and rule, the step of the rule's grid that rejects most
bad documents at a share of falsely rejected good ones of at most ALPHA / 2. A
stratum's proposals are ordered by the bad documents they catch, then by name, and the
holdout half certifies them together: of n good holdout documents the first j proposals
would reject k, by any of them, and they hold only if P(Bin(n, ALPHA) <= k) <=
DELTA / tests, an exact binomial tail with a Bonferroni correction over all such tests
of all strata. The largest j that holds is in force; the rules beyond it reject nothing.
With probability 1 - DELTA the rules of every stratum together falsely reject at most
ALPHA of its good documents.

A document also fails if it has under 20 words, or if over 30 % of its words lie in
8-word windows found twice or more in it; such documents take no part in tuning.

Null text counts as empty (no words, base rules reject it); a null stratum value
is a stratum of its own. Labels with a null doc_id or quality are left out; a
doc_id labelled twice is good if any of its labels is. No labels: base rules only.
Empty table: no rows. Repeated rows are judged alike and stay repeated. Other
columns, whatever their names, are passed through by ``keep``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlens.llm.common import cut, fresh, text_of, without_blanks

#: False rejections allowed to the rules of one stratum together, and the risk of exceeding them anywhere.
ALPHA, DELTA = 0.01, 0.05
#: Cutoffs that become part of an expression; more are joined by stratum.
INLINE_CUTOFFS = 4096
WINDOW, MIN_WORDS, MAX_REPEAT_PCT = 8, 20, 30

#: rule: (numerator, denominator, ascending grid of cutoffs)
RULES = {
    "symbols": ("n_symbols", "n_words", (0.1, 0.2, 0.3, 0.5, 0.75, 1.0, 1.5, 2.0)),
    "bangs": ("n_bangs", "n_words", (0.05, 0.1, 0.2, 0.3, 0.5, 0.75, 1.0, 1.5)),
    "capitals": ("n_capitals", "word_chars", (0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.65, 0.8)),
    "dup_lines": ("n_dup_lines", "n_lines", (0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8)),
    "repeats": ("n_repeat_words", "n_words", (0.05, 0.1, 0.15, 0.2, 0.25, 0.28, 0.29, 0.3)),
    "long_words": ("word_chars", "n_words", (8.0, 9.0, 10.0, 11.0, 12.0, 14.0, 17.0, 20.0)),
}
METRICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_bangs", "n_capitals")


def _let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def _repeat_words(words: Column, hashes: Column) -> Column:
    """Words in windows that occur twice or more. The hashes clear most documents;
    the others are decided on the words themselves."""
    def covered(s: Column) -> Column:
        twice = F.transform(s, lambda x, j: F.when((F.get(s, j - 1)["w"] == x["w"]) | (F.get(s, j + 1)["w"] == x["w"]), x["i"]))
        starts = F.sort_array(F.filter(twice, lambda i: i.isNotNull()))
        zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-WINDOW).alias("last"))
        step = lambda a, i: F.struct((a["n"] + F.least(F.lit(WINDOW), i - a["last"])).alias("n"), i.alias("last"))
        return F.aggregate(starts, zero, step, lambda a: a["n"])

    windows = F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), lambda i: F.struct(F.array_join(F.slice(words, i, WINDOW), " ").alias("w"), i.alias("i")))
    differ = F.coalesce(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(True))
    return F.when(differ, F.lit(0).cast("long")).otherwise(_let(F.sort_array(windows), covered))


def measure(docs: DataFrame, into: str) -> DataFrame:
    """``docs`` with a struct column ``into`` of METRICS, all long."""
    t, w, h, ln = fresh(docs, "text_", "words_", "hashes_", "lines_")
    rows = docs.withColumn(t, text_of(docs))
    rows = rows.withColumn(w, F.array_remove(F.split(t, r"[\x20\x09-\x0D]+"), ""))
    rows = rows.withColumn(ln, F.filter(F.split(t, "\n"), lambda x: without_blanks(x) != ""))
    ids = F.sequence(F.lit(1), F.size(w) - (WINDOW - 1))
    rows = rows.withColumn(h, F.when(F.size(w) >= WINDOW, F.transform(ids, lambda i: F.xxhash64(F.slice(F.col(w), i, WINDOW)))))
    without = lambda chars: F.length(t) - F.length(F.translate(t, chars, ""))
    values = {
        "n_words": F.size(w),
        "word_chars": F.length(without_blanks(F.col(t))),
        "n_symbols": without("#*$%&|<>"),
        "n_dup_lines": F.size(ln) - F.size(F.array_distinct(ln)),
        "n_repeat_words": _repeat_words(F.col(w), F.col(h)),
        "n_lines": F.size(ln),
        "n_bangs": without("!"),
        "n_capitals": without("ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    }
    rows = rows.withColumn(into, F.struct(*[values[m].cast("long").alias(m) for m in METRICS]))
    return rows.drop(t, w, h, ln)


def base_failed(q: Column) -> Column:
    return (q["n_words"] < MIN_WORDS) | (100 * q["n_repeat_words"] > MAX_REPEAT_PCT * q["n_words"])


def _ratio(q: Column, rule: str) -> Column:
    """Null for a text without words. Spark works out a ratio that occurs twice in an
    expression before the ``base_failed`` beside it, so it must not fail there."""
    over, under, _ = RULES[rule]
    return F.try_divide(q[over].cast("double"), q[under].cast("double"))


def tail_at_most(n: Column, k: Column, p: float) -> Column:
    """P(Bin(n, p) <= k) for k < n p, summed term by term in logarithms; 1 for
    larger k."""
    odds = F.log(F.lit(p / (1 - p)))
    start = F.struct((n * F.log(F.lit(1 - p))).alias("term"), (n * F.log(F.lit(1 - p))).alias("sum"))

    def step(a: Column, j: Column) -> Column:
        term = a["term"] + F.log(n - j + 1) - F.log(j) + odds
        high = F.greatest(a["sum"], term)
        return F.struct(term.alias("term"), (high + F.log(F.exp(a["sum"] - high) + F.exp(term - high))).alias("sum"))

    terms = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.when(k < n * p, F.aggregate(terms, start, step, lambda a: F.exp(a["sum"]))).otherwise(F.lit(1.0))


def cutoffs(measured: DataFrame, labels: DataFrame, q: str, stratum: str) -> DataFrame:
    """stratum, rule, cutoff of the certified rules. ``measured`` has doc_id, the
    struct ``q`` and the column ``stratum``."""
    judged = labels.select(labels["doc_id"].cast("long").alias("label_id"), labels["quality"].cast("int").alias("quality")).dropna()
    judged = judged.groupBy("label_id").agg(F.max("quality").alias("good"))
    rows = measured.filter(~base_failed(F.col(q))).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(stratum).alias("stratum"), F.col(q).alias("q"))
    rows = rows.join(judged, rows["doc_id"] == judged["label_id"])
    holdout = F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 1) < "8"

    def steps(rule: str) -> Column:  # grid cutoffs below the ratio: those that reject
        return sum((F.when(_ratio(F.col("q"), rule) > c, 1).otherwise(0) for c in RULES[rule][2]), F.lit(0))

    each = F.array(*[F.struct(F.lit(r).alias("rule"), steps(r).alias("steps")) for r in RULES])
    counted = rows.select("stratum", "good", holdout.alias("holdout"), F.inline(each)).groupBy("stratum", "rule", "steps").agg(
        F.count(F.when(F.col("holdout") & (F.col("good") == 1), 1)).alias("n"),
        F.count(F.when(~F.col("holdout") & (F.col("good") == 1), 1)).alias("tune_good"),
        F.count(F.when(~F.col("holdout") & (F.col("good") == 0), 1)).alias("tune_bad"),
    )
    grid = F.array(*[F.lit(i) for i in range(max(len(r[2]) for r in RULES.values()))])
    beyond = lambda c: F.sum(F.when(F.col("steps") > F.col("step"), F.col(c)).otherwise(0))
    tried = counted.withColumn("step", F.explode(grid)).groupBy("stratum", "rule", "step").agg(
        beyond("n").alias("k"), F.sum("n").alias("n"), beyond("tune_good").alias("lost"), F.sum("tune_good").alias("tune_n"), beyond("tune_bad").alias("caught"))
    proposed = tried.filter((F.col("caught") > 0) & (F.col("lost") <= F.col("tune_n") * (ALPHA / 2)))
    # most caught first, then the most lenient step
    best = proposed.groupBy("stratum", "rule").agg(F.max(F.struct("caught", "step", "n", "k")).alias("b")).select("stratum", "rule", "b.*")
    ordered = best.withColumn("place", F.row_number().over(Window.partitionBy("stratum").orderBy(F.desc("caught"), "rule")))  # six rows at most
    listed = ordered.groupBy(F.col("stratum").alias("of")).agg(F.collect_list(F.struct("place", "rule", "step")).alias("proposals"))
    # of each good holdout document, the first proposal that rejects it
    good = rows.filter(holdout & (F.col("good") == 1)).select("stratum", F.map_from_entries(each).alias("steps"))
    hits = F.filter("proposals", lambda x: F.element_at(F.col("steps"), x["rule"]) > x["step"])
    first = good.join(listed, F.col("stratum").eqNullSafe(F.col("of"))).select("of", F.array_min(F.transform(hits, lambda x: x["place"])).alias("first"))
    lost = first.dropna(subset=["first"]).groupBy("of", "first").agg(F.count(F.lit(1)).alias("lost"))
    joint = ordered.join(lost, F.col("stratum").eqNullSafe(F.col("of")) & (F.col("first") <= F.col("place")), "left")
    joint = joint.groupBy("stratum", "rule", "step", "place", "n").agg(F.coalesce(F.sum("lost"), F.lit(0)).alias("joint"))
    tests = best.agg(F.count(F.lit(1)).alias("tests"))
    sure = joint.crossJoin(tests).withColumn("sure", tail_at_most(F.col("n"), F.col("joint"), ALPHA) <= DELTA / F.col("tests"))
    last = F.max(F.when(F.col("sure"), F.col("place"))).over(Window.partitionBy("stratum"))
    held = sure.withColumn("last", last).filter(F.col("place") <= F.col("last"))
    values = F.create_map(*[x for r, (_, _, g) in RULES.items() for x in (F.lit(r), F.array(*[F.lit(c) for c in g]))])
    return held.select("stratum", "rule", F.element_at(F.element_at(values, F.col("rule")), F.col("step") + 1).alias("cutoff"))


def judge(measured: DataFrame, labels: DataFrame, q: str, out: str, stratum: str = "lang") -> DataFrame:
    """``measured`` with the boolean ``out``, whether a row stays. The certified cutoffs,
    at most one per labelled stratum and rule, become part of the expression; where there
    are more than ``INLINE_CUTOFFS``, each stratum's are joined to its rows."""
    found = cut(cutoffs(measured, labels, q, stratum), "cutoffs")
    few = found.limit(INLINE_CUTOFFS + 1).collect()
    rejected = base_failed(F.col(q))
    if len(few) <= INLINE_CUTOFFS:
        for r in sorted(few, key=lambda r: (r["stratum"] is not None, str(r["stratum"]), r["rule"])):
            rejected = rejected | (F.col(stratum).eqNullSafe(F.lit(r["stratum"])) & (_ratio(F.col(q), r["rule"]) > r["cutoff"]))
        return measured.withColumn(out, ~F.coalesce(rejected, F.lit(False)))
    of, each = fresh(measured, "of_", "cutoffs_")
    listed = found.groupBy(F.col("stratum").alias(of)).agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias(each))
    for r in RULES:
        rejected = rejected | F.coalesce(_ratio(F.col(q), r) > F.try_element_at(F.col(each), F.lit(r)), F.lit(False))
    joined = measured.join(listed, F.col(stratum).eqNullSafe(F.col(of)), "left")
    return joined.withColumn(out, ~F.coalesce(rejected, F.lit(False))).drop(of, each)


def assign(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """One row per row of ``docs``: doc_id, the metrics, base_failed, kept."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs[stratum].alias("stratum"), text_of(docs).alias("text"))
    rows = cut(measure(rows, "q").drop("text"), "quality")
    rows = judge(rows, labels, "q", "kept", "stratum")
    return rows.select("doc_id", *[F.col(f"q.{m}").alias(m) for m in METRICS[:5]], base_failed(F.col("q")).alias("base_failed"), "kept")


def keep(docs: DataFrame, labels: DataFrame, stratum: str = "lang") -> DataFrame:
    """``docs`` without the rejected rows; all columns stay."""
    q, stays = fresh(docs, "quality_", "stays_")
    rows = cut(measure(docs, q), "quality")
    return judge(rows, labels, q, stays, stratum).filter(F.col(stays)).select(*[F.col(f"`{c}`") for c in docs.columns])


_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_BARE = "translate({}, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')"


ORACLE_METRICS = f"""w AS (SELECT doc_id, lang, coalesce(text, '') AS t, {_WORDS} AS words, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: {_BARE.format('x')} <> '') AS lines FROM documents),
win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(words[i:i + 7], ' ')) AS c FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 6, 1))) AS i FROM w)),
rep AS (SELECT doc_id, count(DISTINCT i + o) AS n FROM win, range(8) r(o) WHERE c > 1 GROUP BY doc_id),
m AS (SELECT w.doc_id, lang, CAST(len(words) AS BIGINT) AS n_words, CAST(length({_BARE.format('t')}) AS BIGINT) AS word_chars,
  CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  coalesce(rep.n, 0) AS n_repeat_words, len(lines) AS n_lines, length(t) - length(replace(t, '!', '')) AS n_bangs,
  length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS n_capitals FROM w LEFT JOIN rep USING (doc_id))"""


def _oracle(metrics: str) -> str:
    """The verdict in SQL over the CTE ``m`` of ``metrics``."""
    ratio = lambda r: f"CAST({RULES[r][0]} AS DOUBLE) / CAST({RULES[r][1]} AS DOUBLE)"
    steps = " UNION ALL ".join(f"SELECT doc_id, '{r}' AS rule, i AS step, cutoff, {ratio(r)} > cutoff AS hit FROM base, (SELECT unnest(range({len(g)})) AS i, unnest({list(g)}) AS cutoff)" for r, (_, _, g) in RULES.items())
    return f"""
WITH {metrics},
f AS MATERIALIZED (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PCT} * n_words AS base_failed FROM m),
base AS (SELECT * FROM f WHERE NOT base_failed),
hits AS MATERIALIZED ({steps}),
lab AS (SELECT doc_id, max(quality) AS good, substr(md5(CAST(doc_id AS VARCHAR)), 1, 1) < '8' AS holdout FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id),
tried AS MATERIALIZED (SELECT lang, rule, step, cutoff, count(*) FILTER (holdout AND good = 1) AS n, count(*) FILTER (holdout AND good = 1 AND hit) AS k,
  count(*) FILTER (NOT holdout AND good = 1) AS tune_n, count(*) FILTER (NOT holdout AND good = 1 AND hit) AS lost,
  count(*) FILTER (NOT holdout AND good = 0 AND hit) AS caught FROM hits JOIN lab USING (doc_id) JOIN base USING (doc_id) GROUP BY ALL),
best AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY caught DESC, rule) AS place FROM (
  SELECT * FROM tried WHERE caught > 0 AND lost <= tune_n * {ALPHA / 2}
  QUALIFY row_number() OVER (PARTITION BY lang, rule ORDER BY caught DESC, step DESC) = 1)),
firsts AS (SELECT base.lang, doc_id, min(place) AS place FROM hits JOIN lab USING (doc_id) JOIN base USING (doc_id) JOIN best ON best.lang IS NOT DISTINCT FROM base.lang AND best.rule = hits.rule AND best.cutoff = hits.cutoff
  WHERE hit AND holdout AND good = 1 GROUP BY ALL),
joint AS (SELECT b.lang, b.rule, b.cutoff, b.place, b.n, count(f.doc_id) AS k FROM best b LEFT JOIN firsts f ON f.lang IS NOT DISTINCT FROM b.lang AND f.place <= b.place GROUP BY ALL),
sure AS (SELECT lang, max(place) AS last FROM joint WHERE k < n * {ALPHA} AND (SELECT sum(exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln({ALPHA}) + (n - j) * ln({1 - ALPHA}))) FROM (SELECT unnest(range(k + 1)) AS j)) <= {DELTA} / (SELECT count(*) FROM best) GROUP BY lang),
held AS (SELECT joint.lang, rule, cutoff FROM joint JOIN sure ON sure.lang IS NOT DISTINCT FROM joint.lang AND place <= last),
out AS (SELECT DISTINCT hits.doc_id FROM hits JOIN base USING (doc_id) JOIN held ON held.lang IS NOT DISTINCT FROM base.lang AND held.rule = hits.rule AND held.cutoff = hits.cutoff WHERE hit)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM out) AS kept FROM f"""


ORACLE_SQL = _oracle(ORACLE_METRICS)
