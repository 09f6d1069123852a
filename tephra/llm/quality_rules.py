"""Quality rules whose cutoffs come with a guarantee: per stratum, few good documents are rejected. DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import BLANKS, UPPER, packed, table

SYMBOLS = "#*$%&|<>"
#: metric: (count, out of); a cutoff is a share in steps of 1/STEPS, and a higher share is worse.
METRICS = {"symbols": ("n_symbols", "word_chars"), "dup_lines": ("n_dup_lines", "n_lines"), "repeats": ("n_repeat_words", "n_words"), "capitals": ("n_capitals", "word_chars")}
STEPS = 50
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals"]


def without(text: Column, characters: str) -> Column:
    return F.char_length(F.translate(text, characters, ""))


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", keep: bool = True) -> DataFrame:
    """(doc, id, stratum, signature, COUNTS): what the rules look at, for each whole text; `doc` is the row itself, or without `keep` only a null.

    A three-word window counts as repeated by a 64-bit hash of its words. A null text is empty, a null stratum is one of its own.
    """
    rows = packed(docs, id_col, text_col).select(F.col("doc") if keep else F.lit(None).cast("string").alias("doc"), "id", F.coalesce(F.col(f"doc.`{stratum_col}`").cast("string"), F.lit("")).alias("stratum"),
                                                 F.coalesce("text", F.lit("")).alias("text"))
    words = F.array_remove(F.split(F.translate("text", BLANKS, " " * len(BLANKS)), " "), "")
    lines = F.filter(F.split("text", "\n"), lambda line: F.btrim(line, F.lit(BLANKS)) != "")
    keep_cols = ["doc", "id", "stratum", "signature", "word_chars", "n_symbols", "n_capitals"]
    rows = rows.select("doc", "id", "stratum", F.md5("text").alias("signature"), without(F.col("text"), BLANKS).alias("word_chars"), (F.char_length("text") - without(F.col("text"), SYMBOLS)).alias("n_symbols"),
                       (F.char_length("text") - without(F.col("text"), UPPER)).alias("n_capitals"), lines.alias("lines"), F.transform(words, lambda w: F.xxhash64(w)).alias("words"))
    at = F.when(F.size("words") >= 3, F.sequence(F.lit(0), F.size("words") - 3)).otherwise(F.array().cast("array<int>"))
    rows = rows.select(*keep_cols, F.size("words").alias("n_words"), F.size("lines").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
                       F.transform(at, lambda i: F.xxhash64(F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))).alias("windows"))
    rest = [*keep_cols, "n_words", "n_lines", "n_dup_lines"]
    # most texts repeat no window: only the others are sorted
    some = F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    rows = rows.select(*rest, some.alias("windows"))
    twice = F.filter("windows", lambda x, j: (x["h"] == F.get("windows", j - 1)["h"]) | (x["h"] == F.get("windows", j + 1)["h"]))
    rows = rows.select(*rest, F.transform(twice, lambda x: x["i"]).alias("starts"))
    covered = F.array_distinct(F.concat("starts", F.transform("starts", lambda i: i + 1), F.transform("starts", lambda i: i + 2)))
    rows = rows.select(*rest, F.coalesce(F.size(F.when(F.col("starts").isNotNull(), covered)), F.lit(0)).alias("n_repeat_words"))
    rows = rows.withColumn("n_repeat_words", F.greatest("n_repeat_words", F.lit(0)))
    return rows.select("doc", "id", "stratum", "signature", *[F.col(c).cast("long") for c in COUNTS])


def step_of(metric: str) -> Column:
    """The share of a metric in steps, rounded up, exactly: it exceeds cutoff k / STEPS if and only if this exceeds k."""
    count, of = METRICS[metric]
    return F.when(F.col(of) > 0, F.floor((F.col(count) * STEPS + F.col(of) - 1) / F.col(of)).cast("int")).otherwise(0)


def most_allowed(n: Column, alpha: float, delta: float) -> Column:
    """The largest k with P(Binomial(n, alpha) <= k) <= delta, or -1: so many false rejections among n good documents still prove,
    at level delta, a rate of at most alpha. The exact sum, each term from the one before it in logarithms."""
    odds = alpha / (1 - alpha)
    zero = F.struct((n * F.log(F.lit(1 - alpha))).cast("double").alias("term"), F.lit(0.0).alias("sum"), F.lit(-1).alias("best"))

    def add(s: Column, k: Column) -> Column:
        term = F.when(k == 0, s["term"]).otherwise(s["term"] + F.log((n - k + 1) / k * odds))
        total = s["sum"] + F.exp(term)
        return F.struct(term.alias("term"), total.alias("sum"), F.when(total <= delta, k).otherwise(s["best"]).alias("best"))
    return F.aggregate(F.sequence(F.lit(0), F.ceil(n * alpha).cast("int")), zero, add)["best"]


def cutoffs(measured: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", alpha: float = 0.05, delta: float = 0.05, good_weight: float = 4.0) -> DataFrame:
    """(stratum, one column for each metric): the cutoff step, null where none helps or none is proven.

    Labelled rows fall into two folds by their text, and copies of a text count once (as good, if any is labelled so). On the
    fit fold each cutoff earns the bad documents it rejects less `good_weight` times the good ones. On the holdout each is tested: the
    exact binomial bound on its false rejections must not exceed alpha / metrics, at level delta / (strata * metrics); within a
    chain from the mildest cutoff down, rejections only grow, so testing stops at the first failure without a further
    correction. Of the proven cutoffs the one that earns most is taken. So with probability 1 - delta, in every stratum at
    once, the rules together reject at most a share alpha of good documents like the labelled ones.
    """
    marked = labels.select(F.col(id_col).alias("label_id"), F.col(label_col).alias("label")).where(F.col("label").isNotNull() & F.col("label_id").isNotNull())
    marked = marked.groupBy("label_id").agg(F.max("label").alias("label"))
    known = (measured.join(marked, F.col("id") == F.col("label_id")).groupBy("stratum", "signature")
             .agg(F.max("label").alias("label"), *[F.first(c).alias(c) for c in COUNTS])
             .select("stratum", (F.col("label") > 0).alias("good"), (F.substring("signature", 1, 1) < "8").alias("held"), *[step_of(m).alias(m) for m in METRICS]))
    known = materialize(known)
    good_held = F.col("good") & F.col("held")
    strata = materialize(known.groupBy("stratum").agg(F.count(F.when(good_held, 1)).alias("n")))
    tests = max(1, strata.count()) * len(METRICS)
    allowed = strata.select(F.col("stratum").alias("in_stratum"), most_allowed(F.col("n"), alpha / len(METRICS), delta / tests).alias("allowed"))
    each = known.select("stratum", "good", "held", F.explode(F.map_from_arrays(F.array(*map(F.lit, METRICS)), F.array(*METRICS))).alias("metric", "step"))
    each = each.groupBy("stratum", "metric", "step", "good", "held").count().where(F.col("step") > 0)
    each = each.select("stratum", "metric", "good", "held", "count", F.explode(F.sequence(F.lit(0), F.col("step") - 1)).alias("cutoff"))
    total = lambda when: F.sum(F.when(when, F.col("count")).otherwise(0))
    each = each.groupBy("stratum", "metric", "cutoff").agg(total(good_held).alias("false_held"), (total(~F.col("good") & ~F.col("held")) - good_weight * total(F.col("good") & ~F.col("held"))).alias("earned"))
    proven = each.join(allowed, F.col("stratum") == F.col("in_stratum")).where((F.col("false_held") <= F.col("allowed")) & (F.col("earned") > 0))
    best = proven.groupBy("stratum", "metric").agg(F.max(F.struct("earned", "cutoff"))["cutoff"].alias("cutoff"))
    return best.groupBy(F.col("stratum").alias("for_stratum")).agg(*[F.max(F.when(F.col("metric") == m, F.col("cutoff"))).alias(f"cut_{m}") for m in METRICS])


def verdicts(measured: DataFrame, chosen: DataFrame) -> DataFrame:
    """`measured` with base_failed, failed (the metrics over their stratum's cutoff) and kept. Strata without cutoffs reject nothing beyond the base."""
    judged = measured.join(chosen, F.col("stratum") == F.col("for_stratum"), "left")
    over = [F.when(step_of(m) > F.col(f"cut_{m}"), F.lit(m)) for m in METRICS]
    judged = judged.withColumns({"base_failed": (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")), "failed": F.array_compact(F.array(*over))})
    return judged.withColumn("kept", ~F.col("base_failed") & (F.size("failed") == 0)).select(*measured.columns, "base_failed", "failed", "kept")


def quality_rules(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", stratum_col: str = "lang", keep: bool = True, **options) -> DataFrame:
    """(doc, id, counts, base_failed, failed, kept) for every row of `docs`; `labels` has the id and the quality (1 good, 0 bad) of some.

    Null and empty texts have no words and fail the base. Null ids are judged but never labelled. Repeated label rows count once, by
    the larger label; null labels not at all. Repeated documents are each judged. Without labels only the base rejects. Extra columns of `docs` stay in `doc`.
    """
    measured = materialize(measure(docs, id_col, text_col, stratum_col, keep))
    return verdicts(measured, cutoffs(measured, labels, id_col, **options))


def op1_quality_rules(spark, sf_dir):
    out = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), keep=False)
    return out.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


RULES_SQL = """
with d as (select doc_id, coalesce(lang, '') as stratum, coalesce(text, '') as t from documents),
w as (select *, list_filter(string_split_regex(t, '[ \\t-\\r]+'), lambda x: x <> '') as words, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) as lines from d),
g as (select doc_id, p, words[p] as a, words[p + 1] as b, words[p + 2] as c from (select doc_id, words, unnest(range(1, len(words) - 1)) as p from w)),
r as (select doc_id, p from (select doc_id, p, count(*) over (partition by doc_id, a, b, c) as n from g) where n > 1),
q as (select doc_id, count(distinct x) as n_repeat_words from (select doc_id, unnest([p, p + 1, p + 2]) as x from r) group by doc_id),
m as (select w.doc_id, stratum, md5(t) as sig, len(words) as n_words, length(regexp_replace(t, '[ \\t-\\r]+', '', 'g')) as word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) as n_symbols,
             len(lines) - len(list_distinct(lines)) as n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words, len(lines) as n_lines, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) as n_capitals from w left join q using (doc_id)),
s as (select *, [case when word_chars > 0 then (n_symbols * 50 + word_chars - 1) // word_chars else 0 end, case when n_lines > 0 then (n_dup_lines * 50 + n_lines - 1) // n_lines else 0 end,
                 case when n_words > 0 then (n_repeat_words * 50 + n_words - 1) // n_words else 0 end, case when word_chars > 0 then (n_capitals * 50 + word_chars - 1) // word_chars else 0 end] as steps from m),
k as (select stratum, sig, max(label) > 0 as good, sig < '8' as held, any_value(steps) as steps from s join (select doc_id, max(quality) as label from labels where quality is not null group by 1) using (doc_id) group by stratum, sig),
n as (select stratum, count(*) filter (where good and held) as n, count(*) over () * 4 as tests from k group by stratum),
z as (select stratum, n, tests, unnest(range(0, cast(ceil(n * 0.0125) as bigint) + 1)) as j from n),
y as (select stratum, j, tests, sum(case when j > n then 0 else exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(0.0125) + (n - j) * ln(0.9875)) end) over (partition by stratum order by j) as cdf from z),
a as (select stratum, coalesce(max(j) filter (where cdf <= 0.05 / tests), -1) as allowed from y group by stratum),
e as (select stratum, good, held, metric, unnest(range(0, steps[metric])) as cutoff from (select *, unnest([1, 2, 3, 4]) as metric from k)),
c as (select stratum, metric, cutoff, count(*) filter (where good and held) as false_held, count(*) filter (where not good and not held) - 4.0 * count(*) filter (where good and not held) as earned from e group by all),
b as (select stratum, metric, max({'e': earned, 'c': cutoff}).c as cutoff from c join a using (stratum) where false_held <= allowed and earned > 0 group by all),
f as (select s.doc_id, bool_or(s.steps[b.metric] > b.cutoff) as over from s join b using (stratum) group by s.doc_id)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
       not (n_words < 50 or 100 * n_repeat_words > 50 * n_words) and not coalesce(over, false) as kept from s left join f using (doc_id)
"""

QUERIES = {"op1_quality_rules": op1_quality_rules}
ORACLES = {"op1_quality_rules": RULES_SQL}
