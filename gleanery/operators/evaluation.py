"""Evaluation runs: prompts, scoring, paired statistics, comparisons on common questions."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from gleanery.functions import text as T
from gleanery.operators.scan import runs
from gleanery.schema import LETTERS, MODES

# Fixed values of the statistics.
Z = 1.959963984540054
RESAMPLES, SEED, LOW, HIGH = 2000, 20261113, 49, 1949
MODELS = 1000
IMAGE_PATH = r"\Aimages/[A-Za-z0-9_.-]+\.(png|jpg|jpeg)\z"


def user_text(material: Column, question: Column, options: Column) -> Column:
    """The question as it is put: material if there is any, stem, options, parted by blank lines."""
    shown = F.when(F.coalesce(material, F.lit("")).rlike(r"(?U)\S"), F.concat(F.lit("材料：\n"), material))
    listed = F.concat_ws("\n", *(F.concat(F.lit(f"{x}. "), options[x]) for x in LETTERS))
    return F.concat_ws("\n\n", shown, F.concat(F.lit("题目：\n"), question), listed)


def image_references(items: DataFrame) -> DataFrame:
    """items with `images_ok`: paths and fingerprints pair up, are well formed, and are there if the item has an image."""
    paths, hashes = F.coalesce("image_paths", F.array().cast("array<string>")), F.coalesce("image_sha256", F.array().cast("array<string>"))
    fine = F.forall(paths, lambda p: p.rlike(IMAGE_PATH)) & F.forall(hashes, lambda h: h.rlike(r"\A[a-f0-9]{64}\z"))
    return items.withColumn("images_ok", fine & (F.size(paths) == F.size(hashes)) & ~(F.coalesce("has_image", F.lit(False)) & (F.size(paths) == 0)))


def invalid_items(items: DataFrame) -> DataFrame:
    """(question_id, reason) of items that a run may not use; ids must be unique, stems and options filled."""
    blank = lambda c: ~F.coalesce(c, F.lit("")).rlike(r"(?U)\S")
    again = items.filter("question_id <> ''").groupBy("question_id").count().filter("count > 1").select("question_id", F.lit(True).alias("_again"))
    items = items.join(again, "question_id", "left")
    twice = F.coalesce("_again", F.lit(False))
    empty = blank(F.col("options.A")) | blank(F.col("options.B")) | blank(F.col("options.C")) | blank(F.col("options.D"))
    reason = F.when(F.coalesce("question_id", F.lit("")) == "", "id").when(twice, "duplicate").when(blank(F.col("question")), "stem").when(empty, "options").when(F.col("answer").isNotNull() & ~F.col("answer").isin(*LETTERS), "answer")
    return items.select("question_id", reason.alias("reason")).filter("reason is not null")


def score(finish_reason: Column, refusal: Column, content: Column, mode: Column, gold: Column, answered: Column) -> tuple[Column, Column]:
    """(status, prediction) of a response; `answered` is false where there was none."""
    told = T.final_answer(content, mode)
    cut, refused = finish_reason.isin("length", "max_tokens"), finish_reason.isin("content_filter", "safety") | (F.coalesce(refusal, F.lit("")) != "")
    cut, refused = F.coalesce(cut, F.lit(False)), F.coalesce(refused, F.lit(False))
    status = (
        F.when(~answered, "api_error").when(cut, "truncated").when(refused, "refused").when(told.isNull(), "format_error")
        .when(gold.isNull(), "answered").when(told == gold, "correct").otherwise("incorrect")
    )
    return status, F.when(answered & ~cut & ~refused, told)


def wilson(correct: Column, n: Column) -> tuple[Column, Column]:
    p, n = correct / n, n.cast("double")
    low = 1 + Z * Z / n
    center, half = (p + Z * Z / (2 * n)) / low, Z * F.sqrt(p * (1 - p) / n + Z * Z / (4 * n * n)) / low
    return F.when(n > 0, center - half), F.when(n > 0, center + half)


def _with_models(df: DataFrame, results: DataFrame) -> DataFrame:
    """df once for each model of the results: a comparison has at most MODELS, which is checked."""
    models = [r.model for r in results.select("model").distinct().orderBy("model").limit(MODELS + 1).collect()]
    if len(models) > MODELS:
        raise ValueError(f"more than {MODELS} models in a comparison")
    listed = F.array(*map(F.lit, models)) if models else F.array().cast("array<string>")
    return df.withColumn("model", F.explode(listed))


def run_metrics(items: DataFrame, results: DataFrame, by: list[str], modes=MODES) -> DataFrame:
    """Per model, mode and group of items: planned, attempted, pending, each status, accuracies, Wilson interval.

    items: (question_id, *by); results: (model, question_id, mode, status, gold_ok). Groups and modes without results
    appear, with their planned items.
    """
    planned = items.groupBy(*by).agg(F.count("*").alias("planned"))
    planned = planned.withColumn("mode", F.explode(F.array(*(F.lit(m) for m in modes))))
    grid = _with_models(planned, results)
    statuses = ("correct", "incorrect", "truncated", "refused", "format_error", "answered", "api_error")
    got = results.join(items, "question_id").groupBy("model", "mode", *by).agg(F.count("*").alias("attempted"), F.bool_and("gold_ok").alias("_gold"), *(F.count_if(F.col("status") == s).alias(s) for s in statuses))
    same = [grid[c].eqNullSafe(got[c]) for c in ("model", "mode", *by)]
    out = grid.join(got, _all(same), "left").select(grid["*"], *(F.coalesce(got[c], F.lit(0)).alias(c) for c in ("attempted", *statuses)), got["_gold"])
    low, high = wilson(F.col("correct"), F.col("attempted"))
    valid = F.col("correct") + F.col("incorrect")
    return out.withColumns({
        "pending": F.col("planned") - F.col("attempted"), "accuracy_over_attempted": F.when((F.col("attempted") > 0) & F.col("_gold"), F.col("correct") / F.col("attempted")),
        "accuracy_valid_answers_only": F.when(valid > 0, F.col("correct") / valid), "wilson_low": low, "wilson_high": high,
    }).drop("_gold")


def _all(conditions):
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def pairs(results: DataFrame) -> DataFrame:
    """(model, question_id, direct, cot) of questions with both modes. Of repeated results of a mode the last status by name counts."""
    by = results.groupBy("model", "question_id").pivot("mode", list(MODES)).agg(F.max("status"))
    return by.filter("direct is not null and cot is not null")


def transitions(pairs_: DataFrame) -> DataFrame:
    """Per model: pairs of valid answers, each of the four transitions, and cot minus direct."""
    valid = pairs_.filter(F.col("direct").isin("correct", "incorrect") & F.col("cot").isin("correct", "incorrect"))
    names = [f"{a}_to_{b}" for a in ("correct", "incorrect") for b in ("correct", "incorrect")]
    out = valid.groupBy("model").agg(F.count("*").alias("paired_valid_answers"), *(F.count_if(F.concat_ws("_to_", "direct", "cot") == n).alias(n) for n in names))
    return out.withColumn("paired_cot_minus_direct", (F.col("incorrect_to_correct") - F.col("correct_to_incorrect")) / F.col("paired_valid_answers"))


COUNTED = 1000  # changes up to which p is worked out in whole numbers


def _exact_p(improved, degraded):
    """2 P(X <= k) of d fair coins. Of many, the largest term comes from its distance to the middle and Stirling's series, and each
    one below it from the one before, until they no longer count: about as many as the root of d."""
    import math

    import numpy as np

    d, k = improved + degraded, min(improved, degraded)
    if d <= COUNTED:
        return min(1.0, 2 * sum(math.comb(d, i) for i in range(k + 1)) / 2**d) if d else 1.0
    if k < 16:
        return min(1.0, math.exp(math.log(2 * sum(math.comb(d, i) for i in range(k + 1))) - d * math.log(2)))
    series = lambda n: 1 / (12 * n) - 1 / (360 * n**3) + 1 / (1260 * n**5)
    x = (d - 2 * k) / d
    most = math.exp(series(d) - series(k) - series(d - k) - d / 2 * ((1 - x) * math.log1p(-x) + (1 + x) * math.log1p(x))) * math.sqrt(2 / (math.pi * d * (1 - x * x)))
    total, last, at = 1.0, 1.0, k
    while at > 0 and last > 1e-18:
        i = np.arange(at, max(0, at - 65536), -1, dtype=np.float64)
        terms = last * np.cumprod(i / (d - i + 1))
        total, last, at = total + float(terms.sum()), float(terms[-1]), at - len(i)
    return min(1.0, 2 * most * total)


@F.pandas_udf(DoubleType())
def mcnemar_p(improved: pd.Series, degraded: pd.Series) -> pd.Series:
    """Exact two-sided p of a McNemar test; runs on rows already aggregated."""
    return pd.Series([_exact_p(int(a), int(b)) for a, b in zip(improved, degraded, strict=True)], dtype="float64")


def paired_stats(pairs_: DataFrame, by: list[str]) -> DataFrame:
    """Per group: pairs, delta, improved, degraded, both_correct, both_incorrect_or_failed, mcnemar_exact_p. Failures count as incorrect."""
    d, c = F.col("direct") == "correct", F.col("cot") == "correct"
    out = pairs_.groupBy(*by).agg(
        F.count("*").alias("pairs"), F.count_if(c & ~d).alias("improved"), F.count_if(d & ~c).alias("degraded"), F.count_if(c & d).alias("both_correct"), F.count_if(~c & ~d).alias("both_incorrect_or_failed"),
    )
    return out.withColumn("delta", (F.col("improved") - F.col("degraded")) / F.col("pairs")).withColumn("mcnemar_exact_p", mcnemar_p("improved", "degraded"))


def bootstrap_interval(pairs_: DataFrame, by: list[str], order: str = "question_id") -> DataFrame:
    """(by, boot_low, boot_high): paired bootstrap with a fixed seed, pairs in the order of `order`.

    Draws depend on the order of pairs, so a group's changes, each with what it is ordered by, go to one task as one array; groups
    run in parallel. For groups beyond a task's memory there is bootstrap_bounds.
    """

    def run(pdf):
        import random

        import numpy as np

        out = []
        for row in pdf.itertuples(index=False):
            changes = np.array([x["c"] if isinstance(x, dict) else x[1] for x in row.ordered], dtype=np.int64)
            # the draws of Python's generator, made by numpy from the same state
            state = random.Random(SEED).getstate()[1]
            draws = np.random.RandomState()
            draws.set_state(("MT19937", np.array(state[:-1], dtype=np.uint32), state[-1]))
            n = len(changes)
            boot = sorted(int(changes[(draws.random_sample(n) * n).astype(np.int64)].sum()) / n for _ in range(RESAMPLES))
            out.append((*(getattr(row, b) for b in by), boot[LOW], boot[HIGH]))
        return pd.DataFrame(out, columns=[*by, "boot_low", "boot_high"])

    change = (F.col("cot") == "correct").cast("int") - (F.col("direct") == "correct").cast("int")
    gathered = pairs_.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), change.alias("c")))).alias("ordered"))
    types = dict(gathered.dtypes)
    return gathered.repartitionByRange(gathered.sparkSession.sparkContext.defaultParallelism, *by).mapInPandas(lambda it: (run(p) for p in it), ", ".join(f"{b} {types[b]}" for b in by) + ", boot_low double, boot_high double")


def bootstrap_bounds(pairs_: DataFrame, by: list[str], resamples: int = RESAMPLES, seed: int = SEED) -> DataFrame:
    """(by, n, boot_low, boot_high): the paired bootstrap from counts, for groups of any size.

    A change is -1, 0 or 1, so how often each is drawn is multinomial in their counts, and a resample's mean needs nothing else. The counts
    are combined before the shuffle; what is drawn works on three numbers a group. Same distribution as bootstrap_interval, other draws.
    """
    low, high = round(LOW * resamples / RESAMPLES), round(HIGH * resamples / RESAMPLES)

    def run(lost: pd.Series, same: pd.Series, won: pd.Series) -> pd.DataFrame:
        import numpy as np

        out = []
        for counts in zip(lost, same, won, strict=True):
            n = sum(counts)
            drawn = np.random.default_rng(seed).multinomial(n, np.array(counts) / n, size=resamples)
            means = np.sort(drawn[:, 2] - drawn[:, 0]) / n
            out.append((float(means[low]), float(means[high])))
        return pd.DataFrame(out, columns=["low", "high"])

    run.__annotations__ = {"lost": pd.Series, "same": pd.Series, "won": pd.Series, "return": pd.DataFrame}
    change = (F.col("cot") == "correct").cast("int") - (F.col("direct") == "correct").cast("int")
    counts = pairs_.groupBy(*by).agg(F.count("*").alias("n"), *(F.count_if(change == c).alias(name) for c, name in ((-1, "_lost"), (0, "_same"), (1, "_won"))))
    bounds = F.pandas_udf(run, "low double, high double")("_lost", "_same", "_won")
    return counts.withColumn("_b", bounds).select(*by, "n", F.col("_b.low").alias("boot_low"), F.col("_b.high").alias("boot_high"))


def common_questions(results: DataFrame, modes=MODES) -> DataFrame:
    """(question_id) completed by every model in every mode."""
    models = results.agg(F.count_distinct("model").alias("_m"))
    done = results.filter(F.col("mode").isin(*modes)).groupBy("question_id").agg(F.count_distinct("model", "mode").alias("_n"))
    return done.join(F.broadcast(models), F.col("_n") == F.col("_m") * len(modes)).select("question_id")


BITS = 8 * 4096  # of a bitmap of Spark's


def numbered_in_all(results: DataFrame, modes=MODES) -> DataFrame:
    """(question_id) completed by every model in every mode, of questions with numbers for ids.

    What a model has done in a mode is a bitmap for each 32,768 ids, made before the shuffle; they are intersected by range of ids. So
    4 KB travel for as many ids as a range has, where common_questions sends a row for each of them.
    """
    done = results.filter(F.col("mode").isin(*modes))
    held = done.groupBy("model", "mode", F.bitmap_bucket_number("question_id").alias("_b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("question_id")).alias("_bits"))
    models = results.agg((F.count_distinct("model") * len(modes)).alias("_all"))
    both = held.groupBy("_b").agg(F.count("*").alias("_n"), F.bitmap_and_agg("_bits").alias("_bits")).join(F.broadcast(models), F.col("_n") == F.col("_all"))  # one row
    byte = lambda i: F.conv(F.hex(F.substring("_bits", i + 1, F.lit(1))), 16, 10).cast("int")
    full = F.filter(F.transform(F.sequence(F.lit(0), F.lit(BITS // 8 - 1)), lambda i: F.struct(i.alias("i"), byte(i).alias("v"))), lambda x: x["v"] > 0)
    of_byte = lambda x: F.transform(F.filter(F.sequence(F.lit(0), F.lit(7)), lambda k: F.getbit(x["v"], k) == 1), lambda k: x["i"] * 8 + k)
    at = both.select("_b", F.explode(F.flatten(F.transform(full, of_byte))).alias("_p"))
    return at.select(F.when(F.col("_b") > 0, (F.col("_b") - 1) * BITS + F.col("_p") + 1).otherwise(F.col("_b") * BITS - F.col("_p")).alias("question_id"))


def comparison(results: DataFrame) -> DataFrame:
    """paired_stats of every model on the common questions. A question's models meet once: each brings its statuses and how many modes it
    has done, and the question is common if these add up to all (as of common_questions, which is not worked out beside it)."""
    of = lambda m: F.max(F.when(F.col("mode") == m, F.col("status"))).alias(m)
    modes = _total([F.max(F.when(F.col("mode") == m, 1).otherwise(0)) for m in MODES])
    by = results.filter("question_id is not null").groupBy("model", "question_id").agg(*map(of, MODES), F.when(F.col("model").isNotNull(), modes).otherwise(0).alias("_done"))
    models = results.agg((F.count_distinct("model") * len(MODES)).alias("_all"))
    met = by.withColumn("_done", F.sum("_done").over(Window.partitionBy("question_id"))).join(F.broadcast(models), F.col("_done") == F.col("_all"))  # one row
    return paired_stats(met.filter("direct is not null and cot is not null"), ["model"])


def _total(columns):
    out = columns[0]
    for c in columns[1:]:
        out = out + c
    return out


def error_cases(items: DataFrame, results: DataFrame) -> DataFrame:
    """model x item where either mode is missing (pending) or not correct."""
    by = results.groupBy("model", "question_id").pivot("mode", list(MODES)).agg(F.max("status").alias("status"), F.max_by("prediction", F.struct("status", "prediction")).alias("prediction"))
    out = _with_models(items, results).join(by, ["model", "question_id"], "left")
    status = lambda m: F.coalesce(f"{m}_status", F.lit("pending"))
    out = out.select("model", "question_id", *(status(m).alias(f"{m}_status") for m in MODES), *(F.coalesce(f"{m}_prediction", F.lit("")).alias(f"{m}_prediction") for m in MODES), *(c for c in items.columns if c != "question_id"))
    return out.filter("direct_status <> 'correct' or cot_status <> 'correct'")


def result_problems(results: DataFrame, items: DataFrame, planned: DataFrame) -> DataFrame:
    """(model, question_id, mode, problem) of results that are repeated, not planned, or whose input differs.

    items: (question_id, text); results need a column `sent`, the text that was put.
    """
    twice = F.count("*").over(Window.partitionBy("model", "question_id", "mode")) > 1
    out = results.withColumn("_twice", twice).join(planned.select("question_id", F.lit(True).alias("_planned")), "question_id", "left").join(items.select("question_id", F.col("text").alias("_text")), "question_id", "left")
    problem = F.when(F.col("_twice"), "duplicate").when(F.col("_planned").isNull() | ~F.col("mode").isin(*MODES), "unplanned").when(~F.col("sent").eqNullSafe(F.col("_text")), "input")
    return out.select("model", "question_id", "mode", problem.alias("problem")).filter("problem is not null")


def with_labels(items: DataFrame, labels: DataFrame) -> DataFrame:
    """items with knowledge_module; raises unless labels cover each item exactly once and none is blank."""
    both = items.select("question_id", F.lit(1).alias("_i")).join(labels.select("question_id", "knowledge_module"), "question_id", "full_outer")
    bad = both.groupBy("question_id").agg(F.count("*").alias("n"), F.min("_i").alias("i"), F.min("knowledge_module").alias("m")).filter("n > 1 or i is null or m is null or trim(m) = ''")
    if not bad.isEmpty():
        raise ValueError("labels and items differ")
    return items.join(labels.select("question_id", "knowledge_module"), "question_id")


def pending_work(planned: DataFrame, done: DataFrame, retry: tuple[str, ...] = ()) -> DataFrame:
    """Planned (question_id, mode) that are not done; those done with a status in `retry` count as not done."""
    return planned.join(done.filter(~F.col("status").isin(*retry)) if retry else done, ["question_id", "mode"], "left_anti")


def error_islands(log: DataFrame, order: str, limit: int = 5) -> DataFrame:
    """Runs of consecutive api errors per model: (model, first, last, n, tripped); tripped at `limit` or more."""
    return runs(log, "model", order, F.col("status") == "api_error").withColumn("tripped", F.col("n") >= limit)
