"""Quality rules as a learned decision list.

Text statistics are built-in expressions over each whole text. The list is learned by sequential covering:
a rule grows condition by condition (feature above or at most a cut point, largest information gain) on two
thirds of the labelled rows, is pruned to its best prefix on the last third, and the rows it covers leave
before the next rule grows. Every step reads one aggregate of (feature, bin) counts. The result is an
ordered ``CASE WHEN`` over the statistics; a document that a rule takes is rejected by it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import add_once
from riskloom.llm.common import WS, documents, let, paired, records, saved, words_of

WINDOW = 8
#: Labelled rows used for learning: all, or a seeded sample of about this many when there are more.
SAMPLE_ROWS = 20_000
CUTS = 32
MAX_RULES = 8
MAX_CONDITIONS = 4
#: A pruned rule must reject this share of bad rows among those it takes, on the rows kept for pruning.
MIN_PRECISION = 0.95
MIN_BAD = 5

FEATURES = {
    "n_words": "n_words",
    "word_length": "word_chars / greatest(n_words, 1)",
    "symbol_rate": "n_symbols / greatest(n_words, 1)",
    "dup_line_rate": "n_dup_lines / greatest(n_lines, 1)",
    "repeat_rate": "n_repeat_words / greatest(n_words, 1)",
    "capital_rate": "n_capitals / greatest(word_chars, 1)",
    "digit_rate": "n_digits / greatest(word_chars, 1)",
    "bang_rate": "n_bangs / greatest(n_words, 1)",
    "bar_rate": "n_bars / greatest(n_words, 1)",
    "distinct_rate": "n_distinct_words / greatest(n_words, 1)",
    "line_words": "n_words / greatest(n_lines, 1)",
}

Rule = list[tuple[str, str, float]]


def _count(text: Column, chars: str) -> Column:
    return (F.char_length(text) - F.char_length(F.translate(text, chars, ""))).cast("long")


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Words inside windows of eight words that the text has twice or more. Windows are compared by 64-bit hashes."""
    if window != 8:
        raise ValueError("windows are built by doubling; only eight is provided")

    def hashes(w):
        h1 = F.transform(w, lambda x: F.xxhash64(x))
        return let(h1, lambda a: let(paired(a, 1), lambda b: let(paired(b, 2), lambda c: F.slice(
            paired(c, 4), 1, F.greatest(F.size(w) - (window - 1), F.lit(0))
        ))))

    def covered(h):
        order = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("p"))))

        def positions(s):
            twin = lambda x, j: F.coalesce(F.get(s, j)["h"] == x["h"], F.lit(False))
            return F.sort_array(F.transform(
                F.filter(s, lambda x, i: twin(x, i - 1) | twin(x, i + 1)), lambda x: x["p"]
            ))

        def length(p):
            steps = F.zip_with(p, F.slice(p, 2, F.size(p)), lambda a, b: F.coalesce(F.least(b - a, F.lit(window)), F.lit(window)))
            return F.aggregate(steps, F.lit(0), lambda a, x: a + x)

        return let(order, lambda s: let(positions(s), length))

    return let(let(words, hashes), lambda h: F.when(F.size(h) == F.size(F.array_distinct(h)), 0).otherwise(covered(h)))


def text_stats(rows: DataFrame) -> DataFrame:
    """Adds the statistics of ``text`` (null: empty) to rows; counts are whole numbers, all zero for empty texts
    but ``n_lines``, which is one."""
    t = F.col("text")
    rows = add_once(rows, _words=words_of(t))
    lines = F.filter(F.split(t, "\n"), lambda x: F.translate(x, WS, "") != "")
    out = add_once(
        rows,
        n_words=F.size("_words").cast("long"),
        word_chars=F.char_length(F.translate(t, WS, "")).cast("long"),
        n_symbols=_count(t, "#*$%&|<>"),
        n_dup_lines=let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long"),
        n_repeat_words=repeated_words(F.col("_words")).cast("long"),
        n_lines=_count(t, "\n") + 1,
        n_capitals=_count(t, "ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
        n_digits=_count(t, "0123456789"),
        n_bangs=_count(t, "!"),
        n_bars=_count(t, "|"),
        n_distinct_words=F.size(F.array_distinct("_words")).cast("long"),
    )
    return out.drop("_words")


def base_failed() -> Column:
    return (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))


def holds(condition: tuple[str, str, float]) -> Column:
    name, side, cut = condition
    value = F.expr(FEATURES[name])
    return value > cut if side == ">" else value <= cut


def rule_number(rules: list[Rule]) -> Column:
    """The ordered conditional: the number of the first rule that takes the row, or null."""
    out = F.when(F.lit(False), F.lit(0))
    for n, rule in enumerate(rules):
        taken = F.lit(True)
        for condition in rule:
            taken = taken & holds(condition)
        out = out.when(taken, F.lit(n))
    return out


def _gain(bad: float, good: float, bad0: float, good0: float) -> float:
    return bad * (math.log2(bad / (bad + good)) - math.log2(bad0 / (bad0 + good0))) if bad else 0.0


def _bin(value: Column, cuts: list[float]) -> Column:
    """How many cut points lie below the value."""
    points = F.array(*[F.lit(float(c)) for c in cuts]).cast("array<double>")
    return F.size(F.filter(points, lambda c: c < value))


def learn_rules(stats: DataFrame) -> list[Rule]:
    """A decision list from rows with the statistics, ``doc_id`` and ``bad`` (boolean). One class only: no rules."""
    names = list(FEATURES)
    rows = stats.where("bad IS NOT NULL")
    points = rows.groupBy("bad").agg(*[
        F.percentile_approx(F.expr(FEATURES[n]), [i / CUTS for i in range(CUTS + 1)], 1000).alias(n) for n in names
    ]).collect()
    cuts = {}
    for n in names:  # the quantiles of either class and the middles between them
        at = sorted({float(v) for r in points for v in r[n] or []})
        cuts[n] = sorted({*at, *((a + b) / 2 for a, b in zip(at, at[1:]))})
    binned = saved(rows.select(
        "bad", (F.pmod(F.xxhash64(F.col("doc_id"), F.lit("fold")), F.lit(3)) == 0).alias("held"),
        *[_bin(F.expr(FEATURES[n]), cuts[n]).alias(n) for n in names],
    ))

    def inside(rule) -> Column:
        cond = F.lit(True)
        for n, side, j in rule:
            cond = cond & ((F.col(n) > j) if side == ">" else (F.col(n) <= j))
        return cond

    bads, goods = F.count_if("bad"), F.count_if(~F.col("bad"))
    rules: list = []
    while len(rules) < MAX_RULES:
        left = F.lit(True)
        for r in rules:
            left = left & ~inside(r)
        grow, rule = binned.where(left & ~F.col("held")), []
        while len(rule) < MAX_CONDITIONS:
            table = grow.where(inside(rule)).select("bad", F.inline(F.array(*[
                F.struct(F.lit(n).alias("name"), F.col(n).alias("bin")) for n in names
            ]))).groupBy("name", "bin").agg(bads.alias("b"), goods.alias("g")).collect()  # features x bins
            by: dict = {}
            for x in table:
                by.setdefault(x["name"], {})[x["bin"]] = (x["b"], x["g"])
            if not by:
                break
            total = [sum(v[k] for v in by[names[0]].values()) for k in (0, 1)]
            if not rule and total[0] < MIN_BAD or total[1] == 0:
                break
            best, alike = (0.0, None), []
            for n in names:
                low = [0, 0]
                for j in range(len(cuts[n])):
                    b, g = by[n].get(j, (0, 0))
                    low = [low[0] + b, low[1] + g]
                    for side, (p, q) in (("<=", low), (">", (total[0] - low[0], total[1] - low[1]))):
                        gain = _gain(p, q, *total)
                        if gain > best[0] + 1e-9:
                            best, alike = (gain, (n, side)), [j]
                        elif best[1] == (n, side) and abs(gain - best[0]) <= 1e-9 and gain > 0:
                            alike.append(j)
            if best[1] is None:
                break
            # Of cuts that part the rows alike, the one nearest the middle.
            n, side = best[1]
            middle = (cuts[n][alike[0]] + cuts[n][alike[-1]]) / 2
            rule.append((n, side, min(alike, key=lambda j: abs(cuts[n][j] - middle))))
        if not rule:
            break
        seen = binned.where(left & F.col("held")).agg(*[
            f(F.when(inside(rule[:k]), F.col("bad"))).alias(f"{name}{k}")
            for k in range(1, len(rule) + 1) for name, f in (("b", F.count_if), ("g", lambda c: F.count_if(~c)))
        ]).first()
        scored = [((b - g) / (b + g), -k) for k in range(1, len(rule) + 1) if (b := seen[f"b{k}"]) + (g := seen[f"g{k}"])]
        if not scored:
            break
        k = -max(scored)[1]
        if seen[f"b{k}"] < MIN_BAD or seen[f"b{k}"] < MIN_PRECISION * (seen[f"b{k}"] + seen[f"g{k}"]):
            break
        rules.append(rule[:k])
    return [[(n, side, float(cuts[n][j])) for n, side, j in r] for r in rules]


def learn_from_labels(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """Learn on labelled documents (quality 0 is bad; other or null qualities than 0 and 1 are left out)."""
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    n = known.count()
    if not n:
        return []
    share = int(1_000_000 * min(1.0, sample_rows / n))
    chosen = known.where(F.pmod(F.xxhash64(F.col("doc_id"), F.lit("sample")), F.lit(1_000_000)) < share)
    # About sample_rows pairs of a number and a flag: a bounded broadcast.
    rows = records(docs).drop("rec").join(F.broadcast(chosen.select(F.col("doc_id").cast("long").alias("doc_id"), "quality")), "doc_id")
    stats = text_stats(rows).withColumn("bad", F.col("quality") == 0).drop("text")
    return learn_rules(saved(stats.where(~base_failed())))


def judge(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """(rec, doc_id, statistics, base_failed, rule, kept) for every input row.

    Null and empty texts have no words and fail the base. Repeated rows are judged alike; no rules keep all that pass it.
    """
    stats = text_stats(records(docs)).drop("text", "text_key")
    return stats.withColumns({"base_failed": base_failed(), "rule": rule_number(rules)}).withColumn(
        "kept", ~F.col("base_failed") & F.col("rule").isNull()
    )


def op2_quality_rules(spark, sf_dir) -> DataFrame:
    """One row per document; a null or empty text has no words and fails the base. Repeated rows each come out."""
    docs = documents(spark, sf_dir)
    rules = learn_from_labels(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return judge(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule"
    )
