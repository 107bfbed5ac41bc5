"""Personal data by candidate gradient boosting.

Generators with high recall propose overlapping spans: every match of the four fixed grammars, valid or not,
and loose ones (disguised addresses, addresses with the text around them, national phone numbers). Boosted
trees score each candidate from its form and its surroundings. They learn from candidates that the fixed
grammars can judge (valid: personal; failing, or loose and swallowing text around a valid address: not) and from
disguised forms of the valid addresses (personal), from all of them but a quarter; the threshold is the lowest score that keeps the wanted precision on that quarter, kept aside. Valid matches of the fixed grammars always stay;
the model adds candidates that the grammars can't judge and that overlap none of these.

Only built-in expressions run over texts. Positions come from splitting a text at the matches: the lengths of
pieces and matches add up. The patterns are possessive or anchored at the start of a run, so their work is
linear in the text, and they do not recurse.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.functions.columns import add_once
from riskloom.llm.common import documents, let, records, saved

#: The kinds in their order, and patterns that find what the plain grammars find.
KINDS = ["email", "ip", "card", "phone"]
PATTERNS = {
    "email": r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    # A card is a whole chain of digits with single separators; only chains of 13 to 19 digits can be valid.
    "card": r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){12,18}+(?![\x20-]?[0-9])",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:@|[(\[]\x20?at\x20?[)\]])\x20?[A-Za-z0-9-]++"
             r"(?:\x20?(?:\.|[(\[]\x20?dot\x20?[)\]])\x20?[A-Za-z0-9-]++)++",
    "phone": r"(?<![0-9A-Za-z+.-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])",
}
#: Written instead of @ and of each dot of the domain.
DISGUISES = [(" @ ", "."), (" @ ", " . "), (" (at) ", "."), (" (at) ", " (dot) "), (" [at] ", " [dot] "), ("(at)", "(dot)"), ("[at]", ".")]
CONTEXT = 24
CUES = r"(?i)(mail|phone|call|tel|fax|card|visa|contact|address|server|host|login|user|pay)"
ROUNDS, DEPTH = 10, 3
PRECISION = 0.98
SPAN = "array<struct<start:int,stop:int,match:string>>"
CANDIDATE = "array<struct<kind:string,loose:boolean,start:int,stop:int,match:string,before:string,after:string,judged:boolean,valid:boolean>>"


def spans(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as (start, stop, match), in code points."""

    def located(m):
        def placed(p):
            pairs = F.zip_with(F.slice(p, 1, F.size(m)), m, lambda a, b: F.struct(F.char_length(a).alias("gap"), b.alias("b")))
            start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

            def step(acc, x):
                a = acc["at"] + x["gap"]
                b = a + F.char_length(x["b"])
                one = F.struct(a.alias("start"), b.alias("stop"), x["b"].alias("match"))
                return F.struct(b.alias("at"), F.concat(acc["out"], F.array(one)).alias("out"))

            return F.aggregate(pairs, start, step, lambda acc: acc["out"])

        return F.when(F.size(m) == 0, F.array().cast(SPAN)).otherwise(let(F.split(text, pattern, -1), placed))

    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), located)


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """Whether the check sum of a string of digits is right."""
    values = F.transform(F.filter(F.split(F.reverse(digits), ""), lambda x: x != ""), lambda x, i: let(
        x.cast("int") * (1 + i % 2), lambda d: d - F.when(d > 9, 9).otherwise(0)
    ))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def valid(kind: str, match: Column) -> Column:
    if kind == "ip":
        return F.forall(F.split(match, r"\."), lambda x: x.try_cast("double") <= 255)
    if kind == "card":
        return luhn(_digits(match))
    if kind == "phone":
        return F.char_length(_digits(match)).between(9, 15)
    return F.lit(True)


def _possible(kind: str, text: Column) -> Column:
    """A cheap test that a pattern can match at all."""
    if kind == "email":
        return F.contains(text, F.lit("@")) | F.contains(text, F.lit("at")) & text.rlike(r"[(\[]\x20?at\x20?[)\]]")
    return text.rlike({"ip": r"[0-9]\.[0-9]", "card": "[0-9][\\x20-]?[0-9]", "phone": "[0-9]{3}|\\+[0-9]"}[kind])


def find(docs: DataFrame) -> DataFrame:
    """(rec, doc_id, text_key, candidates): all proposals of all generators; those of the fixed grammars are judged."""
    text = F.col("text")

    def proposals(kind: str, loose: bool) -> Column:
        def described(x):
            return F.struct(
                F.lit(kind).alias("kind"), F.lit(loose).alias("loose"), x["start"].alias("start"), x["stop"].alias("stop"), x["match"].alias("match"),
                F.substring(text, F.greatest(x["start"] - CONTEXT, F.lit(0)) + 1, F.least(x["start"], F.lit(CONTEXT))).alias("before"),
                F.substring(text, x["stop"] + 1, F.lit(CONTEXT)).alias("after"),
                F.lit(not loose).alias("judged"), (F.lit(False) if loose else F.coalesce(valid(kind, x["match"]), F.lit(False))).alias("valid"),
            )

        found = F.transform(spans(text, (LOOSE if loose else PATTERNS)[kind]), described)
        return F.when(_possible(kind, text), found).otherwise(F.array()).cast(CANDIDATE)

    every = F.concat(*[proposals(k, False) for k in KINDS], *[proposals(k, True) for k in LOOSE])
    return add_once(records(docs), candidates=every).drop("text")


def disguised(x: Column) -> Column:
    """An address in one of the DISGUISES, chosen by its hash."""
    form = F.get(F.array(*[F.struct(F.lit(a).alias("at"), F.lit(d).alias("dot")) for a, d in DISGUISES]), F.pmod(F.xxhash64(x), F.lit(len(DISGUISES))).cast("int"))
    return F.concat(F.substring_index(x, "@", 1), form["at"], F.replace(F.substring_index(x, "@", -1), F.lit("."), form["dot"]))


def _described(found: DataFrame) -> DataFrame:
    """One row per candidate with its features. A loose one equal to a valid span is that span, and is left out.

    A loose address that overlaps a valid one swallows text around it and is judged as none; without one it stays
    unjudged. Each valid address comes once more in disguise, to learn from.
    """
    base = F.filter("candidates", lambda x: x["valid"])
    address = F.filter("candidates", lambda x: x["valid"] & (x["kind"] == "email"))
    fresh = F.filter("candidates", lambda c: ~c["loose"] | ~F.exists(base, lambda b: (b["start"] == c["start"]) & (b["stop"] == c["stop"])))
    ruled = F.transform(fresh, lambda c: c.withField("judged", c["judged"] | (c["kind"] == "email") & F.exists(
        address, lambda b: (b["start"] < c["stop"]) & (c["start"] < b["stop"])
    )))
    taught = F.transform(address, lambda c: c.withField("loose", F.lit(True)).withField("match", disguised(c["match"])))
    rows = found.where(F.size("candidates") > 0).select("doc_id", "text_key", F.inline(F.concat(ruled.cast(CANDIDATE), taught.cast(CANDIDATE))))
    m, number = F.col("match"), lambda c: c.cast("double")
    n_digits = F.char_length(_digits(m))
    features = {
        "f_email": F.col("kind") == "email", "f_ip": F.col("kind") == "ip", "f_card": F.col("kind") == "card",
        "f_length": F.char_length(m), "f_digits": n_digits, "f_space": m.contains(" "),
        "f_sentence": m.rlike(r"[^\x20]\.\x20"), "f_disguise": m.rlike(r"\x20?@\x20|\x20@|[(\[]\x20?at\x20?[)\]]"),
        "f_dots": F.size(F.split(m, r"\.")), "f_hyphens": F.size(F.split(m, "-")),
        "f_luhn": F.when(n_digits.between(12, 19), luhn(_digits(m))).otherwise(False),
        "f_octets": F.coalesce(F.forall(F.split(m, r"[^0-9]+"), lambda x: (x == "") | (x.try_cast("double") <= 255)), F.lit(False)),
        "f_first_digit": F.coalesce(F.substring(_digits(m), 1, 1).try_cast("double"), F.lit(-1.0)),
        "f_before_open": F.col("before").rlike(r"(^|[\s(\[<\"',;:])$"), "f_before_word": F.col("before").rlike(r"[A-Za-z0-9]$"),
        "f_after_open": F.col("after").rlike(r"^($|[\s)\]>\"',;:.!?])"), "f_cue": F.col("before").rlike(CUES),
        "f_in_digits": F.col("before").rlike(r"[0-9][.\-]?$") | F.col("after").rlike(r"^[.\-]?[0-9]"),
    }
    return rows.select("doc_id", "text_key", "kind", "start", "stop", "judged", "valid",
                       *[F.coalesce(number(v), F.lit(0.0)).alias(k) for k, v in features.items()])


def train(candidates: DataFrame):
    """(model, columns, threshold) of all judged candidates, or None when they do not show both classes."""
    rows = candidates.where("judged")
    if rows.select("valid").distinct().count() < 2:
        return None
    place = F.pmod(F.xxhash64("doc_id", "text_key", "start", "stop", "kind"), F.lit(1_000_000))
    columns = [c for c in candidates.columns if c.startswith("f_")]
    rows = saved(VectorAssembler(inputCols=columns, outputCol="features").transform(rows).select(
        "features", F.col("valid").cast("double").alias("label"), (place % 4 == 0).alias("held")
    ))
    grow = rows.where("NOT held")
    if grow.select("label").distinct().count() < 2:
        return None
    model = GBTClassifier(maxIter=ROUNDS, maxDepth=DEPTH, seed=7, cacheNodeIds=False).fit(grow)
    score = F.floor(vector_to_array("probability")[1] * 20)
    table = model.transform(rows.where("held")).groupBy(score.alias("score")).agg(
        F.sum("label").alias("good"), F.count("*").alias("n")
    ).collect()  # at most 21 rows
    good = n = 0
    threshold = None
    for r in sorted(table, key=lambda r: -r["score"]):
        good, n = good + r["good"], n + r["n"]
        if good < PRECISION * n:
            break
        threshold = r["score"] / 20
    return None if threshold is None else (model, columns, max(threshold, 0.5))


def accepted(candidates: DataFrame, trained) -> DataFrame:
    """(doc_id, text_key, kind, start, stop, score) of candidates the grammars can't judge and the trees take."""
    open_ = candidates.where("NOT judged")
    if trained is None:
        return open_.where("false").select("doc_id", "text_key", "kind", "start", "stop", F.lit(0.0).alias("score"))
    model, columns, threshold = trained
    scored = model.transform(VectorAssembler(inputCols=columns, outputCol="features").transform(open_))
    score = vector_to_array("probability")[1]
    return scored.where(score >= threshold).select("doc_id", "text_key", "kind", "start", "stop", score.alias("score"))


PLAIN = "array<struct<kind:string,start:int,stop:int>>"


def _plain(a: Column) -> Column:
    return F.transform(a, lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["stop"].alias("stop")))


def detect(docs: DataFrame) -> DataFrame:
    """(rec, doc_id, base, spans) for every input row: arrays of (kind, start, stop) in code points, end exclusive.

    ``base``: the valid matches of the fixed grammars, by kind and start; kinds may overlap. ``spans``: these and
    what the trees add, by kind and start. Null and empty texts have none; repeated rows each get theirs.
    """
    found = find(docs)
    some = saved(found.where(F.size("candidates") > 0).drop("rec"))
    candidates = _described(some.dropDuplicates(["doc_id", "text_key"]))
    extra = accepted(candidates, train(candidates)).groupBy("doc_id", "text_key").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("score")).alias("s"), "kind", "start", "stop"))).alias("extra")
    )
    base = some.dropDuplicates(["doc_id", "text_key"]).select(
        "doc_id", "text_key", _plain(F.filter("candidates", lambda x: x["valid"])).alias("base")
    )
    known = base.join(extra, base["doc_id"].eqNullSafe(extra["doc_id"]) & (base["text_key"] == extra["text_key"]), "left").select(
        base["doc_id"], base["text_key"], "base", "extra"
    )

    def added(acc, x):  # best first; each must be clear of all before it
        clash = F.exists(acc, lambda y: (y["start"] < x["stop"]) & (x["start"] < y["stop"]))
        one = F.array(F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["stop"].alias("stop")))
        return F.when(clash, acc).otherwise(F.concat(acc, one))

    rank = F.create_map(*[F.lit(v) for n, k in enumerate(KINDS) for v in (k, n)])
    merged = F.when(F.col("extra").isNull(), F.col("base")).otherwise(F.aggregate("extra", F.col("base"), added))
    ordered = _plain(F.sort_array(F.transform(merged, lambda x: F.struct(
        rank[x["kind"]].alias("r"), x["start"].alias("start"), x["stop"].alias("stop"), x["kind"].alias("kind")
    ))))
    known = known.select("doc_id", "text_key", "base", ordered.alias("spans"))
    rows = records(docs).drop("text")
    empty = F.array().cast(PLAIN)
    return rows.join(known, rows["doc_id"].eqNullSafe(known["doc_id"]) & (rows["text_key"] == known["text_key"]), "left").select(
        rows["rec"], rows["doc_id"], F.coalesce("base", empty).alias("base"), F.coalesce("spans", empty).alias("spans")
    )


def redact(text: Column, spans_: Column) -> Column:
    """The text with each span, or each union of overlapping ones, replaced by <KIND> of its first.

    Spans need no order and may repeat. No spans leave the text as it is; a null text stays null.
    """
    order = F.sort_array(F.transform(spans_, lambda x: F.struct(x["start"].alias("start"), x["stop"].alias("stop"), x["kind"].alias("kind"))))
    first = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc, x):
        clear = x["start"] >= acc["at"]
        gap = F.substring(text, acc["at"] + 1, F.greatest(x["start"] - acc["at"], F.lit(0)))
        out = F.when(clear, F.concat(acc["out"], gap, F.lit("<"), F.upper(x["kind"]), F.lit(">"))).otherwise(acc["out"])
        return F.struct(F.greatest(acc["at"], x["stop"]).alias("at"), out.alias("out"))

    end = lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text)))
    return F.when(F.size(spans_) == 0, text).otherwise(F.aggregate(order, first, step, end))


def span_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda x: F.concat_ws(":", x["kind"], x["start"], x["stop"])), ",")


def op9_pii(spark, sf_dir) -> DataFrame:
    """One row per document; null and empty texts have no spans, repeated rows each come out."""
    out = detect(documents(spark, sf_dir))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{k}")
    return out.select(
        "doc_id", *[count(k) for k in KINDS], F.sha2(span_text(F.col("base")), 256).alias("base_sha256"),
        span_text(F.col("spans")).alias("spans"),
    )
