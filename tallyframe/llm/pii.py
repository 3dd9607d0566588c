"""PII by candidate gradient boosting: high-recall patterns propose overlapping spans, boosted trees score their
format and context, and thresholds calibrated on rows kept from the fit select what is redacted."""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyframe.llm.common import settle, table

#: Base kinds in the order in which they are listed. Possessive repeats and the look-behinds change no match: they
#: keep Java's matcher from walking a long run again from each of its characters, and from deep recursion.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: Wider patterns that propose what the base kinds miss.
WIDER = {
    "handle": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?(?:@|\(at\)|\[at\])\x20?[A-Za-z0-9-]++(?:\x20?(?:\.|\(dot\)|\[dot\])\x20?[A-Za-z0-9-]++)*+",
    "number": r"(?<![A-Za-z0-9])[0-9(][\x20().0-9-]{6,}[0-9](?![A-Za-z0-9])",
}
KINDS = (*BASE, *WIDER)
OTHER = "other"
TREES, DEPTH, PRECISION = 10, 3, 0.95
CUES = {"cue_contact": "phone|tel|call|mobile|fax|contact", "cue_mail": "mail|write|e-mail", "cue_card": "card|visa|account|iban", "cue_net": "ip|host|server|address"}
FEATURES = ("kind_at", "size", "digits", "letters", "groups", "longest", "dots", "brackets", "ats", "after_plus", "starts_word", "ends_word", "luhn", *CUES)

_SPAN = "struct<kind:string,start:bigint,end:bigint,body:string,before:string,after:string>"


def _spans(kind: str, pattern: str) -> Column:
    """All matches of a text with their places, from the matches and the pieces between them."""
    hit = {"email": F.contains("text", F.lit("@")), "phone": F.contains("text", F.lit("+")), "handle": F.col("text").rlike(r"@|\(at\)|\[at\]")}.get(kind, F.col("text").rlike("[0-9]"))
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    pieces = F.split("text", pattern, -1)
    place = F.arrays_zip(pieces.alias("gap"), found.alias("body"), F.slice(pieces, 2, 1 << 30).alias("next"))

    def step(done: Column, x: Column) -> Column:
        start = done["at"] + F.length(x["gap"])
        end = start + F.coalesce(F.length(x["body"]), F.lit(0))
        span = F.struct(F.lit(kind).alias("kind"), start.alias("start"), end.alias("end"), x["body"].alias("body"), F.right(x["gap"], F.lit(24)).alias("before"), F.left(x["next"], F.lit(8)).alias("after"))
        return F.struct(end.alias("at"), F.when(x["body"].isNull(), done["out"]).otherwise(F.concat(done["out"], F.array(span.cast(_SPAN)))).alias("out"))

    none = F.lit(None).cast(f"array<{_SPAN}>")
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(f"array<{_SPAN}>").alias("out"))
    return F.when(hit, F.aggregate(F.when(F.size(found) > 0, place), start, step, lambda done: done["out"])).otherwise(none)


def _valid(span: Column) -> Column:
    """Whether a match of a base kind passes its check."""
    body, digits = span["body"], F.regexp_replace(span["body"], "[^0-9]", "")
    parts = F.transform(F.split(body, r"\."), lambda part: F.regexp_replace(part, "^0+", ""))
    octets = F.forall(parts, lambda part: (F.length(part) <= 3) & (F.when(part == "", 0).otherwise(F.left(part, F.lit(3)).cast("int")) <= 255))
    size = F.length(digits)
    return (
        F.when(span["kind"] == "email", True).when(span["kind"] == "ip", octets)
        .when(span["kind"] == "card", size.between(16, 19) & F.call_function("luhn_check", F.left(digits, F.lit(19)))).when(span["kind"] == "phone", size.between(8, 15)).otherwise(False)
    )


def candidates(docs: DataFrame) -> DataFrame:
    """row, doc_id and one candidate span each (kind, start, end, body, before, after, base, label); a text without
    one keeps a row of nulls. base: a base kind that passes its check; label: overlaps such a span."""
    text = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = text.select("row", "doc_id", F.concat(*(F.coalesce(_spans(kind, pattern), F.array().cast(f"array<{_SPAN}>")) for kind, pattern in (BASE | WIDER).items())).alias("spans"))
    found = found.select("row", "doc_id", F.transform("spans", lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"), s["body"].alias("body"), s["before"].alias("before"), s["after"].alias("after"), _valid(s).alias("base"))).alias("spans"))
    found = found.select("row", "doc_id", F.filter("spans", lambda s: s["base"]).alias("firm"), "spans")
    found = found.select("row", "doc_id", F.explode_outer(F.transform("spans", lambda s: F.struct(s.alias("s"), F.exists("firm", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])).alias("label")))).alias("c"))
    return found.select("row", "doc_id", "c.s.*", "c.label")


def _features(spans: DataFrame) -> DataFrame:
    count = lambda pattern: F.regexp_count("body", F.lit(pattern))
    values = {
        "kind_at": F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind")), "size": F.length("body"), "digits": count("[0-9]"), "letters": count("[A-Za-z]"),
        "groups": count("[0-9]+"), "longest": F.array_max(F.transform(F.split("body", "[^0-9]+"), F.length)), "dots": count(r"\."), "brackets": count("[()]"), "ats": count("@"),
        "after_plus": F.col("before").rlike(r"\+$").cast("int"), "starts_word": F.col("before").rlike(r"(^|\s)$").cast("int"), "ends_word": F.col("after").rlike(r"^([\s.,;]|$)").cast("int"),
        "luhn": F.call_function("luhn_check", F.left(F.regexp_replace("body", "[^0-9]", ""), F.lit(19))).cast("int"),
    } | {name: F.lower("before").rlike(cue).cast("int") for name, cue in CUES.items()}
    return spans.select("*", *(F.coalesce(value, F.lit(0)).cast("double").alias(name) for name, value in values.items()))


def labelled_vectors(spans: DataFrame) -> DataFrame:
    """kind, apart, label, features and weight: every candidate, equal ones as one row with their number. A fifth is set
    apart by a hash of id and place."""
    key = F.xxhash64("doc_id", "start", "end", "kind")
    known = _features(spans.where("kind IS NOT NULL").withColumn("apart", F.pmod(key, F.lit(5)) == 0))
    return known.groupBy("kind", "apart", F.col("label").cast("double").alias("label"), *FEATURES).agg(F.count(F.lit(1)).cast("double").alias("weight"))


def score_candidates(spans: DataFrame) -> DataFrame:
    """spans with `chosen`: base spans, and candidates whose score reaches the threshold of their kind.

    Trees are fitted on all labelled candidates but a fifth; that fifth sets the lowest threshold of each kind at which
    95 % of what it selects is labelled. Equal candidates weigh by their number, so a frequent one is one row. Without both
    labels nothing is added to the base spans."""
    vectors = settle(labelled_vectors(spans))
    fitted = vectors.where(~F.col("apart"))
    if fitted.select("label").distinct().count() < 2:
        return spans.withColumn("chosen", F.col("base"))
    vector = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, maxBins=32, seed=17, weightCol="weight").fit(vector.transform(fitted).select("features", "label", "weight"))
    score = vector_to_array("probability")[1].alias("p")
    held = model.transform(vector.transform(vectors.where("apart"))).select("kind", "label", "weight", score)
    held = held.groupBy("kind", "p").agg(F.sum("weight").alias("weight"), F.sum(F.col("weight") * F.col("label")).alias("right"))
    so_far = Window.partitionBy("kind").orderBy(F.desc("p")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    good = held.withColumn("precision", F.sum("right").over(so_far) / F.sum("weight").over(so_far)).where(F.col("precision") >= PRECISION)
    limits = {row.kind: row.p for row in good.groupBy("kind").agg(F.min("p").alias("p")).collect()}
    limit = F.coalesce(*(F.when(F.col("kind") == kind, p) for kind, p in limits.items()), F.lit(2.0))
    scored = model.transform(vector.transform(_features(spans))).select(*spans.columns, score)
    return scored.withColumn("chosen", F.col("base") | (F.col("p") >= limit)).drop("p")


def find_pii(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text, ...) -> doc_id, base and spans (arrays of kind, start, end; code points, end exclusive), one
    row for each row read. base holds the base kinds in listed order, then by start; spans adds those of kind
    `other` that the trees select and that overlap no base span. Null and empty texts have none, repeated rows
    stay apart, other columns are ignored, and an empty table gives an empty result."""
    spans = score_candidates(candidates(docs))
    order = F.array_position(F.array(*map(F.lit, BASE)), F.col("kind"))
    firm = F.when(F.col("base"), F.struct(order.alias("order"), "start", "end", "kind"))
    loose = F.when(F.col("chosen") & ~F.col("base"), F.struct(F.lit(len(KINDS)).cast("long").alias("order"), "start", "end", F.lit(OTHER).alias("kind")))
    found = spans.groupBy("row", "doc_id").agg(F.array_sort(F.collect_list(firm)).alias("base"), F.array_sort(F.collect_set(loose)).alias("loose"))
    apart = F.filter("loose", lambda s: ~F.exists("base", lambda b: (b["start"] < s["end"]) & (s["start"] < b["end"])))
    plain = lambda spans_: F.transform(spans_, lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
    return found.select("doc_id", plain(F.col("base")).alias("base"), plain(F.concat("base", apart)).alias("spans"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(table(spark, sf_dir, "documents"))
    said = lambda name: F.array_join(F.transform(name, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, BASE), F.sha2(said("base"), 256).alias("base_sha256"), said("spans").alias("spans"))


QUERIES = {"op3_pii": op3_pii}
ORACLES: dict[str, str] = {}
