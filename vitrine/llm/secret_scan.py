"""Secret scan: candidates by pattern, false positives removed by a random forest.

Native: DataFrame functions and `pyspark.ml` only. One pass finds candidates (unbroken runs of key-like characters) with
their surroundings; a forest scores them by length, character transitions, dictionary coverage, the path they stand in
and neighbouring words. It is trained on labelled findings: the caller's, or as default the findings of the corpus
whose format or assignment decides the matter (`rule_label`). Training takes at most `train_rows` findings per label, in
hash order; everything else covers all rows.

Defined results: null and empty texts have no candidates; a candidate found several times in one text is one finding
with its first position and its number of occurrences; repeated rows give repeated findings; null ids stay. Where the
labelled findings hold a single label there is nothing to learn, and every finding gets that label. Other columns are
ignored. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from vitrine.session import measured, scratch_path, stored

#: Runs of key characters; a candidate also holds a digit, or both cases.
RUN = r"[A-Za-z0-9+/_=.\-]{16,}"
#: Published shapes of issued keys.
ISSUED = (r"^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^xox[abprs]-[A-Za-z0-9-]{10,}$|^AIza[A-Za-z0-9_-]{35}$"
          r"|^sk_(live|test)_[A-Za-z0-9]{16,}$|^eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+$")
#: Words before an assignment that name a secret, and words that name something public.
SECRET_WORDS = r"(?i)(password|passwd|pwd|secret|token|credential|api[_-]?key|auth|private[_-]?key|access[_-]?key)"
PUBLIC_WORDS = r"(?i)(example|sample|sha1|sha256|md5|checksum|commit|uuid|digest|order|phone|card|http|www|mail)"
ASSIGNED = r"(?<!http)(?<!https)[=:]\s*[\"']?$"
#: Lookups up to this many rows are broadcast.
BROADCAST_ROWS = 500_000
FEATURES = ("length", "digits", "upper", "lower", "other", "transitions", "hex_only", "digits_only", "distinct_share", "coverage",
            "slashes", "dots", "after_path", "before_path", "assigned", "quoted", "secret_word", "public_word", "issued_prefix")


def candidates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, position, candidate, occurrences, before, after): one row per document row and distinct candidate."""
    runs = F.filter(F.array_distinct(F.regexp_extract_all(F.coalesce(F.col(text), F.lit("")), F.lit(RUN), F.lit(0))),
                    lambda r: r.rlike("[0-9]") | (r.rlike("[a-z]") & r.rlike("[A-Z]")))
    each = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), runs.alias("runs")).filter(F.size("runs") > 0)
    each = each.select("doc_id", "text", F.explode("runs").alias("run"))
    at = each.withColumn("position", F.instr("text", F.col("run")))
    start = F.greatest(F.col("position") - 40, F.lit(1))
    near = at.select("doc_id", "position", "run",
                     ((F.length("text") - F.length(F.replace("text", F.col("run"), F.lit("")))) / F.length("run")).cast("int").alias("occurrences"),
                     F.substring("text", start, F.col("position") - start).alias("before"),
                     F.substring("text", F.col("position") + F.length("run"), F.lit(24)).alias("after"))
    # `name=value` inside one run: the name belongs to the surroundings.
    name = F.regexp_extract("run", r"^([A-Za-z_.\-]*=)[^=]{8,}", 1)
    return near.select("doc_id", (F.col("position") + F.length(name)).alias("position"), "occurrences",
                       F.expr("substr(run, length(regexp_extract(run, '^([A-Za-z_.\\\\-]*=)[^=]{8,}', 1)) + 1)").alias("candidate"),
                       F.concat("before", name).alias("before"), "after")


def coverage(found: DataFrame, docs: DataFrame, text: str = "text") -> DataFrame:
    """(candidate, coverage): the share of a candidate's characters in runs of four letters and more that the corpus has
    as words of their own at least twice. All words of all documents count."""
    parts = found.select("candidate").distinct().select(
        "candidate", F.explode_outer(F.regexp_extract_all(F.lower("candidate"), F.lit("[a-z]{4,}"), F.lit(0))).alias("part"))
    parts, seen = measured(parts, "parts", F.count("*").alias("n"))
    wanted = parts.select(F.col("part").alias("word")).dropna().distinct()
    wanted = F.broadcast(wanted) if seen["n"] <= BROADCAST_ROWS else wanted
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(text), F.lit(r"(?<![^\s,.;:!?])[a-z]{4,}(?![^\s,.;:!?])"), F.lit(0))).alias("word"))
    known = words.join(wanted, "word", "left_semi").groupBy("word").count().filter("count > 1").select(F.col("word").alias("part"), F.lit(True).alias("known"))
    return parts.join(known, "part", "left").groupBy("candidate").agg(
        (F.sum(F.when(F.col("known"), F.length("part")).otherwise(0)) / F.length("candidate")).alias("coverage"))


def _count(pattern: str) -> Column:
    return F.regexp_count("candidate", F.lit(pattern)).cast("double")


def featured(found: DataFrame, covered: DataFrame) -> DataFrame:
    length = F.length("candidate").cast("double")
    flag = lambda c: F.coalesce(c, F.lit(False)).cast("double")
    last = F.col("before")
    return found.join(covered, "candidate").withColumns({
        "length": length, "digits": _count("[0-9]") / length, "upper": _count("[A-Z]") / length,
        "lower": _count("[a-z]") / length, "other": _count("[^A-Za-z0-9]") / length,
        "transitions": _count("[a-z](?=[^a-z])|[A-Z](?=[^A-Z])|[0-9](?=[^0-9])") / length,
        "hex_only": flag(F.col("candidate").rlike("^[0-9a-f]+$|^[0-9A-F]+$")), "digits_only": flag(F.col("candidate").rlike("^[0-9.\\-]+$")),
        "distinct_share": F.size(F.array_distinct(F.split("candidate", ""))) / length,
        "slashes": _count("/"), "dots": _count("[.]"),
        "after_path": flag(last.rlike(r"[/\\@]$|https?:$|://\S*$|@\S*$")), "before_path": flag(F.col("after").rlike(r"^[/\\@]")),
        "assigned": flag(last.rlike(ASSIGNED)), "quoted": flag(last.rlike("[\"']$")),
        "secret_word": flag(last.rlike(SECRET_WORDS)), "public_word": flag(F.concat(last, F.lit(" "), F.col("after")).rlike(PUBLIC_WORDS)),
        "issued_prefix": flag(F.col("candidate").rlike(r"^(AKIA|ASIA|gh[pousr]_|xox[abprs]-|AIza|sk_|eyJ)"))})


def rule_label() -> Column:
    """1 where the format or an assignment to a secret's name decides for a secret, 0 where numbers, hosts and paths
    decide against it, null where it is open."""
    secret = F.col("candidate").rlike(ISSUED) | (F.col("before").rlike(SECRET_WORDS + r"\s*[=:]\s*[\"']?$") & F.col("candidate").rlike("[0-9]"))
    public = (F.col("candidate").rlike(r"^[0-9.\-]+$|[.](com|org|net|edu|io|html?|png|jpg|py|js)$") | F.col("candidate").rlike("^//") | F.col("before").rlike(r"@$|://\S*$"))
    return F.when(secret, 1.0).when(public, 0.0)


def scan(docs: DataFrame, labelled: DataFrame | None = None, doc_id: str = "doc_id", text: str = "text",
         train_rows: int = 5000, trees: int = 20, depth: int = 6) -> DataFrame:
    """One row per finding: doc_id, position, candidate, occurrences, probability, is_secret.

    `labelled` holds findings (candidate, before, after, label 0/1)."""
    found = stored(candidates(docs, doc_id, text), "found")
    scored = stored(featured(found, coverage(found, docs, text)), "features")
    if labelled is None:
        truth = scored.withColumn("label", rule_label()).dropna(subset=["label"])
    else:
        own = labelled.select("candidate", "before", "after", F.col("label").cast("double").alias("label"))
        truth = featured(own, coverage(own, docs, text))
    picked = None
    for label in (0.0, 1.0):
        part = truth.filter(F.col("label") == label).orderBy(F.xxhash64("candidate", "before")).limit(train_rows)
        picked = part if picked is None else picked.unionByName(part)
    assemble = VectorAssembler(inputCols=list(FEATURES), outputCol="features", handleInvalid="keep")
    picked, seen = measured(picked.select("label", *FEATURES), "training", F.collect_set("label").alias("labels"))
    labels = seen["labels"] or [0.0]
    columns = ("doc_id", "position", "candidate", "occurrences")
    if len(labels) == 1:
        return scored.select(*columns, F.lit(float(labels[0])).alias("probability"), F.lit(labels[0] == 1).alias("is_secret"))
    fitted = RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=42).fit(assemble.transform(picked))
    # Stored and loaded, the model comes without its training summary, which holds the session and cannot go to tasks.
    place = scratch_path(docs.sparkSession, "forest")
    fitted.save(place)
    forest = RandomForestClassificationModel.load(place)
    out = forest.transform(assemble.transform(scored)).withColumn("probability", F.get(vector_to_array("probability"), F.lit(1)))
    return out.select(*columns, "probability", (F.col("probability") >= 0.5).alias("is_secret"))


def redact(docs: DataFrame, findings: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents with every secret found replaced by `[secret]`."""
    secrets = findings.filter("is_secret").groupBy(F.col("doc_id").alias("_f_id")).agg(F.collect_set("candidate").alias("_secrets"))
    cleaned = F.aggregate(F.coalesce("_secrets", F.array().cast("array<string>")), F.col(text),
                          lambda acc, s: F.replace(acc, s, F.lit("[secret]")))
    joined = docs.join(secrets, F.col(doc_id).eqNullSafe(F.col("_f_id")), "left")
    return joined.select(*((cleaned if c == text else F.col(f"`{c}`")).alias(c) for c in docs.columns))
