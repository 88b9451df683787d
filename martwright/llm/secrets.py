"""Secret scans: candidates by pattern, false positives removed by a random forest. DataFrame operations only."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from martwright.llm.common import stored
from martwright.llm.spans import matches

# Long unbroken runs of the characters that keys and encoded bytes are written in. An equals sign is padding
# at the end; one in front of a value ends a name, as does one in front of a quote unless a quote stands
# in front of the run too.
_CHARACTER = "[A-Za-z0-9+/_-]"
_PADDING = rf"(?:={{1,2}}+(?!{_CHARACTER}|[=\"'`]))?+"
_QUOTED_PADDING = rf"(?:={{1,2}}+(?!{_CHARACTER}|=))?+"
CANDIDATE = rf"(?<!{_CHARACTER})(?:(?<=[\"'`]){_CHARACTER}{{16,}}+{_QUOTED_PADDING}|{_CHARACTER}{{16,}}+{_PADDING})"
# Labelled findings the forest is fitted on, chosen by hash, and its size.
LABELLED, TREES, DEPTH, SEED = 20_000, 30, 6, 17
# Words of the dictionary: the most frequent ones of the whole corpus.
DICTIONARY = 4096
# Words that announce a credential, key formats, and words of paths that hold examples.
ANNOUNCING = r"(?i)(token|secret|passw(or)?d|pwd|api[_-]?key|access[_-]?key|private[_-]?key|aws[_-]?key|credential|bearer|auth)"
# What follows such a word, "=" or ":" is a candidate of any length: all of it inside quotes, otherwise up to a
# blank, without closing punctuation.
ASSIGNED = (
    ANNOUNCING.replace("(?i)(", "((?i:").replace("passw(or)?d", "passw(?:or)?d")
    + r"""\w*+["'`]?\s*+[=:]\s*+(?:(?i:bearer|basic)\s++)?["'`]?+)((?<=["'`])[^\s"'`]++|[^\s"'`]*[^\s"'`,;)\]}.])"""
)
FORMATS = r"^(AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36,}|xox[abprs]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|eyJ[A-Za-z0-9_-]{16,})"
EXAMPLES = r"(?i)(test|example|sample|fixture|mock|doc)"
FEATURES = (
    "length",
    "transitions",
    "digits",
    "capitals",
    "marks",
    "distinct",
    "hex",
    "dictionary",
    "path_depth",
    "path_example",
    "announced",
    "assigned",
    "quoted",
    "word_before",
    "word_behind",
)


def dictionary(docs: DataFrame, text_column: str = "text", size: int = DICTIONARY) -> list[str]:
    """Letter triples of the corpus's most frequent words, which are counted over all texts."""
    words = F.explode(F.split(F.lower(F.col(text_column)), r"[^\p{L}]++"))
    top = (
        docs.select(words.alias("word"))
        .where(F.length("word") >= 3)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), "word")
        .limit(size)
        .collect()
    )
    return sorted({r["word"][i : i + 3] for r in top for i in range(len(r["word"]) - 2)})


def findings(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", path_column: str | None = "source"
) -> DataFrame:
    """Candidates with their place and surroundings; path is empty without a path column."""
    patterns = {"run": CANDIDATE, "assigned": ASSIGNED}
    text = F.col("text")
    # An assigned value needs a sign, which costs less to look for than the names.
    signs = F.contains(text, F.lit("=")) | F.contains(text, F.lit(":"))
    some = text.rlike(CANDIDATE) | (signs & text.rlike(ANNOUNCING))
    found = matches(docs, patterns, {"assigned": signs}, some, id_column, text_column, ("assigned",))
    # A run at the start of an assigned value is the same candidate; the longer one holds all of it.
    columns = ("end", "match", "before", "after")
    found = found.groupBy("id", "h", "start").agg(F.max_by(F.struct(*columns), "end").alias("found"))
    found = found.select("id", "h", "start", *[f"found.{c}" for c in columns])
    if path_column is None:
        return found.withColumn("path", F.lit(""))
    h = F.xxhash64(F.coalesce(F.col(text_column), F.lit("")))
    paths = docs.select(F.col(id_column).alias("__id"), h.alias("__h"), F.col(path_column).alias("path"))
    # One path for rows that repeat an id and text: the first by name.
    paths = paths.groupBy("__id", "__h").agg(F.min("path").alias("path"))
    same = F.col("id").eqNullSafe(F.col("__id")) & (F.col("h") == F.col("__h"))
    return found.join(paths, same, "left").drop("__id", "__h").fillna("", ["path"])


def features(found: DataFrame, triples: list[str]) -> DataFrame:
    """Adds the columns of FEATURES. All are numbers between 0 and a few dozen."""
    match, n = F.col("match"), F.length("match")
    share = lambda chars: (n - F.length(F.regexp_replace(match, chars, ""))) / n
    # One letter for the class of each character; a transition is a change of class.
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(match, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0")
    classes = F.regexp_replace(classes, r"[^aA0]", "-")
    runs = F.length(F.regexp_replace(classes, r"(.)\1*+", "x"))
    parts = F.transform(F.sequence(F.lit(1), F.greatest(n - 2, F.lit(1))), lambda i: F.lower(F.substring(match, i, F.lit(3))))
    # Literals alone become a hash set; an array or a map would be made, and walked, for each finding.
    inside = F.size(F.filter(parts, lambda x: x.isin(triples))) / F.size(parts)
    flag = lambda c: c.cast("double")
    return found.withColumns(
        {
            "length": flag(n),
            "transitions": (runs - 1) / n,
            "digits": share("[0-9]"),
            "capitals": share("[A-Z]"),
            "marks": share("[^A-Za-z0-9]"),
            "distinct": F.size(F.array_distinct(F.split(match, ""))) / n,
            "hex": flag(match.rlike("^([0-9a-f]+|[0-9A-F]+)$")),
            "dictionary": inside,
            "path_depth": flag(F.size(F.split("path", "/"))),
            "path_example": flag(F.col("path").rlike(EXAMPLES)),
            "announced": flag(F.right("before", F.lit(32)).rlike(ANNOUNCING)),
            "assigned": flag(F.col("before").rlike(r"[=:]\s*+[\"']?$")),
            "quoted": flag(F.col("before").rlike("[\"'`]$") & F.col("after").rlike("^[\"'`]")),
            "word_before": flag(F.col("before").rlike(r"\p{L}\s$")),
            "word_behind": flag(F.col("after").rlike(r"^[.,]?\s\p{L}")),
        }
    )


def label_findings(found: DataFrame) -> DataFrame:
    """Findings whose nature their form gives away, with a label; the others are left out.

    1: a known key format, or a value of 8 or more characters with digits and letters that is assigned to a
    credential's name. 0: a run of letters alone, a number alone, a path of plain words, or a word that
    goes on in prose behind such a name.
    """
    match = F.col("match")
    named = F.col("before").rlike(ANNOUNCING + r"\w*[\"'`]?\s*[=:]\s*((?i:bearer|basic)\s+)?[\"'`]?$")
    varied = match.rlike("[0-9]") & match.rlike("[A-Za-z]") & (F.length("match") >= 8)
    plain = match.rlike("^[A-Za-z]+$") | match.rlike("^[0-9]+$") | match.rlike("^[a-z]+([/_-][a-z]+)+$")
    prose = match.rlike("^[A-Za-z]+$") & (F.col("quoted") == 0) & (F.col("word_behind") == 1)
    label = F.when(match.rlike(FORMATS) | (named & varied), 1.0).when((plain & ~named) | prose, 0.0)
    return found.withColumn("label", label).where("label is not null")


def fit_forest(labelled: DataFrame, bound: int = LABELLED) -> PipelineModel | float:
    """A random forest over FEATURES, from at most `bound` labelled findings chosen by hash.

    Equal findings count once. With findings of one label only, that label is the answer (0 without any).
    """
    sample = labelled.select(*FEATURES, "label", "match", "before").dropDuplicates(["match", "before"])
    sample = sample.orderBy(F.xxhash64("match", "before"), "match", "before").limit(bound)
    sample = stored(sample.select(*FEATURES, "label"), "findings").coalesce(1)
    labels = sorted(r[0] for r in sample.select("label").distinct().collect())
    if len(labels) < 2:
        return labels[0] if labels else 0.0
    joined = VectorAssembler(inputCols=list(FEATURES), outputCol="__features")
    forest = RandomForestClassifier(
        featuresCol="__features",
        labelCol="label",
        probabilityCol="__probability",
        rawPredictionCol="__raw",
        predictionCol="__prediction",
        numTrees=TREES,
        maxDepth=DEPTH,
        seed=SEED,
    )
    return PipelineModel([joined, forest.fit(joined.transform(sample))])


def judged(found: DataFrame, model: PipelineModel | float) -> DataFrame:
    """Adds the probability that a finding is a secret; `found` has the columns of FEATURES."""
    if isinstance(model, float):
        return found.withColumn("probability", F.lit(model))
    chance: Column = F.get(vector_to_array("__probability"), F.lit(1))
    return model.transform(found).withColumn("probability", chance)


def secret_scan(
    docs: DataFrame,
    labelled: DataFrame | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
    path_column: str | None = "source",
) -> DataFrame:
    """One row per candidate: id, start, end (code points, end exclusive), secret, probability, is_secret.

    `labelled` has findings with match, before, after, path and label (1 secret, 0 not), such as a
    review of earlier scans leaves. Without it, findings of this corpus are labelled by their form. The
    dictionary counts the words of all texts, and every candidate of every whole text is judged. Null
    and empty texts have no candidates; those of rows that repeat an id and text are given once; an
    empty table gives none. Null paths are empty. Only the named columns are read.
    """
    triples = dictionary(docs, text_column)
    found = stored(features(findings(docs, id_column, text_column, path_column), triples), "candidates")
    known = label_findings(found) if labelled is None else features(labelled, triples)
    out = judged(found, fit_forest(known))
    return out.select(
        F.col("id").alias(id_column),
        "start",
        "end",
        F.col("match").alias("secret"),
        "probability",
        (F.col("probability") >= 0.5).alias("is_secret"),
    )
