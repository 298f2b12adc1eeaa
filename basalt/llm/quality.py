"""Quality classifier: a sparse rule ensemble compiled into column expressions.

Statistics of the whole text are built-in column functions.  Trees are grown on
a bounded sample of labelled rows; every path from a root becomes a conjunctive
rule over the statistics, a lasso logistic regression weighs the rules, and the
rules with a weight become one Spark expression.  Scoring is a projection: no
shuffle, no Python.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basalt.llm.common import materialize, text_of

#: Labelled rows that are fitted at most (the smallest hashes of their ids).
FIT_ROWS = 20_000
TREES, DEPTH, LASSO, SEED = 24, 3, 0.0005, 7
THRESHOLD = 0.3

Rule = tuple[tuple[str, str, float], ...]


def statistics(text: Column) -> dict[str, Column]:
    """Named statistics of a text; all are 0 for an empty one."""
    chars = F.greatest(F.length(text), F.lit(1)).cast("double")
    words = F.greatest(F.regexp_count(text, F.lit(r"\S+")), F.lit(1)).cast("double")

    def count(pattern: str) -> Column:
        return F.regexp_count(text, F.lit(pattern)).cast("double")

    def of(char: str) -> Column:
        return (F.length(text) - F.length(F.replace(text, F.lit(char), F.lit("")))).cast("double")

    return {
        "words": words, "word_length": F.length(text) / words, "upper": count(r"\p{Lu}") / chars,
        "digits": count(r"\d") / chars, "symbols": count(r"[#$%&*@^~<>{}=_+/\\\\]") / words, "bangs": of("!") / words,
        "bars": of("|") / words, "stops": of(".") / words, "commas": of(",") / words, "lines": of("\n") / words,
        "short": count(r"(?<!\S)\S{1,3}(?!\S)") / words, "repeats": count(r"(?<!\S)(\S+)\s+\1(?!\S)") / words,
        "distinct": F.size(F.array_distinct(F.split(text, r"\s+"))) / words,
    }


def is_held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def tree_rules(description: str, names: list[str]) -> list[Rule]:
    """All paths of a printed decision tree, from the root to every node, as rules."""
    path: list[tuple[str, str, float]] = []
    rules = []
    base = None
    for line in description.splitlines():
        if not (m := re.match(r"( *)(?:If|Else) \(feature (\d+) (<=|>) ([-0-9.eE]+)\)", line)):
            continue
        depth = len(m[1]) if base is None else len(m[1]) - base
        base = depth if base is None else base
        depth = 0 if depth == base and not path else len(m[1]) - base
        path = [*path[:depth], (names[int(m[2])], m[3], float(m[4]))]
        rules.append(tuple(path))
    return rules


def compile_rule(rule: Rule) -> Column:
    return reduce(lambda a, b: a & b, [F.col(n) <= v if op == "<=" else F.col(n) > v for n, op, v in rule])


def fit_rules(train: DataFrame, names: list[str]) -> tuple[float, list[tuple[Rule, float]]]:
    """Intercept and weighted rules from rows of statistics and ``label`` (0/1).

    With no rows, or one class only, there are no rules and the intercept is the
    smoothed log odds.
    """
    counts = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    if len(counts) < 2:
        import math

        return math.log((counts.get(1, 0) + 1) / (counts.get(0, 0) + 1)), []
    data = VectorAssembler(inputCols=names, outputCol="features").transform(train)
    forest = RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, maxBins=64, seed=SEED, minInstancesPerNode=5,
                                    featureSubsetStrategy="onethird").fit(data)
    found = {r: None for tree in forest.trees for r in tree_rules(tree.toDebugString, names)}
    rules = sorted(found)
    if not rules:
        return fit_rules(train.where("1 = 0"), names)
    flags = train.select("label", F.array(*[compile_rule(r).cast("double") for r in rules]).alias("flags"))
    from pyspark.ml.functions import array_to_vector

    hits = flags.select("label", array_to_vector("flags").alias("features")).persist()
    model = LogisticRegression(maxIter=100, regParam=LASSO, elasticNetParam=1.0, standardization=False).fit(hits)
    hits.unpersist()
    weights = model.coefficients.toArray().tolist()
    return float(model.intercept), [(r, w) for r, w in zip(rules, weights, strict=True) if abs(w) > 1e-9]


def score_expression(intercept: float, rules: list[tuple[Rule, float]]) -> Column:
    """The rule ensemble as one column between 0 and 1."""
    total = F.lit(intercept)
    for rule, weight in rules:
        total = total + F.when(compile_rule(rule), F.lit(weight)).otherwise(F.lit(0.0))
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def score_quality(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", threshold: float = THRESHOLD, fit_rows: int = FIT_ROWS) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted.

    ``labels`` (id, 0/1) is learnt only from ids whose crc32 (of the id as text)
    is not divisible by 5, and from at most ``fit_rows`` of them; null labels are
    ignored, as are rows that label an id without a document.  Null texts score
    as empty ones, null ids are never labelled.  Without usable labels all
    scores are equal.  Empty table: empty result.
    """
    stats = statistics(F.col("t"))
    rows = (df.select(F.col(id_col).alias("doc_id"), text_of(text_col).alias("t"))
            .select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"), *[c.alias(n) for n, c in stats.items()]))
    rows = materialize(rows, "quality-statistics")
    known = labels.select(F.col(id_col).alias("label_id"), F.col(label_col).cast("int").alias("label")).where("label in (0, 1)")
    train = (rows.where("not held_out").join(known, F.col("doc_id") == F.col("label_id"))
             .orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(fit_rows).select("label", *stats))
    intercept, rules = fit_rules(materialize(train, "quality-sample"), list(stats))
    scored = rows.select("doc_id", "held_out", score_expression(intercept, rules).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", **kw) -> DataFrame:
    """The rows of ``df`` whose document is predicted good; all columns kept."""
    good = score_quality(df, labels, id_col=id_col, **kw).where("predicted = 1").select(F.col("doc_id").alias("__good"))
    return df.join(good.distinct(), F.col(id_col).eqNullSafe(F.col("__good")), "left_semi")
