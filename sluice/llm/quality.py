"""Quality: a sparse ensemble of rules over statistics of a text.

Shallow trees are grown on labelled texts' statistics. Every path from a root is a rule: a
conjunction of comparisons. A lasso logistic regression weighs the rules, most become zero,
and what is left is compiled into one Spark column expression over the statistics.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sluice.llm.rows import map_rows, staged, utf8
from sluice.llm.toxicity import training_rows

STATISTICS = (
    "letters", "capitals", "digits", "symbols", "bars", "stops", "commas", "spaces", "breaks", "beyond", "doubled",
    "words_log", "word_mean", "word_deviation", "word_most", "distinct_words", "top_word", "odd_words", "capital_words",
    "line_mean", "distinct_lines", "stop_lines",
)
TRAIN_ROWS = 8_000
TREES = 24
DEPTH = 3
LASSO = 0.002
THRESHOLD = 0.3
_ASCII_WORD = bytes(b if 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))
_GROUPS = np.zeros((256, 10))
for _i, _members in enumerate((
    [*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)], range(0x41, 0x5B), range(0x30, 0x3A),
    b"#$%&*@^~+=<>\\_{}[]", b"|", b".!?", b",;:", b" \t", b"\n\r", range(0x80, 0x100),
)):
    _GROUPS[list(_members), _i] = 1


def statistics(text: str | None) -> list[float]:
    """The values of ``STATISTICS`` over the whole text; all are finite, an empty text's are zero."""
    data = utf8(text)
    codes = np.frombuffer(data, np.uint8)
    size = len(codes)
    if not size:
        return [0.0] * len(STATISTICS)
    shares = np.bincount(codes, minlength=256) @ _GROUPS / size
    doubled = float(np.count_nonzero(codes[1:] == codes[:-1])) / size
    words = data.split()
    lengths = np.fromiter(map(len, words), np.float64, len(words)) if words else np.zeros(1)
    kinds: dict[bytes, int] = {}
    for word in words:
        kinds[word] = kinds.get(word, 0) + 1
    number = max(1, len(words))
    plain = len(data.translate(_ASCII_WORD).split())
    capital = sum(count for word, count in kinds.items() if word.isupper() and len(word) > 1)
    lines = [line.strip() for line in data.split(b"\n") if line.strip()]
    count = max(1, len(lines))
    return [
        *shares.tolist(),
        doubled,
        float(np.log1p(len(words))),
        float(lengths.mean()),
        float(lengths.std()),
        float(min(lengths.max(), 1e6)),
        len(kinds) / number,
        max(kinds.values(), default=0) / number,
        plain / number,
        capital / number,
        size / count,
        len(set(lines)) / count,
        sum(line.endswith((b".", b"!", b"?")) for line in lines) / count,
    ]


def with_statistics(df: DataFrame, text: str = "text") -> DataFrame:
    """``df`` and the array ``_statistics``; a null text is empty."""
    at = df.columns.index(text)
    fields = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in df.schema)

    def work(rows):
        for row in rows:
            yield (*row, statistics(row[at]))

    return map_rows(df, work, f"{fields}, `_statistics` array<double>")


@dataclass(frozen=True)
class Rule:
    """Comparisons (statistic, above, bound) that all hold; above is ``>``, else ``<=``."""

    tests: tuple[tuple[int, bool, float], ...]

    def column(self, values: Column) -> Column:
        parts = [(values[i] > bound) if above else (values[i] <= bound) for i, above, bound in self.tests]
        return reduce(lambda a, b: a & b, parts)


@dataclass(frozen=True)
class Ensemble:
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    intercept: float

    def column(self, values: Column) -> Column:
        """The probability of label 1 as an expression."""
        terms = [
            F.when(rule.column(values), F.lit(weight)).otherwise(F.lit(0.0))
            for rule, weight in zip(self.rules, self.weights, strict=True)
        ]
        total = reduce(lambda a, b: a + b, terms, F.lit(self.intercept))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


_TEST = re.compile(r"( *)(If|Else) \(feature (\d+) (<=|>) (\S+)\)")


def paths(described: str) -> set[Rule]:
    """The rules of all inner nodes' branches of a tree in Spark's description."""
    found = set()
    stack: list[tuple[int, tuple[int, bool, float]]] = []
    for line in described.splitlines():
        match = _TEST.match(line)
        if not match:
            continue
        depth = len(match[1])
        while stack and stack[-1][0] >= depth:
            stack.pop()
        stack.append((depth, (int(match[3]), match[4] == ">", float(match[5]))))
        found.add(Rule(tuple(sorted(test for _, test in stack))))
    return found


def train(
    documents: DataFrame,
    labels: DataFrame,
    *,
    target: str = "quality",
    doc_id: str = "doc_id",
    text: str = "text",
    rows: int = TRAIN_ROWS,
    trees: int = TREES,
    depth: int = DEPTH,
    lasso: float = LASSO,
) -> Ensemble:
    """An ensemble from about ``rows`` labelled rows that are not held out. Labels of one kind, or none, give a constant."""
    chosen = training_rows(documents, labels, target, doc_id=doc_id, text=text, rows=rows)
    measured = with_statistics(chosen).select("label", "_statistics")
    flat = measured.select("label", *[F.col("_statistics")[i].alias(name) for i, name in enumerate(STATISTICS)])
    # A bounded sample: a few rows of doubles, written so that training reads it many times at no cost.
    table = staged(flat.coalesce(4), "quality")
    ones, number = table.agg(F.coalesce(F.sum("label"), F.lit(0)), F.count(F.lit(1))).first()
    if ones in (0, number):
        share = (ones + 0.5) / (number + 1)
        return Ensemble((), (), float(np.log(share / (1 - share))))
    # The rarer label counts as much as the other while rules are sought.
    weight = F.when(F.col("label") == 1, number / (2 * ones)).otherwise(number / (2 * (number - ones)))
    vectors = VectorAssembler(inputCols=list(STATISTICS), outputCol="features").transform(
        table.withColumn("weight", weight)
    ).cache()
    forest = RandomForestClassifier(
        labelCol="label", weightCol="weight", numTrees=trees, maxDepth=depth, seed=11, featureSubsetStrategy="onethird"
    ).fit(vectors)
    rules = sorted(set().union(*(paths(tree.toDebugString) for tree in forest.trees)), key=lambda rule: rule.tests)
    vectors.unpersist()
    if not rules:
        share = ones / number
        return Ensemble((), (), float(np.log(share / (1 - share))))
    values = F.array(*[F.col(name) for name in STATISTICS])
    held = table.select("label", *[rule.column(values).cast("double").alias(f"r{i}") for i, rule in enumerate(rules)])
    binary = VectorAssembler(inputCols=[f"r{i}" for i in range(len(rules))], outputCol="features").transform(held)
    binary = binary.select("label", "features").cache()
    model = LogisticRegression(
        labelCol="label", elasticNetParam=1.0, regParam=lasso, standardization=False, maxIter=60
    ).fit(binary)
    binary.unpersist()
    kept = [(rule, float(w)) for rule, w in zip(rules, model.coefficients.toArray(), strict=True) if w]
    return Ensemble(tuple(rule for rule, _ in kept), tuple(w for _, w in kept), float(model.intercept))


def score(
    documents: DataFrame, ensemble: Ensemble, *, text: str = "text", threshold: float = THRESHOLD
) -> DataFrame:
    """The columns of ``documents``, then ``score`` and ``predicted``; columns of these names are replaced.

    A null text is scored as an empty one; every row is answered, whatever its id.
    """
    measured = with_statistics(documents.drop("score", "predicted", "_statistics"), text)
    scored = measured.withColumn("score", ensemble.column(F.col("_statistics"))).drop("_statistics")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
