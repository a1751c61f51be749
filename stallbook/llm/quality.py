"""A quality classifier from weak labels.

1. Labellers, each a simple heuristic over the text, vote good, bad or nothing on every document.
2. Expectation-maximisation estimates how often each labeller is right on good and on bad documents,
   without any given label, from how often they agree. Only the votes matter, so it runs on the counts
   of each pattern of votes over all documents, a table of at most 3 to the power of the labellers.
3. The posterior labels train a linear scorer on hashed words and word shapes, which then scores every
   document, also where no labeller has an opinion.

The scorer is fitted on a bounded sample, TRAINING documents chosen by a hash of doc_id and text, each
once as good and once as bad, weighted by the posterior. Votes, pattern counts and scores cover all
documents and whole texts. Given labels, sources and languages are not read.

Cases: null and empty texts, and those of white space, have no words: they are voted bad and score 0.
Repeated rows count and score alike. An empty table gives no rows; with only one class in the sample the
score is the posterior of the votes. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stallbook.llm.tables import table, texts
from stallbook.storage import written

TRAINING = 6_000
DIMENSIONS = 1 << 14
ROUNDS = 200
#: Documents that score at least so much are kept.
KEEP = 0.5

#: Some of the commonest words of a few languages.
COMMON = (
    "the of and to in is it that for was with as on be by at this are from or an der die und das ist ein nicht mit von den zu für dem auf "
    "le la les de et un une en du pour que est dans qui par el los las del y con se por una su no"
).split()


def prepared(docs: DataFrame) -> DataFrame:
    """Documents with what several measures look at, so that each is made once."""
    body = F.coalesce(F.col("text"), F.lit(""))
    return (
        texts(docs)
        .select("doc_id", F.xxhash64("doc_id", "text").alias("draw"), body.alias("body"))
        .withColumn("flat", F.trim(F.regexp_replace("body", r"\s+", " ")))
        .withColumn("words", F.split(F.lower("flat"), " "))
        .withColumn("dense", F.replace("flat", F.lit(" ")))
    )


def left(text: Column, others: str) -> Column:
    """Number of characters that are left without the others; a run of these costs one match."""
    return F.length(F.regexp_replace(text, f"{others}+", ""))


def measures() -> dict[str, Column]:
    """Numbers about a prepared text that labellers vote on."""
    body, flat, words, dense = map(F.col, ("body", "flat", "words", "dense"))
    size = F.greatest(F.lit(1), F.length(dense))
    count = F.greatest(F.lit(1), F.size(words))
    lines = F.filter(F.split(body, "\n"), lambda line: F.trim(line) != "")
    return {
        "n_words": F.when(F.trim(body) == "", 0).otherwise(F.size(words)),
        "odd": left(dense, r"[\p{L}\p{M}\p{N}\s.,;:!?'\"()-]") / size,
        "shouts": (F.length(flat) - F.length(F.replace(flat, F.lit("!")))) / count,
        "upper": left(dense, r"\P{Lu}") / F.greatest(F.lit(1), left(dense, r"\P{L}")),
        "digits": left(dense, r"\P{N}") / size,
        "same": 1 - F.size(F.array_distinct(words)) / count,
        "length": size / count,
        "common": F.size(F.filter(words, lambda w: w.isin(COMMON))) / count,
        "ended": F.size(F.filter(lines, lambda line: F.trim(line).rlike(r"[.!?:\"')]$"))) / F.greatest(F.lit(1), F.size(lines)),
    }


def votes() -> list[Column]:
    """Each labeller's vote on the measures: 1 good, -1 bad, 0 no opinion."""

    def vote(bad: Column, good: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    m = {k: F.col(f"m.{k}") for k in ("n_words", "odd", "shouts", "upper", "digits", "same", "length", "common", "ended")}
    enough = m["n_words"] >= 20
    return [
        vote(m["odd"] > 0.08, m["odd"] < 0.01),
        vote(m["shouts"] > 0.2, (m["shouts"] < 0.02) & enough),
        vote(m["upper"] > 0.4, m["upper"] < 0.15),
        vote((m["same"] > 0.85) & enough, (m["same"] < 0.6) & enough),
        vote((m["length"] > 12) | (m["length"] < 2), (m["length"] > 3) & (m["length"] < 9)),
        vote((m["common"] < 0.02) & enough, m["common"] > 0.1),
        vote((m["ended"] < 0.2) & enough, m["ended"] > 0.7),
        vote((m["n_words"] == 0) | (m["digits"] > 0.4), enough & (m["digits"] < 0.05)),
    ]


def posteriors(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Probability that each pattern of votes is of a good document, and the labellers' vote rates by class.

    There is one class of good documents and, as faults exclude each other, one class of bad ones for
    each labeller, which at the start holds what that labeller votes against. Votes are independent
    given the class, with a rate for each labeller and class among the documents it votes on; an
    abstention says nothing. Where labellers overlap they weigh each other.
    """
    up, down = (patterns > 0).astype(float), (patterns < 0).astype(float)
    against = down.sum(axis=1)
    good = np.where(against == 0, 0.95, 0.2 / np.maximum(1, against))
    spread = np.where(against[:, None] == 0, 1 / patterns.shape[1], down / np.maximum(1, against)[:, None])
    share = np.column_stack([good, (1 - good)[:, None] * spread])
    for _ in range(rounds):
        weight = share * counts[:, None]
        yes, no = weight.T @ up, weight.T @ down
        rates = (yes + 0.5) / (yes + no + 1)
        prior = weight.sum(axis=0) + 1
        logs = up @ np.log(rates).T + down @ np.log(1 - rates).T + np.log(prior / prior.sum())
        now = np.exp(logs - logs.max(axis=1, keepdims=True))
        now /= now.sum(axis=1, keepdims=True)
        done = np.abs(now - share).max() < 1e-9
        share = now
        if done:
            break
    return share[:, 0], rates


def shapes(rows: DataFrame, *kept: str) -> DataFrame:
    """kept and words: the words, lower-cased, their shapes, in which runs of letters, capitals, digits or
    one sign are one, and how many tenths of the words are repeats; rows has body."""
    shape = F.regexp_replace("body", r"\p{Ll}+", "a")
    shape = F.regexp_replace(shape, r"\p{Lu}+", "A")
    shape = F.regexp_replace(shape, r"\p{N}+", "0")
    shape = F.regexp_replace(shape, r"([^\s\p{L}\p{N}])\1+", "$1")
    split = rows.select(*kept, F.split(F.lower("body"), r"\s+").alias("all"), F.array_distinct(F.split(shape, r"\s+")).alias("shapes"))
    distinct = split.select(*kept, F.size("all").alias("n"), F.array_distinct("all").alias("distinct"), "shapes")
    tenths = F.floor(10 * (1 - F.size("distinct") / F.col("n"))).cast("int")
    repeats = F.transform(F.sequence(F.lit(0), tenths), lambda n: F.concat(F.lit("\t\t"), n.cast("string")))
    return distinct.select(*kept, F.concat("distinct", repeats, F.transform("shapes", lambda s: F.concat(F.lit("\t"), s))).alias("words"))


def voted(docs: DataFrame) -> DataFrame:
    measured = prepared(docs).select("doc_id", "draw", F.struct(*[v.alias(k) for k, v in measures().items()]).alias("m"))
    return measured.select("doc_id", "draw", F.array(*votes()).alias("votes"))


def scored(docs: DataFrame) -> DataFrame:
    """doc_id, score (0 to 1) and keep of every document."""
    stored = written(voted(docs), "votes")
    counted = stored.groupBy("votes").agg(F.count(F.lit(1)).alias("n")).collect()  # at most 3^8 rows
    out = "doc_id long, score double, keep boolean"
    if not counted:
        return docs.sparkSession.createDataFrame([], out)
    counted.sort(key=lambda r: r["votes"])
    good, _ = posteriors(np.array([r["votes"] for r in counted]), np.array([r["n"] for r in counted], float))
    known = F.create_map(
        *[F.lit(x) for r, p in zip(counted, good.tolist(), strict=True) for x in (",".join(map(str, r["votes"])), p)]
    )
    posterior = F.element_at(known, F.array_join(F.col("votes").cast("array<string>"), ","))
    total = sum(r["n"] for r in counted)
    hashed = HashingTF(inputCol="words", outputCol="features", numFeatures=DIMENSIONS, binary=True)
    rows = texts(docs).select("doc_id", F.xxhash64("doc_id", "text").alias("draw"), F.coalesce("text", F.lit("")).alias("body"))
    share = F.pmod(F.xxhash64("draw"), F.lit(1 << 40)) < min(1.0, TRAINING / total) * (1 << 40)
    labels = F.explode(F.array(F.struct(F.lit(1.0).alias("label"), F.col("p").alias("w")), F.struct(F.lit(0.0).alias("label"), (1 - F.col("p")).alias("w"))))
    drawn = stored.where(share).select("draw", posterior.alias("p")).dropDuplicates(["draw"])
    sample = shapes(rows.where(share).join(drawn, "draw"), "p")
    sample = written(sample.select("words", labels.alias("x")).select("words", "x.label", "x.w").where("w > 0.001"), "training")
    if sample.select("label").distinct().count() < 2:
        return stored.select("doc_id", posterior.alias("score"), (posterior >= KEEP).alias("keep"))
    learner = LogisticRegression(weightCol="w", regParam=0.001, maxIter=40, standardization=False)
    model = learner.fit(hashed.transform(sample))
    features = hashed.transform(shapes(rows.withColumn("empty", F.trim(F.regexp_replace("body", r"\s+", " ")) == ""), "doc_id", "empty"))
    score = F.when(F.col("empty"), 0.0).otherwise(vector_to_array("probability")[1])
    return (
        model.transform(features)
        .select("doc_id", score.alias("score"))
        .select("doc_id", "score", (F.col("score") >= KEEP).alias("keep"))
    )


def op9_quality(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of every document."""
    return scored(table(spark, folder, "documents"))
