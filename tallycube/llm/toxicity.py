"""Toxicity: boosted trees over dense features of a text, calibrated by isotonic regression.

Features are rates, so that length alone says nothing: words of a lexicon, plain and with letters written as other
characters; lexicon words near a second person; capitals, punctuation and words with signs inside. All are Spark SQL
expressions; trees and calibration are those of Spark ML.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tallycube.llm.common import quoted, shielded, written

# Words of insult and contempt, and of the second person, in the languages of the corpus.
LEXICON = (
    "idiot idiots moron morons loser losers scum clown clowns trash garbage stupid dumb pathetic worthless disgusting useless hate "
    "hateful ugly fool fools jerk jerks crap damn filthy vermin dumm dummkopf trottel abschaum wertlos ekelhaft dreckig "
    "imbécile crétin ordure pathétique dégoûtant minable imbécil estúpido basura patético asqueroso inútil"
).split()
SECOND_PERSON = "you your yours yourself u ur du dich dir dein deine ihr euch tu te toi ton vous votre tú usted tus".split()
# Characters that stand for letters in disguised words.
DISGUISE, PLAIN = "@013457$!", "aoieastsi"

NEAR = 5  # words
SAMPLE_ROWS = 40_000  # labelled rows that a model sees, about
LEARNED_WORDS = 500  # words taken over from the labelled rows at most
LEAST_ROWS, LEAST_SHARE = 5, 0.8  # a learned word occurs in so many rows with label 1, and they are this share of its rows
TREES, DEPTH = 20, 3
THRESHOLD = 0.7
FEATURES = ["lexicon", "learned", "any_word", "disguised", "near_you", "you", "capitals", "shouted", "exclaimed", "asked", "marks", "signs_inside", "digits"]
OUTPUT = ["score", "predicted"]
LETTERS = "abcdefghijklmnopqrstuvwxyz"
BETWEEN = r"[^\p{L}]+"


def _chars(text: Column, chars: str) -> Column:
    """How many characters of a text are among some."""
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _among(words: Column, some: list[str]) -> Column:
    return F.size(F.filter(words, lambda w: w.isin(*some)))


def with_features(documents: DataFrame, learned: list[str], text: str = "text") -> DataFrame:
    """The documents' columns and `_features`, an array in the order of FEATURES. `learned` are further words of the lexicon."""
    raw = F.coalesce(quoted(text).cast("string"), F.lit(""))
    lexicon = LEXICON + learned
    near = lambda w, i: w.isin(*SECOND_PERSON) & F.exists(F.slice("_words", F.greatest(i + 1 - NEAR, F.lit(1)), 2 * NEAR + 1), lambda x: x.isin(*lexicon))
    plain = F.translate(F.lower(raw), DISGUISE, PLAIN)
    n = {
        "words": F.size("_words"),
        "hits": _among(F.col("_words"), LEXICON),
        "learned": _among(F.col("_words"), learned) if learned else F.lit(0),
        "you": _among(F.col("_words"), SECOND_PERSON),
        "plain": F.when(_chars(raw, DISGUISE) > 0, _among(F.split(plain, BETWEEN), LEXICON)),
        "upper": _chars(raw, LETTERS.upper()),
        "letters": F.greatest(_chars(raw, LETTERS + LETTERS.upper()), F.lit(1)),
        "shouts": F.regexp_count(raw, F.lit(r"\b[A-Z]{3,}\b")),
        "exclaims": _chars(raw, "!"),
        "asks": _chars(raw, "?"),
        "stops": _chars(raw, ".,;:"),
        "inside": F.regexp_count(raw, F.lit(r"[A-Za-z][@$!*0-9](?=[A-Za-z])")),
        "digit": _chars(raw, "0123456789"),
    }
    split = documents.withColumn("_words", F.split(F.lower(raw), BETWEEN))
    counted = split.withColumn("_n", F.struct(*[c.alias(k) for k, c in n.items()]))
    c = F.col("_n")
    by_you = F.when((c["you"] > 0) & (c["hits"] + c["learned"] > 0), F.size(F.filter("_words", near))).otherwise(0)
    per = lambda a, b: (c[a] / c[b]).cast("double")
    values = {
        "lexicon": per("hits", "words"),
        "learned": per("learned", "words"),
        "any_word": F.least(c["hits"] + c["learned"], F.lit(10)).cast("double"),
        "disguised": (F.greatest(F.coalesce(c["plain"], c["hits"]) - c["hits"], F.lit(0)) / c["words"]).cast("double"),
        "near_you": (by_you / c["words"]).cast("double"),
        "you": per("you", "words"),
        "capitals": per("upper", "letters"),
        "shouted": per("shouts", "words"),
        "exclaimed": per("exclaims", "words"),
        "asked": per("asks", "words"),
        "marks": per("stops", "words"),
        "signs_inside": per("inside", "words"),
        "digits": per("digit", "words"),
    }
    return counted.withColumn("_features", F.array(*[values[f] for f in FEATURES])).drop("_n", "_words")


def learned_words(labelled: DataFrame) -> list[str]:
    """Words that mark label 1 in rows (text, _label): by the number of rows they occur in, at most LEARNED_WORDS."""
    words = labelled.distinct().select("_label", F.explode(F.array_distinct(F.split(F.lower("text"), BETWEEN))).alias("word")).filter(F.length("word") > 2)
    told = words.groupBy("word").agg(F.count("*").alias("rows"), F.sum("_label").alias("bad"))
    found = told.filter((F.col("bad") >= LEAST_ROWS) & (F.col("bad") >= LEAST_SHARE * F.col("rows")) & ~F.col("word").isin(*LEXICON))
    return [r.word for r in found.orderBy(F.desc("bad"), "word").limit(LEARNED_WORDS).collect()]


def _vectors(df: DataFrame) -> DataFrame:
    parts = df.withColumns({f"_f{k}": F.col("_features")[k] for k in range(len(FEATURES))})
    joined = VectorAssembler(inputCols=[f"_f{k}" for k in range(len(FEATURES))], outputCol="_vector").transform(parts)
    return joined.drop(*[f"_f{k}" for k in range(len(FEATURES))])


def _raw(trees: GBTClassificationModel, df: DataFrame) -> DataFrame:
    scored = trees.transform(_vectors(df))
    return scored.withColumn("_raw", vector_to_array("probability")[1]).drop("_vector", "rawPrediction", "probability", "prediction")


class ToxicityModel:
    """Learned words, trees and their calibration, as fitted by `fit`. Without trees every text has the score `base`."""

    def __init__(self, words: list[str], trees: GBTClassificationModel | None, calibration: IsotonicRegressionModel | None, base: float = 0.0):
        self.words, self.trees, self.calibration, self.base = words, trees, calibration, base

    def score(self, documents: DataFrame, text: str = "text") -> DataFrame:
        """The documents with `score`, from 0 to 1, and `predicted`, 1 where it reaches THRESHOLD.

        A null text is scored as an empty one; repeated rows get the same score; columns named `score` or `predicted`
        are replaced; an empty table gives no rows.
        """

        def scored(plain: DataFrame, text_: str) -> DataFrame:
            if self.trees is None:
                score, done = F.lit(float(self.base)), plain
            else:
                done = self.calibration.transform(_raw(self.trees, with_features(plain, self.words, text_)))
                score = F.least(F.greatest(F.col("_score"), F.lit(0.0)), F.lit(1.0))
            return done.select(*plain.columns, score.alias("score"), (score >= THRESHOLD).cast("int").alias("predicted"))

        return shielded(documents, OUTPUT, [text], scored)


def fit(documents: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text", rows: int = SAMPLE_ROWS) -> ToxicityModel:
    """Fit on about `rows` labelled rows, or on all if there are fewer: half of them for the learned words, a quarter for
    the trees, a quarter for the calibration.

    `labels` has the key and the label, 0 or 1; rows without a label, or without a document, are left out. The rows are
    chosen by a hash of the key, so that the labels are as frequent among them as among all. Where a part has one label
    only, all parts serve for all; where all rows have the same label, or there are none, the model knows that label only.
    """
    order = F.xxhash64(quoted(key).cast("string"), F.lit("sample"))
    known = labels.filter(quoted(label).isNotNull()).select(quoted(key).alias("_key"), quoted(label).cast("double").alias("_label"), order.alias("_order"))
    share = min(1.0, rows / max(1, known.count()))
    chosen = known.filter(F.pmod(F.shiftright("_order", 2), F.lit(1_000_000)) < int(share * 1_000_000))
    texts = documents.select(quoted(key).alias("_id"), F.coalesce(quoted(text).cast("string"), F.lit("")).alias("text"))
    # The sample is bounded by `rows`, so it may be broadcast.
    part = F.element_at(F.array(F.lit("words"), F.lit("words"), F.lit("trees"), F.lit("calibration")), (F.pmod("_order", F.lit(4)) + 1).cast("int"))
    found = written(texts.join(F.broadcast(chosen), F.col("_id") == F.col("_key")).select("text", "_label", part.alias("_part")), "labelled")
    parts = {(r._part, r._label) for r in found.select("_part", "_label").distinct().collect()}
    if {v for _, v in parts} != {0.0, 1.0}:
        return ToxicityModel([], None, None, max((v for _, v in parts), default=0.0))
    of = (lambda name: found.filter(F.col("_part") == name)) if len(parts) == 6 else (lambda name: found)
    words = learned_words(of("words").select("text", "_label"))
    featured = written(with_features(found, words).select("_part", "_label", "_features"), "featured")
    of = (lambda name: featured.filter(F.col("_part") == name).coalesce(2)) if len(parts) == 6 else (lambda name: featured.coalesce(2))
    trees = GBTClassifier(featuresCol="_vector", labelCol="_label", maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, maxBins=32).fit(_vectors(of("trees")))
    calibration = IsotonicRegression(featuresCol="_raw", labelCol="_label", predictionCol="_score").fit(_raw(trees, of("calibration")))
    return ToxicityModel(words, trees, calibration)
