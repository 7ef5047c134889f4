"""Quality rules: divergence of a text's character classes and common words from its language.

Each language has a reference: the summed histograms of its texts that pass the base rules. A text is rejected when
the Jensen-Shannon distance (base 2, 0 to 1) of its character classes or of its common words from the reference is
too large. Short texts scatter, so either comparison has a least length below which it gives no verdict.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from tallycube.llm.common import fresh, quoted, shielded, tidy, written

# Frequent words of the languages whose words are compared.
COMMON_WORDS = {
    "en": "the of and to in is that it was for on with as at by from a are be or".split(),
    "de": "der die das und ist nicht ein eine in zu mit von für auf den im sich als auch des".split(),
    "fr": "le la les de des un une et est que en dans pour du qui par sur au pas plus".split(),
    "es": "el la los las de que y en un una es por con para del se no su al lo".split(),
}
WORDS = sorted({w for words in COMMON_WORDS.values() for w in words})
# Character classes; a code point of none of them is "other" (ASCII) or "wide" (beyond ASCII).
CLASSES = {
    "lower": "abcdefghijklmnopqrstuvwxyz",
    "upper": "ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "digit": "0123456789",
    "space": " \t\n\x0b\f\r",
    "symbol": "#*$%&|<>",
    "mark": ".,;:!?'\"()-",
}
N_CLASSES = len(CLASSES) + 2
STRIPPED = b".,;:!?"

MIN_WORDS = 50
MAX_REPEATED = 50  # percent of the words
MIN_CHARS = 200
MAX_CLASS_DISTANCE = 0.30
MIN_WORDS_COMPARED = 200
MAX_WORD_DISTANCE = 0.32

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
DISTANCES = ["class_distance", "word_distance"]
OUTPUT = [*COUNTS, "base_failed", *DISTANCES, "kept"]
HISTOGRAM = T.ArrayType(T.LongType())
MEASURES = T.StructType(
    [
        *(T.StructField(c, T.LongType()) for c in COUNTS),
        *(T.StructField(c, HISTOGRAM) for c in ("classes", "words")),
        *(T.StructField(c, T.DoubleType()) for c in DISTANCES),
    ]
)


def _class_table() -> np.ndarray:
    table = np.full(256, len(CLASSES), np.uint8)
    for k, letters in enumerate(CLASSES.values()):
        table[list(letters.encode())] = k
    table[0x80:] = len(CLASSES) + 1
    table[0x80:0xC0] = N_CLASSES  # continuation bytes are no code points of their own
    return table


CLASS_OF = _class_table()
WORD_AT = {w.encode(): k for k, w in enumerate(WORDS)}
UPPER = bytes(CLASSES["upper"], "ascii")
LOWERED = bytes.maketrans(UPPER, CLASSES["lower"].encode())


def repeated_words(ids: np.ndarray, kinds: int) -> int:
    """Words inside a 3-word window that occurs twice or more."""
    n = len(ids)
    if n < 4:
        return 0
    pairs = np.unique(ids[:-1] * kinds + ids[1:], return_inverse=True)[1] if kinds > 1_000_000 else ids[:-1] * kinds + ids[1:]
    windows = pairs[:-1] * kinds + ids[2:]
    _, place, counts = np.unique(windows, return_inverse=True, return_counts=True)
    often = counts[place] > 1
    inside = np.zeros(n, bool)
    for shift in range(3):
        inside[shift : n - 2 + shift] |= often
    return int(inside.sum())


def measure_text(text: str | None) -> tuple:
    """The counts of one text and its two histograms; the last word bin holds all other words."""
    raw = (text or "").encode()
    classes = np.bincount(CLASS_OF[np.frombuffer(raw, np.uint8)], minlength=N_CLASSES + 1)[:N_CLASSES]
    words = raw.split()
    place: dict[bytes, int] = {}
    ids = np.fromiter((place.setdefault(w, len(place)) for w in words), np.int64, len(words))
    common = np.zeros(len(WORDS) + 1, np.int64)
    if words:
        counts = np.bincount(ids).tolist()
        for word, count in zip(place, counts, strict=True):
            common[WORD_AT.get(word.translate(LOWERED).strip(STRIPPED), -1)] += count
    seen: set[bytes] = set()
    dup_lines = 0
    for line in raw.split(b"\n"):
        if line in seen:
            dup_lines += 1
        elif line.strip(b" \t\x0b\f\r"):
            seen.add(line)
    spaces = list(CLASSES).index("space")
    word_chars = int(classes.sum() - classes[spaces])
    symbols = int(classes[list(CLASSES).index("symbol")])
    return len(words), word_chars, symbols, dup_lines, repeated_words(ids, len(place)), classes.tolist(), common.tolist()


@tidy
def _measure(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    for texts, of_classes, of_words in fresh(batches):
        found = pd.DataFrame([measure_text(t) for t in texts], columns=MEASURES.names[:-2])
        yield found.assign(class_distance=_distance(found["classes"], of_classes), word_distance=_distance(found["words"], of_words))


def measure(text: Column, of_classes: Column | None = None, of_words: Column | None = None) -> Column:
    """The counts and histograms of a text, and the distances of these from references, null where there is none. One function
    does both, as each takes a worker of its own beside the executor. Optimizers repeat a deterministic function below a filter on what
    it gives, and so measure each text twice, in two workers; they leave one alone that is said not to be deterministic."""
    none = F.lit(None).cast(HISTOGRAM)
    references = [none if c is None else c for c in (of_classes, of_words)]
    return F.pandas_udf(_measure, MEASURES).asNondeterministic()(text, *references)


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEATED * m["n_words"])


def references(documents: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """One row per language: summed histograms of the texts that pass the base rules."""
    m = documents.select(quoted(lang).cast("string").alias("_lang"), measure(quoted(text)).alias("_m")).filter(~base_failed(F.col("_m")))
    sums = [F.sum(F.col("_m.classes")[k]).alias(f"c{k}") for k in range(N_CLASSES)]
    sums += [F.sum(F.col("_m.words")[k]).alias(f"w{k}") for k in range(len(WORDS) + 1)]
    return (
        m.groupBy("_lang")
        .agg(*sums)
        .select(
            "_lang",
            F.array(*[f"c{k}" for k in range(N_CLASSES)]).alias("_ref_classes"),
            F.array(*[f"w{k}" for k in range(len(WORDS) + 1)]).alias("_ref_words"),
        )
    )


def _distance(counts: pd.Series, reference: pd.Series) -> pd.Series:
    out = np.full(len(counts), np.nan)
    there = [i for i, (c, r) in enumerate(zip(counts, reference, strict=True)) if c is not None and r is not None and sum(c) and sum(r)]
    if there:
        p = np.stack([counts.iloc[i] for i in there]).astype(float)
        q = np.stack([reference.iloc[i] for i in there]).astype(float)
        p, q = p / p.sum(1, keepdims=True), q / q.sum(1, keepdims=True)
        both = np.maximum(p + q, 1e-300)
        spread = sum((x * np.log2(np.where(x > 0, 2 * x / both, 1.0))).sum(1) for x in (p, q))
        out[there] = np.sqrt(np.maximum(spread / 2, 0))
    return pd.Series(out).where(~np.isnan(out), None).astype("Float64")


def distance(counts: Column, reference: Column) -> Column:
    """Jensen-Shannon distance of two histograms, with logarithms to base 2; null if either is missing or empty."""
    return F.pandas_udf(_distance, T.DoubleType())(counts, reference)


def judge(documents: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """Documents with the counts, the two distances (`class_distance`, `word_distance`) and the verdict `kept`.

    A null text counts as empty: it has no words, fails the base rules and is not kept. A text whose language has no
    reference (none of its texts passes the base rules), or is null, is compared with the texts of the same kind only;
    where there is none, the distances are null and the base rules decide. Words are compared for the languages of
    COMMON_WORDS only. Repeated rows get the same verdict each. Input columns with the name of an output column are
    replaced; an empty table gives no rows.
    """
    return shielded(documents, OUTPUT, [text, lang], _judge)


def _judge(documents: DataFrame, text: str, lang: str) -> DataFrame:
    # A row for each language, written, so that its size is known: no text travels to meet it, unless it is large.
    refs = written(references(documents, text, lang), "references")
    m = F.col("_m")
    judged = (
        documents.withColumn("_lang", F.col(lang).cast("string"))
        .join(refs.withColumnRenamed("_lang", "_of"), F.col("_lang").eqNullSafe(F.col("_of")), "left")
        .withColumn("_m", measure(F.col(text), F.col("_ref_classes"), F.col("_ref_words")))
    )
    chars = F.aggregate(m["classes"], F.lit(0).cast("long"), lambda s, x: s + x)
    known = F.col("_lang").isin(*COMMON_WORDS)
    class_distance = F.when(chars >= MIN_CHARS, m["class_distance"])
    word_distance = F.when((m["n_words"] >= MIN_WORDS_COMPARED) & known, m["word_distance"])
    with_distances = judged.select(
        *documents.columns,
        *[m[c].alias(c) for c in COUNTS],
        base_failed(m).alias("base_failed"),
        class_distance.alias("class_distance"),
        word_distance.alias("word_distance"),
    )
    far = F.coalesce(F.col("class_distance") > MAX_CLASS_DISTANCE, F.lit(False)) | F.coalesce(F.col("word_distance") > MAX_WORD_DISTANCE, F.lit(False))
    return with_distances.withColumn("kept", ~F.col("base_failed") & ~far)
