"""Secret scan: fixed patterns, and a character convolutional network over every other candidate and its surroundings.

A candidate is a run of at least MIN_RUN token characters with a digit. The network sees the characters of the
candidate and of what stands before and after it: an embedding, one convolution, the maximum over all places, one
output. It is trained on two thirds of the labelled findings of all texts, its output is calibrated on the others, and the
threshold is the largest that still finds the wanted share of those. Findings are dealt to tasks; each trains the network on
its own, and the mean of their networks is where all start the next round.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tallycube.llm.common import quoted, slices, written

# The patterns of the scan and the least length of what counts.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 6, 20, 24
TOKEN = re.compile(r"[A-Za-z0-9+/_.=-]+")
MIN_RUN = 12
KINDS = ("assign", "access", "hex", "learned")

BEFORE, INSIDE, AFTER = 16, 40, 8  # characters the network sees at once; a longer candidate is seen in overlapping parts
SHARE = 20_000  # findings that a task trains on, about
ROUNDS, TOGETHER = 12, 4  # rounds over all findings, and how often the tasks' networks become one meanwhile
LOGITS = 1000  # findings whose logits are worked out at once
FINEST, WIDEST = 1000, 60  # logits are counted by thousandths for the calibration, up to this on either side
POINT = 1 << 32  # weights are added up as whole numbers of this fineness, so that the order does not matter
RECALL = 0.98
LEAST_CHANCE = 0.5  # whatever the recall wanted, an unlikely candidate is no finding

SPANS = "doc_id long, text_hash long, secrets array<struct<kind:string,start:long,end:long,score:double>>"
FINDINGS = "label int, codes binary, rank long"

_bytes = np.arange(256)
TOKEN_BYTE = np.isin(_bytes, list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_.=-"))
HEX_BYTE = np.isin(_bytes, list(b"0123456789abcdef"))
DIGIT_BYTE = np.isin(_bytes, list(b"0123456789"))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the fixed patterns, leftmost and without overlap for each kind, by start and then kind."""
    found = [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED]
    found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    found += [("hex", *m.span()) for m in HEX.finditer(text) if len(m[0]) >= MIN_HEX]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str) -> list[tuple[int, int]]:
    return [m.span() for m in TOKEN.finditer(text) if len(m[0]) >= MIN_RUN and any(c.isdigit() for c in m[0])]


def worth_reading(texts: list[bytes]) -> np.ndarray:
    """Which texts can have a base match or a candidate; judged on bytes, for all texts at once."""
    data = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + 1)
    out = np.zeros(len(texts), bool)
    digits = np.concatenate([[0], np.cumsum(DIGIT_BYTE[data])])
    for inside, least in ((TOKEN_BYTE, MIN_RUN), (HEX_BYTE, MIN_HEX)):
        run = np.concatenate([[False], inside[data]])
        edges = np.flatnonzero(run[1:] != run[:-1])
        start, end = edges[0::2], edges[1::2]
        long = end - start >= least
        if inside is TOKEN_BYTE:
            long &= digits[end] > digits[start]
        out[np.searchsorted(ends, start[long], side="right")] = True
    for k, t in enumerate(texts):
        if not out[k] and (b"=" in t or b":" in t or b"AKIA" in t):
            out[k] = True
    return out


def windows(text: str, start: int, end: int) -> list[np.ndarray]:
    """Character codes that the network sees, one array for each part of a long candidate; inside codes are raised by 128."""
    out = []
    for at in range(start, max(start + 1, end - INSIDE + INSIDE // 2), INSIDE // 2):
        stop = min(end, at + INSIDE)
        codes = [min(ord(c), 127) for c in text[max(0, at - BEFORE) : stop + AFTER]]
        own = at - max(0, at - BEFORE)
        codes = [0] * (BEFORE - own) + codes
        codes = [c + 128 if BEFORE <= i < BEFORE + stop - at else c for i, c in enumerate(codes)]
        out.append(np.array(codes + [0] * (BEFORE + INSIDE + AFTER - len(codes)), np.int64))
    return out


@dataclass
class CharNet:
    """Embedding, convolution over WIDTH characters, maximum over places, linear output, calibration, threshold."""

    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    shift: float = 0.0
    slope: float = 1.0
    offset: float = 0.0
    threshold: float = 2.0

    WIDTH = 5
    LEARNT = ("embed", "filters", "bias", "out")

    @classmethod
    def new(cls, seed: int, size: int = 8, filters: int = 32) -> CharNet:
        rng = np.random.default_rng(seed)
        return cls(rng.normal(0, 0.5, (256, size)), rng.normal(0, 0.2, (cls.WIDTH * size, filters)), np.zeros(filters), rng.normal(0, 0.2, filters))

    def _conv(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        x = self.embed[codes]
        places = codes.shape[1] - self.WIDTH + 1
        seen = np.concatenate([x[:, k : k + places] for k in range(self.WIDTH)], 2)
        return seen, seen @ self.filters + self.bias

    def logit(self, codes: np.ndarray) -> np.ndarray:
        if not len(codes):
            return np.zeros(0)
        return np.maximum(self._conv(codes)[1].max(1), 0) @ self.out + self.shift

    def chance(self, codes: np.ndarray) -> np.ndarray:
        """Calibrated chance that a candidate is a secret."""
        return self.chance_of(self.logit(codes))

    def chance_of(self, logits: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * logits + self.offset, -30, 30)))

    def weights(self) -> np.ndarray:
        """All that training changes, one behind the other."""
        return np.concatenate([*(getattr(self, n).ravel() for n in self.LEARNT), [self.shift]])

    def with_weights(self, flat: np.ndarray) -> CharNet:
        cuts = np.cumsum([getattr(self, n).size for n in self.LEARNT])
        parts = np.split(flat, cuts)
        named = {n: x.reshape(getattr(self, n).shape) for n, x in zip(self.LEARNT, parts, strict=False)}
        return replace(self, **named, shift=float(parts[-1][0]))

    def train(self, codes: np.ndarray, labels: np.ndarray, weights: np.ndarray, seed: int | list[int], rounds: int, batch: int = 128, rate: float = 0.01) -> None:
        """Adam on the weighted logistic loss."""
        rng = np.random.default_rng(seed)
        names = self.LEARNT
        first = {n: np.zeros_like(getattr(self, n)) for n in names}
        second = {n: np.zeros_like(getattr(self, n)) for n in names}
        step = 0
        for _ in range(rounds):
            order = rng.permutation(len(codes))
            for at in range(0, len(order), batch):
                some = order[at : at + batch]
                grads, shift = self._gradients(codes[some], labels[some], weights[some])
                step += 1
                self.shift -= rate * shift
                for n in names:
                    first[n] = 0.9 * first[n] + 0.1 * grads[n]
                    second[n] = 0.999 * second[n] + 0.001 * grads[n] ** 2
                    move = (first[n] / (1 - 0.9**step)) / (np.sqrt(second[n] / (1 - 0.999**step)) + 1e-8)
                    setattr(self, n, getattr(self, n) - rate * move)

    def _gradients(self, codes: np.ndarray, labels: np.ndarray, weights: np.ndarray | float = 1.0) -> tuple[dict[str, np.ndarray], float]:
        seen, raised = self._conv(codes)
        n, _, filters = raised.shape
        best = raised.argmax(1)
        top = np.take_along_axis(raised, best[:, None, :], 1)[:, 0]
        pooled = np.maximum(top, 0)
        wrong = (1 / (1 + np.exp(-np.clip(pooled @ self.out + self.shift, -30, 30))) - labels) * weights / n
        back = wrong[:, None] * self.out * (top > 0)
        at_best = seen[np.arange(n)[:, None], best]  # rows, filters, inputs of the filter
        grad_filters = np.einsum("nf,nfi->if", back, at_best)
        grad_embed = np.zeros_like(self.embed)
        size = self.embed.shape[1]
        for k in range(self.WIDTH):
            part = back[:, :, None] * self.filters[k * size : (k + 1) * size].T[None]
            np.add.at(grad_embed, codes[np.arange(n)[:, None], best + k], part)
        return {"embed": grad_embed, "filters": grad_filters, "bias": back.sum(0), "out": wrong @ pooled}, float(wrong.sum())

    def calibrate(self, logits: np.ndarray, labels: np.ndarray, counts: np.ndarray, recall: float) -> None:
        """Platt's scaling by Newton steps, with his targets short of 0 and 1; then the threshold for the recall.

        `counts` tells how many findings have a label and a logit; both labels weigh the same.
        """
        bad, good = counts[labels == 1].sum(), counts[labels == 0].sum()
        target = np.where(labels == 1, (bad + 1) / (bad + 2), 1 / (good + 2))
        weight = counts * np.where(labels == 1, 0.5 / bad, 0.5 / good) * (bad + good)
        x = np.stack([logits, np.ones_like(logits)], 1)
        w = np.array([1.0, 0.0])
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
            w = w - np.linalg.solve(hessian, x.T @ (weight * (p - target)) + 1e-3 * (w - [1.0, 0.0]))
        self.slope, self.offset = float(w[0]), float(w[1])
        chances, many = self.chance_of(logits[labels == 1]), counts[labels == 1]
        order = np.argsort(chances)
        at = np.searchsorted(np.cumsum(many[order]), int((1 - recall) * bad), side="right")
        self.threshold = max(LEAST_CHANCE, float(chances[order][at]))


def _labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ranks, rows = batch.column(1).to_pylist(), []
        for at, texts in slices(batch.column(0)):
            for k in np.flatnonzero(worth_reading(texts)).tolist():
                text = texts[k].decode()
                base = base_spans(text)
                # Of an assignment the value is the secret; its name is part of the surroundings.
                values = {m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED} | {(a, b) for kind, a, b in base if kind != "assign"}
                others = [(a, b) for a, b in candidates(text) if not any(a < y and x < b for _, x, y in base)]
                for label, spans in ((1, sorted(values)), (0, others)):
                    for start, end in spans:
                        for part in windows(text, start, end):
                            rows.append((label, part.astype(np.uint8).tobytes(), (ranks[at + k] + 7919 * start) % (1 << 62)))
        columns = list(zip(*rows, strict=True)) or [[]] * 3
        kinds = [pa.int32(), pa.binary(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["label", "codes", "rank"])


def labelled_findings(documents: DataFrame, text: str = "text") -> DataFrame:
    """Findings (label, codes, rank) of all texts: what the fixed patterns match has label 1, the other candidates have
    label 0. Findings of copies of a text count once, as `rank` is a hash of the text and of the place in it."""
    known = documents.select(quoted(text).cast("string").alias("text")).filter(F.col("text").isNotNull())
    found = known.select("text", F.abs(F.xxhash64("text")).alias("rank")).mapInArrow(_labelled, FINDINGS)
    return found.distinct()


def _share(table: pd.DataFrame, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray, np.ndarray, Callable[[np.ndarray], np.ndarray]]:
    """Codes, labels and which are for calibration, of one task; and what puts findings into surroundings of label 0."""
    table = table.sort_values(["rank", "label", "codes"])
    codes = np.frombuffer(b"".join(table["codes"]), np.uint8).reshape(len(table), -1).astype(np.int64)
    labels = table["label"].to_numpy().astype(float)
    usual = codes[labels == 0]

    def moved(some: np.ndarray) -> np.ndarray:
        others = usual[rng.integers(0, len(usual), len(some))] if len(usual) else some
        return np.where(some >= 128, some, np.where(others >= 128, ord(" "), others))

    return codes, labels, table["calibrates"].to_numpy(), moved


def _trained(table: pd.DataFrame, net: CharNet, weight: dict[int, float], seed: list[int], rounds: int) -> pd.DataFrame:
    """The weights (k, v) after training on one task's findings, and how many (n) those are."""
    rng = np.random.default_rng([*seed, int(table["share"].iloc[0])])
    codes, labels, calibrates, moved = _share(table, rng)
    codes, labels = codes[~calibrates], labels[~calibrates]
    half = (labels == 1) & (rng.random(len(labels)) < 0.5)
    codes[half] = moved(codes[half])
    own = replace(net)
    own.train(codes, labels, np.where(labels == 1, weight[1], weight[0]), [*seed, int(table["share"].iloc[0]), 1], rounds)
    flat = np.round(own.weights() * POINT).astype(np.int64)
    return pd.DataFrame({"k": np.arange(len(flat), dtype=np.int32), "v": flat, "n": np.int64(len(labels))})


def _counted(table: pd.DataFrame, net: CharNet, seed: list[int]) -> pd.DataFrame:
    """How many of one task's findings for calibration have each label and logit."""
    codes, labels, calibrates, moved = _share(table, np.random.default_rng([*seed, int(table["share"].iloc[0])]))
    bad = calibrates & (labels == 1)
    codes[bad] = moved(codes[bad])
    codes, labels = codes[calibrates], labels[calibrates]
    logits = np.concatenate([net.logit(codes[at : at + LOGITS]) for at in range(0, max(1, len(codes)), LOGITS)])
    steps = np.floor(np.clip(logits, -WIDEST, WIDEST) * FINEST).astype(np.int64)
    return pd.DataFrame({"label": labels.astype(np.int32), "step": steps}).groupby(["label", "step"]).size().reset_index(name="n")


def _one_argument(task: Callable[[pd.DataFrame], pd.DataFrame]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """A task with all but its table given, in the shape that Spark takes."""
    return lambda table: task(table)


def fit(findings: DataFrame, recall: float = RECALL, seed: int = 11) -> CharNet:
    """Train on two thirds of the findings, calibrate on the rest. Without both labels in both, nothing is ever found.

    In half of the training examples of label 1, and in all for the calibration, the surroundings are those of
    examples of label 0: the patterns find secrets by what stands before them already, the network is there for the others.
    Both labels weigh the same. All findings are read in each round, by tasks of about SHARE of them; the driver sees the
    mean of the weights and the counts of rounded logits, whose sizes are fixed.
    """
    net = CharNet.new(seed)
    dealt = F.xxhash64("rank", "codes", "label")
    table = written(findings.withColumn("dealt", dealt).withColumn("calibrates", F.pmod("dealt", F.lit(3)) == 0), "findings")
    known = {(r.calibrates, r.label): r.n for r in table.groupBy("calibrates", "label").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(known) < 4:
        return net
    shares = -(-sum(known.values()) // SHARE)
    training = {label: known[False, label] for label in (0, 1)}
    weight = {label: sum(training.values()) / (2 * n) for label, n in training.items()}
    parts = table.withColumn("share", F.pmod(F.shiftright("dealt", 8), F.lit(shares))).repartition(shares, "share").groupBy("share")
    for together, rounds in enumerate([ROUNDS] if shares == 1 else [ROUNDS // TOGETHER] * TOGETHER):
        learner = partial(_trained, net=net, weight=weight, seed=[seed, together], rounds=rounds)
        amount = F.col("v").cast("decimal(20,0)") * F.col("n").cast("decimal(10,0)")
        means = parts.applyInPandas(_one_argument(learner), "k int, v long, n long").groupBy("k").agg(F.sum(amount).alias("v"), F.sum("n").alias("n"))
        rows = sorted(means.collect())
        net = net.with_weights(np.array([float(r.v) / r.n / POINT for r in rows]))
    counted = parts.applyInPandas(_one_argument(partial(_counted, net=net, seed=[seed, TOGETHER])), "label int, step long, n long")
    counts = counted.groupBy("label", "step").agg(F.sum("n").alias("n")).orderBy("label", "step").toPandas()
    net.calibrate(counts["step"].to_numpy() / FINEST, counts["label"].to_numpy(), counts["n"].to_numpy().astype(float), recall)
    return net


def learned_spans(texts: list[str], found: list[list[tuple]], net: CharNet) -> list[list[tuple]]:
    """(kind, start, end, score) of the candidates that the network takes for secrets and no base span touches."""
    where, parts = [], []
    for k, text in enumerate(texts):
        for start, end in candidates(text):
            if not any(a < end and start < b for _, a, b in found[k]):
                for part in windows(text, start, end):
                    where.append((k, start, end))
                    parts.append(part)
    best: dict[tuple, float] = {}
    for at in range(0, len(parts), 2000):
        for key, chance in zip(where[at : at + 2000], net.chance(np.stack(parts[at : at + 2000])).tolist(), strict=True):
            best[key] = max(best.get(key, 0.0), chance)
    out: list[list[tuple]] = [[] for _ in texts]
    for (k, start, end), chance in best.items():
        if chance >= net.threshold:
            out[k].append(("learned", start, end, chance))
    return out


def _scan(batches: Iterator[pa.RecordBatch], shared) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
    for batch in batches:
        spans: list[list[dict]] = []
        for _, raws in slices(batch.column(1)):
            own: list[list[dict]] = [[] for _ in raws]
            read = np.flatnonzero(worth_reading(raws)).tolist()
            texts = [raws[k].decode() for k in read]
            base = [base_spans(t) for t in texts]
            for k, found, more in zip(read, base, learned_spans(texts, base, shared.value), strict=True):
                both = sorted([(*s, 1.0) for s in found] + more, key=lambda s: (s[1], KINDS.index(s[0])))
                own[k] = [dict(zip(("kind", "start", "end", "score"), s, strict=True)) for s in both]
            spans += own
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(spans, kind)], ["doc_id", "text_hash", "secrets"])


def scan(documents: DataFrame, net: CharNet, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, text_hash, and `secrets`, spans in code points with end exclusive, by start and kind.

    Spans of the fixed patterns have score 1 and may overlap each other; those of the network (kind `learned`) touch none
    of them. A null text is empty and has no secrets; repeated rows are scanned each; other columns are left out; an
    empty table gives no rows.
    """
    shared = documents.sparkSession.sparkContext.broadcast(net)
    source = documents.select(quoted(doc_id).cast("long").alias("doc_id"), quoted(text).cast("string").alias("text"))
    return source.withColumn("text_hash", F.xxhash64("text")).mapInArrow(lambda b: _scan(b, shared), SPANS)
