"""Language identification: family first, then one-versus-one linear SVMs within the family."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from expatlas.scratch import ship

#: Families of language codes. Codes not listed form a family each.
FAMILIES = {
    "germanic": "af da de en fy is lb nl nn no sv yi",
    "romance": "ca es fr gl it la oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "indic": "bn gu hi mr ne pa si ur",
    "uralic": "et fi hu",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "turkic": "az kk tr uz",
    "iranian": "fa ku ps",
    "semitic": "ar he mt",
}
_FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
_LOWER = np.frombuffer(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256)), np.uint8)


def ngram_buckets(texts: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashed byte trigrams of all texts, white space around each, and where each text's begin."""
    coded = [f"  {t} ".encode() for t in texts]
    data = _LOWER[np.frombuffer(b"".join(coded), np.uint8)].astype(np.uint32)
    data[(data >= 9) & (data <= 13)] = 32
    lengths = np.array([len(c) for c in coded])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    grams = (data[:-2] << 16) | (data[1:-1] << 8) | data[2:]
    hashed = ((grams * np.uint32(2654435761)) >> np.uint32(32 - buckets.bit_length() + 1)).astype(np.int32)
    inside = np.ones(len(hashed), bool)
    inside[(starts[1:, None] - [2, 1]).ravel()] = False  # trigrams over two texts
    return hashed[inside], starts - 2 * np.arange(len(starts))


def frequencies(text: str, buckets: int) -> np.ndarray:
    hashed, _ = ngram_buckets([text], buckets)
    return (np.bincount(hashed, minlength=buckets) / len(hashed)).astype(np.float32)


def train_svm(x: np.ndarray, y: np.ndarray, strength: float = 1e-3, rounds: int = 150) -> np.ndarray:
    """Weights of a linear SVM (squared hinge, L2) by accelerated gradient steps; ``y`` is -1 or 1.

    Features are scaled to unit deviation for training and the scale is folded into the weights. They
    sum to 1 in a row, so a constant added to all weights serves as the offset.
    """
    scale = 1 / (x.std(axis=0) + 1e-4)
    z = np.hstack([(x - x.mean(axis=0)) * scale, np.ones((len(x), 1))]).astype(np.float64)
    balance = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1))
    v = np.random.default_rng(0).normal(size=z.shape[1])
    for _ in range(20):  # largest curvature by power steps
        v = z.T @ (balance * (z @ v))
        v /= np.linalg.norm(v) + 1e-12
    rate = 1 / (2 * np.linalg.norm(z.T @ (balance * (z @ v))) + strength)
    w = ahead = np.zeros(z.shape[1])
    for t in range(rounds):
        slack = np.maximum(0, 1 - y * (z @ ahead))
        new = ahead - rate * (strength * ahead - 2 * z.T @ (balance * y * slack))
        ahead, w = new + t / (t + 3) * (new - w), new
    weights = w[:-1] * scale
    return weights + (w[-1] - x.mean(axis=0) @ weights)


class Model:
    """Two levels of one-versus-one machines; a class's score is the mean of its duels' sigmoids."""

    def __init__(self, x: np.ndarray, langs: list[str], buckets: int, steepness: float = 3.0) -> None:
        self.buckets, self.steepness = buckets, steepness
        self.langs = sorted(set(langs))
        names = np.array(langs)
        members: dict[str, list[str]] = {}
        for lang in self.langs:
            members.setdefault(_FAMILY_OF.get(lang, f"only {lang}"), []).append(lang)
        self.families = sorted(members)
        self.members = [members[f] for f in self.families]
        family = np.array([_FAMILY_OF.get(lang, f"only {lang}") for lang in langs])
        weights: list[np.ndarray] = []

        def duels(labels: np.ndarray, classes: list[str]) -> list[tuple[int, int, int]]:
            out = []
            for i, j in combinations(range(len(classes)), 2):
                at = (labels == classes[i]) | (labels == classes[j])
                weights.append(train_svm(x[at], np.where(labels[at] == classes[i], 1.0, -1.0)))
                out.append((i, j, len(weights) - 1))
            return out

        self.family_duels = duels(family, self.families)
        self.member_duels = [duels(names, m) for m in self.members]
        self.weights = np.stack(weights, axis=1).astype(np.float32) if weights else np.zeros((buckets, 0), np.float32)

    def _vote(self, margins: np.ndarray, duels: list, classes: int) -> np.ndarray:
        score = np.ones((len(margins), 1)) if classes == 1 else np.zeros((len(margins), classes))
        for i, j, k in duels:
            won = 1 / (1 + np.exp(-self.steepness * np.clip(margins[:, k], -20, 20)))
            score[:, i] += won / (classes - 1)
            score[:, j] += (1 - won) / (classes - 1)
        return score

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        hashed, starts = ngram_buckets(texts, self.buckets)
        counts = np.diff(np.append(starts, len(hashed)))
        sums = np.empty((len(texts), self.weights.shape[1]))
        for k in range(self.weights.shape[1]):
            sums[:, k] = np.add.reduceat(self.weights[:, k][hashed], starts, dtype=np.float64)
        margins = sums / counts[:, None]
        family = self._vote(margins, self.family_duels, len(self.families))
        best = family.argmax(axis=1)
        names, scores = np.empty(len(texts), object), np.zeros(len(texts))
        for f, members in enumerate(self.members):
            at = np.flatnonzero(best == f)
            if len(at):
                vote = self._vote(margins[at], self.member_duels[f], len(members))
                names[at] = np.array(members, object)[vote.argmax(axis=1)]
                scores[at] = family[at, f] * vote.max(axis=1)
        return names.tolist(), scores


def held_out(doc_id: Column) -> Column:
    """The quarter of documents that is never learned from; null ids are learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(documents: DataFrame, sample: int = 4000, buckets: int = 2048, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Model | None:
    """Fit on at most ``sample`` labelled documents, or one for each language if there are more languages.

    Different texts are drawn, evenly over languages, by a hash of the text, among those not held out;
    copies of a text count once. Only n-gram frequencies come to the driver, ``buckets`` floats a
    document. None if nothing is labelled.
    """
    ship(documents.sparkSession)
    known = documents.filter(F.col(lang).isNotNull() & ~held_out(F.col(doc_id)) & F.col(text).rlike(r"\p{L}"))
    known = known.select(F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(text).alias("_h"))
    counts = dict(known.groupBy("lang").agg(F.approx_count_distinct("_h")).collect())
    if not counts:
        return None
    each = max(1, sample // len(counts))
    spread = 1 << 40
    share = F.element_at(F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, int(spread * min(1.0, (1.3 * each + 20) / n)))]), F.col("lang"))
    drawn = known.filter(F.pmod("_h", F.lit(spread)) < share).dropDuplicates(["lang", "_h"])
    order = Window.partitionBy("lang").orderBy(F.pmod("_h", F.lit(spread)), "_h")
    drawn = drawn.withColumn("_n", F.row_number().over(order)).filter(F.col("_n") <= each).select("lang", "text")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"lang": b["lang"], "x": [frequencies(t, buckets).tobytes() for t in b["text"]]})

    rows = drawn.mapInPandas(count, "lang string, x binary").collect()
    rows = sorted(rows, key=lambda r: (r[0], bytes(r[1])))
    if not rows:
        return None
    return Model(np.stack([np.frombuffer(r[1], np.float32) for r in rows]), [r[0] for r in rows], buckets)


def identify(documents: DataFrame, model: Model | None, carry: bool = False, doc_id: str = "doc_id", text: str = "text", slice_chars: int = 4_000_000) -> DataFrame:
    """Language of every whole text: ``doc_id, held_out, lang_pred, score``, a row for each row.

    With ``carry`` all columns of the input are returned instead, and ``_lang_pred`` and ``_score``.
    A null text, one without a letter, and every text if there is no model is ``und`` with score 0.
    The score is the family's times the language's, both between 0 and 1. Repeated rows stay; an
    empty table gives none. One pass without a shuffle; the model is a few hundred kB.
    """
    ship(documents.sparkSession)
    sent = documents.sparkSession.sparkContext.broadcast(model)

    def slices(texts: list[str]) -> Iterator[list[str]]:
        held, size = [], 0
        for t in texts:
            if held and size + len(t) > slice_chars:
                yield held
                held, size = [], 0
            held.append(t)
            size += len(t)
        if held:
            yield held

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            names: list[str] = []
            scores: list[float] = []
            for part in (p for i in range(0, batch.num_rows, 250) for p in slices([t or "" for t in batch.column(text_column).slice(i, 250).to_pylist()])):  # their trigrams take some 60 bytes a letter
                if known is None:
                    names += ["und"] * len(part)
                    scores += [0.0] * len(part)
                else:
                    n, s = known.predict(part)
                    names += n
                    scores += s.tolist()
            letters = batch.column("_letters").to_pylist()
            names = [n if ok else "und" for n, ok in zip(names, letters, strict=True)]
            scores = [s if ok and n != "und" else 0.0 for n, s, ok in zip(names, scores, letters, strict=True)]
            rest = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(names, pa.string()), pa.array(scores, pa.float64())], out.names)

    letters = F.coalesce(F.col(text).rlike(r"\p{L}"), F.lit(False)).alias("_letters")
    if carry:
        rows, text_column, kept, prefix = documents.select("*", letters), text, documents.columns, "_"
    else:
        rows = documents.select(F.col(doc_id).alias("doc_id"), held_out(F.col(doc_id)).alias("held_out"), F.col(text).alias("_text"), letters)
        text_column, kept, prefix = "_text", ["doc_id", "held_out"], ""
    out = T.StructType([*[rows.schema[c] for c in kept], T.StructField(f"{prefix}lang_pred", T.StringType()), T.StructField(f"{prefix}score", T.DoubleType())])
    return rows.mapInArrow(run, out)
