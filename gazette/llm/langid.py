"""Language identification with error-correcting output codes.

Every language has a codeword of bits. For each bit one binary classifier over
character n-grams (naive Bayes on hashed 1- to 4-grams of lower-cased letters)
predicts on which side of the bit the text's language stands. Decoding weighs
each bit's loss by how well its classifier does on the texts it was fit on, and
takes the codeword of least loss; if the second is nearly as near the text is
flagged as ambiguous. How near is told by the gap between the two losses, which
is a mean over the text's n-grams: it is held against the gap that the texts the
model was fit on have between the same two languages. A text of which ``CLEAR``
or less is in its language is flagged, however many languages there are. The
score is a weight among the languages and no part of this.

Fitting reads a sample of labelled texts: a text is in it by the hash of doc_id
and text, with the chance that makes ``SAMPLE`` texts of each language likely
(all, if there are fewer). N-grams are counted in tasks and summed by Spark;
the driver gets one count a language and n-gram bucket. Prediction runs over
every whole text, in Arrow batches, a text at a time; a very long text is read
in blocks. The model sent to tasks has a fixed size a language.

Defined cases: a text that is null or has no letter gets ``und`` and score 0,
and is flagged.
Labelled rows without text, and texts without label, teach nothing. Of more than
``LANGUAGES`` languages those with the fewest texts (of as many, the last by
name) teach nothing either and are never predicted. With one
language all texts with letters get it; with none all get ``und``. Rows without
doc_id are never learnt from by the query and count as held out. Extra columns
stay, columns named like a result are replaced; an empty table stays empty.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import free_name

BUCKETS = 1 << 13
SAMPLE = 4000        # texts a language
BLOCK = 1 << 18      # characters read at a time
UNKNOWN = "und"
CLEAR = 2 / 3        # texts with no larger share in one of two languages are flagged
LANGUAGES = 512      # learnt at most: the model has BUCKETS numbers a code bit

_MULT = [np.uint64(m) for m in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]


@functools.lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """For every code point whether it is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def gram_buckets(text: str | None) -> Iterator[np.ndarray]:
    """Bucket numbers of the n-grams of a text, block by block. Runs of
    characters that are no letters count as one blank."""
    if not text:
        return
    table, blank = letter_table(), np.uint32(32)
    for at in range(0, len(text), BLOCK):
        block = text[at:at + BLOCK + 3] if at + BLOCK < len(text) else text[at:]
        codes = np.frombuffer(block.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        letter = table[codes]
        if not letter.any():
            continue
        c = np.where(letter, codes, blank)
        c = c[np.concatenate([[True], letter[1:] | letter[:-1]])].astype(np.uint64)
        c = np.concatenate([[np.uint64(32)], c, [np.uint64(32)]]) if at == 0 else np.concatenate([c, [np.uint64(32)]])
        h, out = c * _MULT[0], []
        for n in range(1, 5):
            if n > 1:
                if len(c) < n:
                    break
                h = (h[:-1] ^ (h[:-1] >> np.uint64(29))) * _MULT[n - 1] + c[n - 1:] * _MULT[0]
            mixed = (h ^ (h >> np.uint64(32))) * _MULT[3]
            out.append((mixed >> np.uint64(51)).astype(np.int64))
        yield np.concatenate(out)


def gram_counts(text: str | None) -> np.ndarray | None:
    """N-gram counts by bucket; None if the text has no letter."""
    counts = None
    for buckets in gram_buckets(text):
        found = np.bincount(buckets, minlength=BUCKETS)
        counts = found if counts is None else counts + found
    return counts


def codewords(n: int) -> np.ndarray:
    """A +1/-1 codeword (row) a language, with distinct columns: the exhaustive
    code up to six languages, else of some seeded random ones that whose least
    distance is largest."""
    if n < 2:
        return np.ones((n, 0))
    if n <= 6:
        cols = [[1 if (k >> i) & 1 else -1 for i in range(n - 1)] + [-1] for k in range(1, 1 << (n - 1))]
        return np.array(cols, float).T
    rng, bits, best, far = np.random.default_rng(7), 12 * int(np.ceil(np.log2(n))), None, -1
    for _ in range(50):
        code = rng.choice([-1.0, 1.0], (n, bits))
        code[:, np.abs(code.sum(0)) == n] *= np.where(np.arange(n) % 2, 1.0, -1.0)[:, None]
        gap = (bits - (code @ code.T - 2 * bits * np.eye(n)).max()) / 2
        if gap > far:
            best, far = code, gap
    return best


@dataclass(frozen=True)
class Model:
    languages: tuple
    code: np.ndarray      # language x bit
    weights: np.ndarray   # bucket x bit: log odds of the +1 side
    trust: np.ndarray     # weight of each bit's loss
    gaps: np.ndarray | None = None  # language x language: loss of the second less that of the first, over the first's own n-grams

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        if not self.languages:
            return UNKNOWN, 0.0, True
        counts = gram_counts(text)
        if counts is None:
            return UNKNOWN, 0.0, True
        return self.decode(counts @ self.weights / counts.sum())

    def loss(self, margin: np.ndarray) -> np.ndarray:
        return (np.logaddexp(0.0, -SHARPNESS * self.code * margin) * self.trust).sum(1) / self.trust.sum()

    def decode(self, margin: np.ndarray) -> tuple[str, float, bool]:
        """Loss-weighted decoding of mean log odds an n-gram, one a bit."""
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        loss = self.loss(margin)
        p = np.exp(-DECISION * (loss - loss.min()))
        best = int(loss.argmin())
        near = loss - loss[best] <= self.least_gaps(best)
        return self.languages[best], float(p[best] / p.sum()), bool(np.delete(near, best).any())

    def least_gaps(self, best: int) -> np.ndarray:
        """The gap to each other language up to which a text is ambiguous. Gaps
        are linear in the n-grams: with a share s in the nearest language and
        the rest in the other, the gap is s * own - (1 - s) * back."""
        if self.gaps is None:
            return np.zeros(len(self.languages))
        own, back = self.gaps[best], self.gaps[:, best]
        back = np.where(back > 0, back, own)  # a language with nothing learnt has no gaps of its own
        return np.maximum(0.0, np.maximum((1 - CLEAR) * own, CLEAR * own - (1 - CLEAR) * back))


SHARPNESS = 8.0  # of a bit's logistic loss in mean log odds
DECISION = 8.0   # of the score in weighted loss


def _count(lang_text: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of n-gram counts by (language, bucket), a task at a time."""
    sums: dict = {}
    for b in lang_text:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1)):
            counts = gram_counts(text.as_py())
            if counts is not None:
                sums[lang] = sums.get(lang, 0) + counts
    for lang, s in sums.items():
        at = np.flatnonzero(s)
        yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at, pa.int64()), pa.array(s[at], pa.int64())], names=["lang", "bucket", "n"])


def fit(labelled: DataFrame, sample: int = SAMPLE, most: int = LANGUAGES) -> Model:
    """A model from (doc_id, text, lang) rows: of about ``sample`` texts each of
    the ``most`` languages that have the most texts."""
    known = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    sizes = known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), "lang").limit(most)
    sizes = {r["lang"]: r["n"] for r in sizes.collect()}
    if not sizes:
        return Model((), codewords(0), np.zeros((BUCKETS, 0)), np.ones(0))
    share = F.create_map(*[x for k, n in sizes.items() for x in (F.lit(k), F.lit(min(1.0, sample / n)))])
    draw = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    chosen = known.where(draw < share[F.col("lang")]).select("lang", "text")
    sums = chosen.mapInArrow(_count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = tuple(sorted(sizes))
    counts = np.zeros((len(languages), BUCKETS))
    row = {k: i for i, k in enumerate(languages)}
    counts[[row[k] for k in sums["lang"]], sums["bucket"].to_numpy(int)] = sums["n"].to_numpy(float)
    share_of = (counts + 0.05) / (counts + 0.05).sum(1, keepdims=True)  # every language weighs alike
    code = codewords(len(languages))
    weights = np.stack([np.log(share_of[code[:, b] > 0].mean(0)) - np.log(share_of[code[:, b] < 0].mean(0)) for b in range(code.shape[1])], 1) if code.shape[1] else np.zeros((BUCKETS, 0))
    weights = np.clip(weights, -6.0, 6.0)
    # how far each language's own n-grams stand on their side of the bit
    sure = (counts / np.maximum(counts.sum(1, keepdims=True), 1)) @ weights * code
    trust = 1.0 / (1.0 + np.exp(-SHARPNESS * sure.min(0))) if code.shape[1] else np.ones(0)
    model = Model(languages, code, weights, np.maximum(trust, 1e-3))
    if len(languages) < 2:
        return model
    own = np.stack([model.loss(margin) for margin in sure * code])
    return replace(model, gaps=own - np.diag(own)[:, None])


def identify(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, score and ambiguous (replacing columns so named)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for texts in batches:
            yield pd.DataFrame([m.predict(t) for t in texts], columns=["lang_pred", "score", "ambiguous"])

    names = ("lang_pred", "score", "ambiguous")
    own, = free_name(docs, "predicted")
    kept = [c for c in docs.columns if c.lower() not in names]
    out = docs.select(*[docs[f"`{c}`"] for c in kept], predict(docs[text]).alias(own))
    return out.select(*[out[f"`{c}`"] for c in kept], F.col(f"{own}.lang_pred").alias("lang_pred"), F.col(f"{own}.score").alias("score"),
                      F.col(f"{own}.ambiguous").alias("ambiguous"))
