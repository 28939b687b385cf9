"""Toxic spans by a linear-chain conditional random field, and document scores from them (operator 11).

Labels are of documents, so tokens are labelled first: a word, or a beginning of words, is evidence
if it stands in toxic documents so much more often than its share allows that chance is excluded
for all candidates together; it counts once per document and once per pair of neighbours, so that
neither a copied text nor one long text makes evidence. A toxic document's tokens with evidence are
labelled toxic, all other tokens are not. The field has the labels clean and toxic, features of the
word (itself, its beginnings and endings) and of both neighbours, hashed into a table, and weights
for each pair of labels; it is fitted by gradient ascent on the likelihood of labelled chains.
Forward-backward gives each token's marginal. A document's score is a logistic function, fitted on
the same sample, of its largest marginal and of how many toxic tokens it is expected to have;
tokens of a marginal of one half and more are the offending spans.

Fitted on a bounded sample: SAMPLE_TOXIC and SAMPLE_CLEAN labelled rows at most, of LONGEST bytes at
most, taken in the order of a hash of the key. Every text is scored whole, in slices of whole texts;
the chain of one text is cut nowhere.

Null and empty texts and those without a letter have no spans and the score of a text without
evidence. Without labels of both kinds, or without evidence, all scores are 0. A key with several
labels is toxic if one is; labels other than 0 and 1 are ignored. Repeated rows are scored each; a
key with several texts gives one of them to the sample. A null key is held out. Offsets count code
points. Extra columns of any name are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import picked

SAMPLE_TOXIC, SAMPLE_CLEAN, LONGEST = 1000, 3000, 50_000
CHAIN = 16  # tokens of a chain that is learned from
CHAINS = 8_000  # of each kind: with a toxic token, without
BUCKETS = 1 << 16
ROUNDS, RATE, SHRINK = 80, 0.2, 2e-7
DOUBT = 0.01  # chance of one piece of false evidence at all
LEAST_SHARE = 0.8  # of an evidence's occurrences that are in toxic documents
STEMS = (4, 5, 6)  # beginnings of words that may be evidence
SLICE_CHARS = 1 << 20
BLOCK = 128
MEMO_WORDS = 200_000
FLOOR = -20.0

_WORD = regex.compile(r"\p{L}[\p{L}\p{M}]*")
SPAN = pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32()), ("score", pa.float64())]))


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


def _bucket(name: str) -> int:
    return zlib.crc32(name.encode("utf-8", "surrogatepass")) % BUCKETS


def word_features(word: str) -> list[int]:
    """Buckets of the word, its beginnings of 2 to 5 characters and its endings of 2 and 3."""
    return [_bucket("=" + word), *(_bucket("^" + word[:k]) for k in (2, 3, 4, 5)), *(_bucket("$" + word[-k:]) for k in (2, 3))]


def _left(word: str) -> int:
    return _bucket("<" + word)


def _right(word: str) -> int:
    return _bucket(">" + word)


@dataclass
class Field:
    """The fitted model: feature weights for toxic, label-pair weights, and the logistic function."""

    weights: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS))
    bias: float = 0.0
    pairs: np.ndarray = field(default_factory=lambda: np.zeros((2, 2)))
    logistic: np.ndarray | None = None  # constant, largest marginal's log-odds, expected number


def marginals(scores: np.ndarray, begins: np.ndarray, bias: float, pairs: np.ndarray) -> np.ndarray:
    """Each token's probability of toxic in chains put one after the other.

    ``scores`` are the tokens' own weights, ``begins`` tells where a chain begins. Forward and
    backward products of 2x2 matrices are taken in blocks of BLOCK tokens at once, then carried
    from block to block.
    """
    n = len(scores)
    if n == 0:
        return np.zeros(0)
    blocks = -(-n // BLOCK)
    shape = (blocks, BLOCK)
    own = np.zeros(blocks * BLOCK)
    own[:n] = np.clip(scores + bias, -30, 30)
    first = np.ones(blocks * BLOCK, bool)  # what fills up the last block are chains of their own
    first[:n] = begins
    weight = np.exp(pairs - pairs.max())
    emit = np.exp(own)
    m = np.empty((4, blocks * BLOCK))  # from clean to clean, clean to toxic, toxic to clean, toxic to toxic
    for i in (0, 1):
        m[2 * i] = np.where(first, 1.0, weight[i, 0])
        m[2 * i + 1] = np.where(first, 1.0, weight[i, 1]) * emit
    m /= np.maximum(1.0, emit)
    m = m.reshape(4, *shape)
    ahead, behind = np.empty_like(m), np.empty_like(m)
    ahead[:, :, 0] = m[:, :, 0]
    behind[:, :, -1] = np.array([1.0, 0.0, 0.0, 1.0])[:, None]
    for j in range(1, BLOCK):
        ahead[:, :, j] = _product(ahead[:, :, j - 1], m[:, :, j])
        behind[:, :, -1 - j] = _product(m[:, :, BLOCK - j], behind[:, :, BLOCK - j])
    before, after = np.empty((2, blocks)), np.empty((2, blocks))
    whole = ahead[:, :, -1].T.tolist()
    x, y = 0.5, 0.5
    for k, (a, b, c, d) in enumerate(whole):
        before[0, k], before[1, k] = x, y
        x, y = x * a + y * c, x * b + y * d
        x, y = x / (x + y), y / (x + y)
    x, y = 0.5, 0.5
    for k in range(blocks - 1, -1, -1):
        after[0, k], after[1, k] = x, y
        a, b, c, d = whole[k]
        x, y = a * x + b * y, c * x + d * y
        x, y = x / (x + y), y / (x + y)
    before, after = before[:, :, None], after[:, :, None]
    clean = (before[0] * ahead[0] + before[1] * ahead[2]) * (behind[0] * after[0] + behind[1] * after[1])
    toxic = (before[0] * ahead[1] + before[1] * ahead[3]) * (behind[2] * after[0] + behind[3] * after[1])
    return (toxic / (clean + toxic)).reshape(-1)[:n]


def _product(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Products of 2x2 matrices held as four rows, scaled to a largest entry of 1."""
    out = np.stack([p[0] * q[0] + p[1] * q[2], p[0] * q[1] + p[1] * q[3], p[2] * q[0] + p[3] * q[2], p[2] * q[1] + p[3] * q[3]])
    return out / out.max(axis=0)


def _distinct(feature: np.ndarray, of: np.ndarray, n: int) -> np.ndarray:
    """How many different values of ``of`` each of n features has."""
    order = np.lexsort((of, feature))
    a, b = feature[order], of[order]
    new = np.ones(len(a), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return np.bincount(a[new], minlength=n)


def _evident(feature: np.ndarray, doc: np.ndarray, near: np.ndarray, toxic: np.ndarray, n: int) -> np.ndarray:
    """Which of n features is evidence: its toxic count against the share of toxic tokens."""
    hit = np.minimum(_distinct(feature[toxic], doc[toxic], n), _distinct(feature[toxic], near[toxic], n)).astype(float)
    miss = np.maximum(_distinct(feature[~toxic], doc[~toxic], n), _distinct(feature[~toxic], near[~toxic], n)).astype(float)
    base = toxic.mean()
    every = np.maximum(hit + miss, 1)
    share = hit / every
    with np.errstate(divide="ignore", invalid="ignore"):
        far = hit * np.log(share / base) + np.where(miss > 0, miss * np.log((1 - share) / (1 - base)), 0)
    candidates = max(1, int((hit >= 2).sum()))
    return (hit >= 2) & (share >= max(LEAST_SHARE, base)) & (far >= np.log(candidates / DOUBT))


class _Sample:
    """Tokens of the labelled texts as numbers."""

    def __init__(self, texts: list[str | None], labels: list[int]):
        split = [words_of(t) for t in texts]
        self.known: dict[str, int] = {"": 0}
        ids = [[self.known.setdefault(w, len(self.known)) for w in words] for words in split]
        self.names = list(self.known)
        self.size = np.array([len(x) for x in ids], np.int64)
        self.word = np.array([w for x in ids for w in x], np.int64)
        self.doc = np.repeat(np.arange(len(ids)), self.size)
        self.label = np.array(labels, bool)
        n = len(self.word)
        self.begins = np.ones(n, bool)
        self.begins[1:] = self.doc[1:] != self.doc[:-1]
        self.left, self.right = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.left[1:] = np.where(self.begins[1:], 0, self.word[:-1])
        self.right[:-1] = np.where(self.begins[1:], 0, self.word[1:])

    def tokens(self) -> np.ndarray:
        """The tokens' labels."""
        toxic = self.label[self.doc]
        if not toxic.any() or toxic.all():
            return np.zeros(len(self.word), bool)
        near = self.left * len(self.names) + self.right
        found = _evident(self.word, self.doc, near, toxic, len(self.names))
        for k in STEMS:
            stems: dict[str, int] = {"": 0}
            stem = np.array([stems.setdefault(w[:k] if len(w) > k else "", len(stems)) for w in self.names])
            good = _evident(stem[self.word], self.doc, near, toxic, len(stems))
            good[0] = False
            found |= good[stem]
        return toxic & found[self.word]

    def features(self) -> np.ndarray:
        """One row of buckets a token."""
        own = np.array([word_features(w) for w in self.names])
        left = np.array([_left(w) for w in self.names])
        right = np.array([_right(w) for w in self.names])
        return np.column_stack([own[self.word], left[self.left], right[self.right]]).astype(np.int32)


def _chains(sample: _Sample, label: np.ndarray) -> np.ndarray:
    """Where the learned chains begin: CHAIN tokens of one text; spread over what there is of a kind."""
    inside = np.arange(len(label)) - np.flatnonzero(sample.begins)[np.cumsum(sample.begins) - 1]
    starts = np.flatnonzero(inside % CHAIN == 0)
    toxic = np.add.reduceat(label, starts) > 0 if len(starts) else np.zeros(0, bool)
    kept = [s[np.linspace(0, len(s) - 1, min(len(s), CHAINS)).astype(np.int64)] for s in (starts[toxic], starts[~toxic])]
    return np.sort(np.concatenate(kept))


def _fit_field(sample: _Sample, label: np.ndarray) -> Field:
    """Gradient ascent (Adam) on the mean log-likelihood of the chains, all of them at once."""
    starts = _chains(sample, label)
    ends = np.append(np.flatnonzero(sample.begins), len(label))
    stop = np.minimum(starts + CHAIN, ends[np.searchsorted(ends, starts, side="right")])
    at = starts[:, None] + np.arange(CHAIN)
    real = at < stop[:, None]
    at = np.where(real, at, 0)
    x = sample.features()[at.reshape(-1)]
    y = (label[at] & real).astype(float)
    mask = real.astype(float)
    model = Field()
    theta = np.zeros(BUCKETS + 5)  # features, bias, pairs
    one, two = np.zeros_like(theta), np.zeros_like(theta)
    flat = x.reshape(-1)
    total = mask.sum()
    link = mask[:, 1:]  # tokens with a predecessor in their chain
    seen = [((y[:, :-1] == a) * (y[:, 1:] == b) * link).sum() for a in (0, 1) for b in (0, 1)]
    for step in range(1, ROUNDS + 1):
        pairs = theta[BUCKETS + 1 :].reshape(2, 2)
        score = theta[x].sum(axis=1).reshape(at.shape) + theta[BUCKETS]
        marginal, expected = _chain_marginals(score, pairs, mask)
        off = (y - marginal) * mask
        grad = np.zeros_like(theta)
        grad[:BUCKETS] = np.bincount(flat, np.repeat(off.reshape(-1), x.shape[1]), minlength=BUCKETS)
        grad[BUCKETS] = off.sum()
        grad[BUCKETS + 1 :] = np.array(seen) - expected
        grad = grad / total - SHRINK * theta
        one = 0.9 * one + 0.1 * grad
        two = 0.99 * two + 0.01 * grad**2
        theta += RATE * (one / (1 - 0.9**step)) / (np.sqrt(two / (1 - 0.99**step)) + 1e-9)
    model.weights, model.bias, model.pairs = theta[:BUCKETS], float(theta[BUCKETS]), theta[BUCKETS + 1 :].reshape(2, 2).copy()
    return model


def _chain_marginals(score: np.ndarray, pairs: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of toxic and expected label pairs of many short chains side by side."""
    n, size = score.shape
    weight = np.exp(pairs - pairs.max())
    emit = np.stack([np.ones_like(score), np.exp(np.clip(score, -30, 30))], axis=2)
    ahead, behind = np.empty((n, size, 2)), np.ones((n, size, 2))
    ahead[:, 0] = emit[:, 0]
    ahead[:, 0] /= ahead[:, 0].sum(axis=1, keepdims=True)
    for j in range(1, size):
        new = (ahead[:, j - 1] @ weight) * emit[:, j]
        ahead[:, j] = new / new.sum(axis=1, keepdims=True)
    for j in range(size - 2, -1, -1):
        new = (behind[:, j + 1] * emit[:, j + 1]) @ weight.T
        behind[:, j] = np.where(mask[:, j + 1, None] > 0, new / new.sum(axis=1, keepdims=True), 1.0)
    both = ahead * behind
    both /= both.sum(axis=2, keepdims=True)
    joint = ahead[:, :-1, :, None] * weight * (emit[:, 1:] * behind[:, 1:])[:, :, None, :]
    joint /= joint.sum(axis=(2, 3), keepdims=True)
    return both[:, :, 1], (joint * mask[:, 1:, None, None]).sum(axis=(0, 1)).reshape(4)


def _signs(marginal: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Per text: 1, the log-odds of its largest marginal, log(1 + expected toxic tokens)."""
    best, many = np.zeros(len(size)), np.zeros(len(size))
    full = size > 0
    if full.any():
        at = first[full]
        best[full] = np.maximum.reduceat(marginal, at)
        many[full] = np.add.reduceat(marginal, at)
    best = np.clip(best, 1e-9, 1 - 1e-9)
    odds = np.maximum(np.log(best / (1 - best)), FLOOR)
    return np.column_stack([np.ones(len(size)), odds / 5, np.log1p(many)])


def _fit_logistic(signs: np.ndarray, label: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Weighted logistic regression by Newton's method, slightly shrunk."""
    w = np.zeros(signs.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(signs @ w, -30, 30)))
        grad = signs.T @ (weight * (label - p)) - 0.1 * w
        curve = (signs * (weight * p * (1 - p))[:, None]).T @ signs + 0.1 * np.eye(len(w))
        w += np.linalg.solve(curve, grad)
    return w


def fit(texts: list[str | None], labels: list[int], toxic_share: float | None = None) -> Field:
    """The field of some labelled texts; ``toxic_share`` is that of all texts, if these aren't drawn evenly."""
    sample = _Sample(texts, labels)
    label = sample.tokens()
    if not label.any():
        return Field()
    model = _fit_field(sample, label)
    own = model.weights[sample.features()].sum(axis=1)
    first = np.concatenate([[0], np.cumsum(sample.size)[:-1]])
    signs = _signs(marginals(own, sample.begins, model.bias, model.pairs), first, sample.size)
    share = sample.label.mean()
    toxic = share if toxic_share is None else min(max(toxic_share, 1e-6), 1 - 1e-6)
    weight = np.where(sample.label, toxic / share, (1 - toxic) / (1 - share))
    model.logistic = _fit_logistic(signs, sample.label, weight)
    return model


class Scorer:
    """Scores and spans of texts; remembers the weights of the words it meets first."""

    def __init__(self, model: Field):
        self.model = model
        self.memo: dict[str, tuple[float, float, float]] = {}

    def _of(self, word: str) -> tuple[float, float, float]:
        got = self.memo.get(word)
        if got is None:
            w = self.model.weights
            got = (float(w[word_features(word)].sum()), float(w[_left(word)]), float(w[_right(word)]))
            if len(self.memo) < MEMO_WORDS:
                self.memo[word] = got
        return got

    def score(self, texts: list[str | None]) -> tuple[np.ndarray, list[list[tuple[int, int, float]]]]:
        if self.model.logistic is None:
            return np.zeros(len(texts)), [[] for _ in texts]
        split = [words_of(t) for t in texts]
        size = np.array([len(x) for x in split], np.int64)
        first = np.concatenate([[0], np.cumsum(size)[:-1]])
        coded = pa.array([w for x in split for w in x], pa.string()).dictionary_encode()
        at = coded.indices.to_numpy()
        own, left, right = np.array([self._of(w) for w in coded.dictionary.to_pylist()]).reshape(-1, 3).T
        edge_left, edge_right = self.model.weights[_left("")], self.model.weights[_right("")]
        begins = np.zeros(len(at), bool)
        begins[first[size > 0]] = True
        total = own[at]
        before, after = np.full(len(at), edge_left), np.full(len(at), edge_right)
        before[1:] = np.where(begins[1:], edge_left, left[at[:-1]])
        after[:-1] = np.where(begins[1:], edge_right, right[at[1:]])
        p = marginals(total + before + after, begins, self.model.bias, self.model.pairs)
        z = _signs(p, first, size) @ self.model.logistic
        return 1 / (1 + np.exp(-np.clip(z, -30, 30))), [self._spans(t, p[a : a + n]) for t, a, n in zip(texts, first, size)]

    def _spans(self, text: str | None, p: np.ndarray) -> list[tuple[int, int, float]]:
        """Runs of tokens of one half and more, by their places in the text."""
        if not len(p) or p.max() < 0.5:
            return []
        out: list[tuple[int, int, float]] = []
        low = text.lower()
        # Lower case can be longer than the text: then a place is found by lower-casing what is before it.
        place = [0]
        if len(low) != len(text):
            for c in text:
                place.append(place[-1] + len(c.lower()))
        last = -2
        for i, m in enumerate(_WORD.finditer(low)):
            if p[i] < 0.5:
                continue
            a, b = m.span()
            if len(place) > 1:
                a, b = int(np.searchsorted(place, a, side="right")) - 1, int(np.searchsorted(place, b))
            if last == i - 1:
                out[-1] = (out[-1][0], b, max(out[-1][2], float(p[i])))
            else:
                out.append((a, b, float(p[i])))
            last = i
        return out


def _score(model: Field):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(model)
        for batch in batches:
            lo = 0
            texts = batch.column(2)
            while lo < batch.num_rows:
                part: list[str | None] = []
                size = 0
                while lo + len(part) < batch.num_rows and size < SLICE_CHARS:
                    part.append(texts[lo + len(part)].as_py())
                    size += len(part[-1] or "")
                score, spans = scorer.score(part)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, len(part)),
                        batch.column(1).slice(lo, len(part)),
                        pa.array(score, pa.float64()),
                        pa.array((score >= 0.5).astype(np.int32)),
                        pa.array([[dict(zip(("start", "stop", "score"), s)) for s in x] for x in spans], SPAN),
                    ],
                    names=["k", "held_out", "score", "predicted", "spans"],
                )
                lo += len(part)

    return run


def learn(rows: DataFrame, labels: DataFrame) -> Field:
    """The field of a bounded sample of ``rows`` (k, t) labelled by ``labels`` (k, toxic)."""
    labelled = labels.filter("toxic IN (0, 1) AND k IS NOT NULL").groupBy("k").agg(F.max("toxic").alias("toxic"))
    share = labelled.agg(F.avg("toxic")).first()[0]
    if share is None or share in (0.0, 1.0):
        return Field()
    fit_rows = rows.filter(F.octet_length("t") <= LONGEST).filter("t <> ''")
    by_hash = Window.partitionBy("toxic").orderBy(F.xxhash64("k"), "k")
    usable = fit_rows.select("k").distinct().join(labelled, "k").withColumn("place", F.row_number().over(by_hash))
    most = F.when(F.col("toxic") == 1, SAMPLE_TOXIC).otherwise(SAMPLE_CLEAN)
    drawn = usable.filter(F.col("place") <= max(SAMPLE_TOXIC, SAMPLE_CLEAN)).filter(F.col("place") <= most).select("k", "toxic")
    one_text = Window.partitionBy("k").orderBy("t")
    sample = fit_rows.join(F.broadcast(drawn), "k").withColumn("nth", F.row_number().over(one_text)).filter("nth = 1")
    found = sample.orderBy(F.xxhash64("k"), "k").select("t", "toxic").toArrow()
    return fit(found["t"].to_pylist(), found["toxic"].to_pylist(), float(share))


def toxicity(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label_key: str = "doc_id", label: str = "toxic", folds: int = 5
) -> DataFrame:
    """Per row of ``docs``: ``key, held_out, score, predicted, spans`` (start, stop, score).

    Rows whose crc32 of the key as text is 0 modulo ``folds`` are held out: nothing is learned from
    them. Scores read the text alone.
    """
    held_out = F.coalesce(F.crc32(F.col("k").cast("string")) % folds == 0, F.lit(True))
    rows = picked(docs, {"k": key, "t": text}).select("k", held_out.alias("held_out"), F.col("t").cast("string").alias("t"))
    known = picked(labels, {"k": label_key, "toxic": label}).filter(~held_out)
    model = learn(rows.filter("NOT held_out").select("k", "t"), known)
    kind = dict(rows.dtypes)["k"]
    schema = f"k {kind}, held_out boolean, score double, predicted int, spans array<struct<start:int,stop:int,score:double>>"
    return rows.mapInArrow(_score(model), schema).withColumnRenamed("k", key)
