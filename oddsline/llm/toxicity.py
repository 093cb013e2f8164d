"""Op 4. Toxicity by weak supervision.

Voters look at a text and vote toxic, clean or not at all: one lexicon voter
per insult of a small general list, one per word or stem that training labels show
to be telling, and pattern voters (several insults, a high density of them,
insults aimed at a reader, shouted insults, none at all).

A generative label model explains the votes: a hidden class with its prior, and
for every voter its rates of voting toxic and clean in either class, estimated
by expectation maximisation, with training labels as one more, noisy voter
whose rates are estimated too. The words mined from one half of the sample vote
on the other half only. Voters that repeat each other are not independent; their
correlations within the classes are estimated too, and a voter's evidence is
divided by the number of voters it amounts to. The posterior labels of the sample then train a
logistic regression on word and pattern features, in which both classes weigh
alike; it scores every text.

Training reads a bounded sample: the ``SAMPLE`` labelled training documents
with the least hash of their id, whole texts. Held-out documents (crc32 of the
id as text divisible by 5) and their labels are never read in training. Texts
are scored in one pass, from the text alone.

Defined cases: null or empty text is scored (the model's base rate); a null
doc_id is held out; documents with conflicting repeated labels count once per
label; where all labels are of one class they are left out and the label model
is fitted to the seed and pattern voters alone; without any training document
the score is a fixed logistic function of the seed words (``UNTRAINED``);
repeated rows are scored each for itself; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oddsline.llm.common import give_back, lowered, running, segments, span_hashes, spans, tidy

SAMPLE = 6_000    # labelled documents read for training
MINED = 150       # words taken from training labels, at most
MINED_SUPPORT = 4
UNTRAINED = (2.0, -3.0)  # weight of a seed word and bias where there is no training document at all
LABEL_SEEN = 10   # rows that the prior of the label voter's rates counts for

# Insults and slurs against a reader; general words, singular and plain.
SEED = """idiot idiots moron morons stupid imbecile dumb dumbass fool cretin halfwit clown loser losers scum trash garbage vermin
filth filthy worthless pathetic disgusting useless ugly hateful bastard bitch asshole jerk creep pig rat scumbag
lowlife freak psycho retard retarded bullshit crap damn hell shit fuck fucking fucker whore slut
idiota estúpido estúpida imbécil basura asqueroso patético inútil payaso escoria perdedor mierda puta cabrón
idiote stupide imbécile ordure dégoûtant pathétique inutile merde salaud connard connasse putain abruti crétin
dumm dummkopf trottel schwachkopf abschaum müll ekelhaft erbärmlich wertlos versager arschloch scheiße scheisse hure mistkerl""".split()
_READER = "you your u du dein deine dich dir tu toi votre vous tú usted ustedes eres".split()

_IS_LETTER = np.zeros(256, bool)
_IS_LETTER[97:123] = True
_IS_LETTER[128:] = True


PREFIXES = (5, 7)  # bytes; a stem with changing endings is as telling as a word


def letter_words(data: bytes):
    """Over stretches of a buffer: (bytes, starts, ends, hashes of the letter
    runs with A-Z lower-cased, one array of prefix hashes per PREFIXES)."""
    raw, plain = lowered(data), np.frombuffer(data, np.uint8)
    gap = ~_IS_LETTER[raw]
    for a, b in segments(gap):
        part = raw[a:b]
        starts, ends = spans(gap[a:b])
        run, stems = running(part), []
        for k in PREFIXES:
            h = np.zeros(len(starts), np.uint64)
            at = np.flatnonzero(ends - starts > k)
            h[at] = span_hashes(part, starts[at], starts[at] + k, run) ^ np.uint64(k)
            stems.append(h)
        yield a, plain[a:b], starts, ends, span_hashes(part, starts, ends, run), stems


def word_hash(word: str) -> int:
    return int(next(letter_words(word.encode("utf-8")))[4][0])


class Voters:
    """Features of a text: counts of lexicon words and stems, and what patterns need."""

    def __init__(self, mined: list[int]):
        seed = dict.fromkeys(word_hash(w) for w in SEED)
        words = [*seed, *[h for h in mined if h not in seed]]
        self.seeds = len(seed)
        table = np.array(words, np.uint64)
        self.order = np.argsort(table)
        self.table = table[self.order]
        self.reader = np.sort(np.array([word_hash(w) for w in _READER], np.uint64))
        self.words = len(words)

    def _hits(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.table, h), len(self.table) - 1)
        hit = np.flatnonzero(self.table[at] == h)
        return hit, self.order[at[hit]]

    def look(self, texts: list) -> np.ndarray:
        """A row per text: [count per word or stem ..., words, shouted insults, reader words near insults]."""
        out = np.zeros((len(texts), self.words + 3))
        data = [(t or "").encode("utf-8") for t in texts]
        at = 0
        while at < len(data):
            first, size = at, 0
            while at < len(data) and (at == first or size + len(data[at]) < 1 << 20):
                size += len(data[at]) + 1
                at += 1
            self._count(data[first:at], out[first:at])
        return out

    def _count(self, data: list[bytes], out: np.ndarray) -> None:
        begin = np.cumsum([0] + [len(d) + 1 for d in data[:-1]])
        for base, plain, starts, ends, h, stems in letter_words(b"\n".join(data)):
            owner = np.searchsorted(begin, starts + base, side="right") - 1
            out[:, self.words] += np.bincount(owner, minlength=len(out))
            hit, word = self._hits(h)
            np.add.at(out, (owner[hit], word), 1)
            for s in stems:
                np.add.at(out, (owner[(found := self._hits(s))[0]], found[1]), 1)
            insults = hit[word < self.seeds]
            if len(insults):
                upper = [(plain[i] >= 65) & (plain[i] <= 90) for i in (starts[insults], ends[insults] - 1)]
                np.add.at(out[:, self.words + 1], owner[insults], upper[0] & upper[1])
                near = insults[:, None] + np.arange(-3, 4)
                of = np.repeat(owner[insults], 7)
                near = near.ravel()
                ok = (near >= 0) & (near < len(h))
                near, of = near[ok], of[ok]
                spot = np.minimum(np.searchsorted(self.reader, h[near]), len(self.reader) - 1)
                aimed = (self.reader[spot] == h[near]) & (owner[near] == of)
                np.add.at(out[:, self.words + 2], of, aimed)

    def votes(self, x: np.ndarray) -> np.ndarray:
        """Votes of all voters for feature rows: 1 toxic, -1 clean, 0 none."""
        counts, n = x[:, : self.words], np.maximum(x[:, self.words], 1)
        insults = counts[:, : self.seeds].sum(axis=1)
        kinds = (counts[:, : self.seeds] > 0).sum(axis=1)
        lexicon = (counts > 0).astype(np.int8)
        patterns = np.stack([
            np.where(insults >= 2, 1, np.where(insults == 0, -1, 0)),
            np.where(kinds >= 2, 1, 0),
            np.where(insults / n >= 1 / 150, 1, np.where(insults / n < 1 / 5000, -1, 0)),
            np.where(x[:, self.words + 1] >= 1, 1, 0),
            np.where(x[:, self.words + 2] >= 1, 1, 0),
        ], axis=1).astype(np.int8)
        return np.concatenate((lexicon, patterns), axis=1)

    def features(self, x: np.ndarray) -> np.ndarray:
        """Inputs of the classifier."""
        counts, n = x[:, : self.words], np.maximum(x[:, self.words : self.words + 1], 1)
        insults = counts[:, : self.seeds].sum(axis=1, keepdims=True)
        kinds = (counts[:, : self.seeds] > 0).sum(axis=1, keepdims=True)
        rate = np.minimum(insults / n * 100, 5)
        return np.concatenate((np.minimum(np.log1p(counts), 2), np.minimum(np.log1p(insults), 3), np.minimum(kinds, 5) / 2,
                               (insults > 0), rate, np.minimum(x[:, self.words + 1 :], 2)), axis=1)


class LabelModel:
    """Hidden class, its prior, voters' rates per class, and their correlations (EM).

    ``labels`` (0 or 1 a row) are one more voter, which always votes; its rates in
    either class are estimated like the others', with a prior of ``LABEL_SEEN`` rows of
    which nine in ten are right. Without labels the class starts from the votes' majority.
    """

    def __init__(self, votes: np.ndarray, labels: np.ndarray | None = None, rounds: int = 50):
        cast = [(votes == v).astype(float) for v in (1, -1, 0)]
        q = np.where(votes.sum(axis=1, dtype=np.int64) > 0 if labels is None else labels == 1, 0.9, 0.1)
        for step in range(rounds):
            self.prior = float(np.clip(q.mean(), 1e-3, 0.999))
            self.rates = [[(w @ c + k) / (w.sum() + 1) for c, k in zip(cast, (0.3, 0.3, 0.4), strict=True)] for w in (1 - q, q)]
            self.share = self._shares(votes, q) if step >= 2 else np.ones(votes.shape[1])
            z = np.log(self.prior / (1 - self.prior)) + sum(
                c @ (self.share * np.log(in_toxic / in_clean)) for c, in_clean, in_toxic in zip(cast, *self.rates, strict=True))
            if labels is not None:
                self.label_right = tuple((w @ (labels == y) + 0.9 * LABEL_SEEN) / (w.sum() + LABEL_SEEN)
                                         for y, w in ((0, 1 - q), (1, q)))
                clean, toxic = self.label_right
                z += np.where(labels == 1, np.log(toxic / (1 - clean)), np.log((1 - toxic) / clean))
            last, q = q, 1 / (1 + np.exp(-np.clip(z, -30, 30)))
            if step > 2 and np.abs(q - last).max() < 1e-6:
                break
        self.posterior = q

    @staticmethod
    def _shares(votes: np.ndarray, q: np.ndarray) -> np.ndarray:
        """1 / (how many voters a voter's vote amounts to), from correlations within the classes."""
        total = np.zeros((votes.shape[1],) * 2)
        for w in (1 - q, q):
            v = votes - np.average(votes, axis=0, weights=w + 1e-9)
            cov = (v * w[:, None]).T @ v / max(w.sum(), 1e-9)
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            total = np.maximum(total, cov / np.outer(sd, sd) * (np.outer(sd, sd) > 1e-6))
        np.fill_diagonal(total, 1.0)
        return 1 / np.maximum(np.where(total > 0.2, total, 0).sum(axis=1), 1)


def logistic(x: np.ndarray, target: np.ndarray, weight: np.ndarray, penalty: float = 1.0, rounds: int = 40) -> np.ndarray:
    """Weights (the last one the bias) of a penalised logistic regression on
    soft targets of weighted rows, by Newton's method."""
    x = np.concatenate((x, np.ones((len(x), 1))), axis=1)
    w = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-3
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (weight * (p - target)) + ridge * w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + np.diag(ridge), g)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


class Model:
    def __init__(self, voters: Voters, weights: np.ndarray):
        self.voters, self.weights = voters, weights

    def score(self, texts: list) -> np.ndarray:
        x = self.voters.features(self.voters.look(texts))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def _hashes(text: str | None) -> np.ndarray:
    found = [np.concatenate((h, *stems)) for *_, h, stems in letter_words((text or "").encode("utf-8"))]
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.uint64)


def mine(texts: list, labels: np.ndarray, most: int = MINED) -> list[int]:
    """Hashes of words and stems that occur in many more toxic than clean texts."""
    toxic = [_hashes(t) for t, y in zip(texts, labels.tolist(), strict=True) if y]
    if not toxic:
        return []
    n1, n0 = max(len(toxic), 1), max(int((labels == 0).sum()), 1)
    words, k = np.unique(np.concatenate(toxic), return_counts=True)
    often = (k >= max(MINED_SUPPORT, 0.01 * n1)) & (words != 0)
    words, k = words[often], k[often]
    other = np.zeros(len(words), np.int64)  # of these words only: the clean texts' vocabulary is never held
    for t, y in zip(texts, labels.tolist(), strict=True):
        if not y and len(words):
            h = _hashes(t)
            at = np.minimum(np.searchsorted(words, h), len(words) - 1)
            other[at[words[at] == h]] += 1
    odds = np.log((k + 0.5) / (n1 + 1)) - np.log((other + 0.5) / (n0 + 1))
    worth = np.where(odds > 2, odds * np.sqrt(k), 0)
    best = np.lexsort((words, -worth))[:most]
    return [int(w) for w in words[best[worth[best] > 0]]]


def _posteriors(texts: list, labels: np.ndarray) -> np.ndarray:
    """Posterior labels, in two halves: the words that vote on a half are mined from the
    other one, so that they do not repeat the labels they stand beside."""
    half = np.zeros(len(labels), np.int64)
    for y in (0, 1):
        at = np.flatnonzero(labels == y)
        half[at] = np.arange(len(at)) % 2
    out = np.zeros(len(labels))
    for h in (0, 1):
        here, other = np.flatnonzero(half == h), np.flatnonzero(half != h)
        if len(here):
            voters = Voters(mine([texts[i] for i in other], labels[other]))
            out[here] = LabelModel(voters.votes(voters.look([texts[i] for i in here])), labels[here]).posterior
    return out


def train(texts: list, labels) -> Model:
    labels = np.asarray(labels, np.int64)
    distinct = dict.fromkeys(zip(texts, labels.tolist(), strict=True))  # copies would vote many times
    texts, labels = [t for t, _ in distinct], np.array([y for _, y in distinct], np.int64)
    if not texts:
        voters = Voters([])
        w = np.zeros(voters.features(voters.look([""])).shape[1] + 1)
        w[: voters.seeds], w[-1] = UNTRAINED
        return Model(voters, w)
    if len(set(labels.tolist())) < 2:  # such labels tell nothing: the voters alone
        voters = Voters([])
        posterior = LabelModel(voters.votes(voters.look(texts))).posterior
    else:
        voters = Voters(mine(texts, labels))
        posterior = _posteriors(texts, labels)
    share = float(np.clip(posterior.mean(), 1e-3, 0.999))
    weight = 0.5 * (posterior / share + (1 - posterior) / (1 - share))  # the classes weigh alike
    return Model(voters, logistic(voters.features(voters.look(texts)), posterior, weight))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Train on the bounded sample of labelled training documents."""
    some = (labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
            .select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
            .distinct().orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(sample))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
            .join(F.broadcast(some), "doc_id").orderBy("doc_id", "toxic", "text").toPandas())  # at most ``sample`` documents
    model = train(rows["text"].tolist(), rows["toxic"].to_numpy())
    del rows
    give_back()
    return model


def score(docs: DataFrame, model: Model, whole: bool = False) -> DataFrame:
    """doc_id and score of every document; with ``whole`` the document as a
    struct ``doc`` and its score."""
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by the lexicon
    doc_id, text = F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    some = docs.select(F.struct(*docs.columns).alias("doc")) if whole else docs.select(doc_id, text)
    kept = "doc" if whole else "doc_id"
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            texts = b.column("doc").field(at) if whole else b.column("text")
            s = shared.value.score(texts.cast(pa.string()).to_pylist())
            yield pa.RecordBatch.from_arrays([b.column(kept), pa.array(s, pa.float64())], [kept, "score"])

    return some.mapInArrow(tidy(run), T.StructType([some.schema[kept], T.StructField("score", T.DoubleType())]))


def toxicity(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    return score(docs, fit(docs, labels, sample)).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"))
