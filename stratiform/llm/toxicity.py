"""Toxicity as multiple-instance learning: documents are labelled, sentences are scored.

A sentence is toxic with probability ``sigmoid(bias + weights of its distinct words and of their
beginnings)``, as offences share stems in languages that inflect or compound; a document is toxic unless none of its sentences is (noisy-or), with a small leak for labels that no sentence
explains. Weights are learned from document labels alone; the sentence probabilities then say where
the offence lies. A text of very many sentences is as toxic as its worst passage, so that length alone
makes nothing toxic and whatever would be found in a short text is found in a long one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import held_out, smallest_draws, with_own

#: Words, and what ends a sentence.
TOKENS = re.compile(r"[^\W\d_]+|[.!?\n]+")
_ENDS = frozenset(".!?\n")

#: Sentences of a passage at most; fewer if sentences without a word that counts would together reach a share of CALM.
PASSAGE = 400
CALM = 0.2

_FOUND = "array<struct<start:bigint,end:bigint,score:double>>"


def sentences(text: str) -> list[tuple[int, int, list[str]]]:
    """Start, end and lower-cased words of every sentence that holds a word; positions in ``text``."""
    found, start, end, own = [], 0, 0, []
    for match in TOKENS.finditer(text):
        token = match.group()
        if token[0] in _ENDS:
            if own:
                found.append((start, match.end(), own))
                own = []
        else:
            if not own:
                start = match.start()
            own.append(token.lower())
            end = match.end()
    if own:
        found.append((start, end, own))
    return found


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def word_features(word: str) -> list[str]:
    """The word, and its beginnings of 3 to 8 letters, which are marked by a star."""
    return [word, *[f"{word[:size]}*" for size in range(3, min(8, len(word)) + 1)]]


@dataclass
class SentenceModel:
    weights: dict[str, float]  # features of weight zero are left out
    bias: float
    leak: float
    known: dict[str, tuple[str, ...]] = field(default_factory=dict, repr=False)

    def weighted(self, word: str, limit: int = 500_000) -> tuple[str, ...]:
        """The features of a word that have a weight; remembered by word."""
        own = self.known.get(word)
        if own is None:
            if len(self.known) > limit:
                self.known.clear()
            own = self.known[word] = tuple(f for f in word_features(word) if f in self.weights)
        return own

    def sentence_score(self, words: list[str]) -> float:
        features = sorted({f for word in words for f in self.weighted(word)})
        return float(_sigmoid(np.array(self.bias + sum(self.weights[f] for f in features))))

    def offending(self, text: str, least: float) -> list[tuple[int, int, float]]:
        scored = [(start, end, self.sentence_score(own)) for start, end, own in sentences(text)]
        return [s for s in scored if s[2] >= least]

    def scores(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """For every text the probability of its worst passage and that of its worst sentence (0 without a sentence)."""
        plain = float(_sigmoid(np.array(self.bias)))  # a sentence without a word that counts
        calm = float(np.log1p(-plain))
        size = max(1, min(PASSAGE, int(CALM / plain)))
        chances, worst = np.empty(len(texts)), np.zeros(len(texts))
        for row, text in enumerate(texts):
            log_none, own, some = [], [], False
            for token in [*TOKENS.findall(text.lower()), "."] if text else []:
                if token[0] not in _ENDS:
                    some = True
                    if self.weighted(token):
                        own.append(token)
                elif some:
                    if own:
                        chance = self.sentence_score(own)
                        log_none.append(float(np.log1p(-min(chance, 1 - 1e-15))))
                    else:
                        chance = plain
                        log_none.append(calm)
                    worst[row] = max(worst[row], chance)
                    own, some = [], False
            sums = np.cumsum([0.0, *log_none])
            passage = min(size, len(log_none))
            chances[row] = -np.expm1(np.log1p(-self.leak) + (sums[passage:] - sums[: len(sums) - passage]).min())
        return np.clip(chances, 0.0, 1.0), worst


def fit(
    texts: list[str], toxic: list[int], least_texts: int = 4, lift: float = 2.0, epochs: int = 60, rate: float = 0.4, sparsity: float = 5e-5,
    leak: float = 0.02, bias: float = -7.0, batch: int = 64, seed: int = 3,
) -> SentenceModel:
    """Minimize the noisy-or loss by Adagrad with soft thresholding, which leaves few words a weight.

    Features take part that at least ``least_texts`` distinct texts have and whose texts are toxic at
    least ``lift`` times as often as all are.
    """
    types: dict[str, int] = {}  # words are held once, and by number in the texts
    bags = [[np.unique([types.setdefault(w, len(types)) for w in own]) for _, _, own in sentences(t)] for t in texts]
    names: dict[str, int] = {}
    of_type = [np.array([names.setdefault(f, len(names)) for f in word_features(w)]) for w in types]
    held, bad, seen = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64), {}
    for text, own, label in zip(texts, bags, toxic, strict=True):
        if own and text not in seen:  # copies of a text are no further evidence
            features = np.unique(np.concatenate([of_type[t] for t in np.unique(np.concatenate(own))]))
            held[features] += 1
            bad[features] += label
        seen[text] = label
    usual = sum(seen.values()) / max(1, len(seen))
    taken = np.flatnonzero((held >= least_texts) & (bad > 0) & (bad >= lift * usual * held))
    spelled = list(names)
    chosen = sorted(spelled[f] for f in taken)
    number = {f: i for i, f in enumerate(chosen)}
    place = np.full(len(names), -1)
    for f in taken:
        place[f] = number[spelled[f]]
    of_type = [(p := place[f])[p >= 0] for f in of_type]
    nothing = np.zeros(0, np.int64)
    coded = [[np.unique(np.concatenate([nothing, *[of_type[t] for t in s]])) for s in own] for own in bags]
    labels, rng = np.array(toxic, float), np.random.default_rng(seed)
    weights, squares = np.zeros(len(number)), np.full(len(number), 1e-3)
    bias_square = 1e-3
    for epoch in range(epochs):
        order = rng.permutation(len(texts))
        for low in range(0, len(order), batch):
            rows = order[low : low + batch]
            parts = [s for r in rows for s in coded[r]]
            if not parts:
                continue
            owner = np.repeat(np.arange(len(rows)), [len(coded[r]) for r in rows])
            spans = np.array([len(s) for s in parts])
            flat, sentence = np.concatenate(parts), np.repeat(np.arange(len(parts)), spans)
            chance = _sigmoid(bias + np.bincount(sentence, weights[flat], len(parts)))
            log_none = np.bincount(owner, np.log1p(-np.minimum(chance, 1 - 1e-12)), len(rows)) + np.log1p(-leak)
            none = np.exp(log_none)
            pull = np.where(labels[rows] > 0, -none / np.maximum(1 - none, 1e-9), 1.0)
            slope = pull[owner] * chance / len(rows)
            by_word = np.bincount(flat, slope[sentence], len(number))
            squares += by_word**2
            step = rate / np.sqrt(squares)
            moved = weights - step * by_word
            weights = np.sign(moved) * np.maximum(np.abs(moved) - step * sparsity, 0)
            bias_square += slope.sum() ** 2
            bias -= rate * slope.sum() / np.sqrt(bias_square)
    return SentenceModel({w: float(weights[i]) for w, i in number.items() if weights[i] != 0}, float(bias), leak)


def train(docs: DataFrame, labels: DataFrame, per_label: int = 1500, max_chars: int = 20_000) -> SentenceModel:
    """Fit on at most ``per_label`` labelled texts of each label, picked by hash of their ``doc_id``.

    Rows that are held out, null texts and null labels are not learned from. Of a clean text longer than
    ``max_chars`` a part of that length is, at a place picked by hash, as each part of it is clean; a longer
    toxic one is left out, as the offence may lie elsewhere. A document with several labels counts as toxic
    if any of them says so.
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
    known = known.groupBy("doc_id").agg((F.max("toxic") > 0).cast("int").alias("toxic"))
    picked = smallest_draws(known.withColumn("draw", F.xxhash64("doc_id")), "toxic", per_label).select("doc_id", "toxic")
    usable = docs.where(F.col("text").isNotNull()).select("doc_id", "text")
    # At most 2 * per_label rows of two numbers are sent out.
    rows = usable.join(F.broadcast(picked), "doc_id").where((F.length("text") <= max_chars) | (F.col("toxic") == 0))
    part = F.substring("text", (F.pmod(F.xxhash64("doc_id"), F.greatest(F.length("text") - max_chars, F.lit(0)) + 1) + 1).cast("int"), F.lit(max_chars))
    rows = rows.select("doc_id", part.alias("text"), "toxic").distinct().limit(4 * per_label).collect()
    rows.sort(key=lambda r: (r["doc_id"], r["text"]))
    return fit([r["text"] for r in rows], [r["toxic"] for r in rows])


def score_toxicity(docs: DataFrame, model: SentenceModel, least: float = 0.5) -> DataFrame:
    """Add ``score``, ``predicted``, ``worst_sentence`` and ``offending`` to every row.

    ``score`` is the probability that the document's worst passage is toxic, ``predicted`` whether it reaches 0.5,
    ``worst_sentence`` the highest probability of a sentence, ``offending`` the sentences that reach
    ``least`` as (start, end, score) in code points, in order. Null texts and texts without words have
    no sentence and get the leak as score. Extra columns stay; ones named like an own column give way.
    Repeated rows get equal results, an empty table an empty one. Nothing is shuffled.
    """

    def score(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            texts = batch.column("text").to_pylist()
            chances, worst = model.scores(texts)
            found = [
                [dict(zip(("start", "end", "score"), s, strict=True)) for s in model.offending(t, least)] if w >= least else []
                for t, w in zip(texts, worst, strict=True)
            ]
            kept = [batch.column(i) for i in range(batch.num_columns - 4)]
            own = [
                pa.array(chances), pa.array((chances >= 0.5).astype(np.int32)), pa.array(worst),
                pa.array(found, batch.schema.field("offending").type),
            ]
            yield pa.RecordBatch.from_arrays([*kept, *own], batch.schema.names)

    own = with_own(
        docs, score=F.lit(0.0), predicted=F.lit(0), worst_sentence=F.lit(0.0), offending=F.array().cast(_FOUND)
    )
    return own.mapInArrow(score, own.schema)
