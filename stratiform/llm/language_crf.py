"""Language identification of code-switched text by a linear-chain conditional random field.

Every word of a text is labelled. Emissions come from character n-grams with word boundaries (those at
the boundaries are the affixes), the word itself and a lexicon of words that nearly always carry one
label in the training sample; transitions between labels are learned. Forward-backward gives each
word's label probabilities, whatever the length of the text; their mean decides the document.

The model is fitted on a bounded sample of labelled rows (``per_label`` texts of each label, at most
``max_chars`` long), to which runs of other labels are spliced so that switches are seen. It is then
applied to every whole text in Arrow batches; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratiform.llm.common import held_out, mix, smallest_draws, with_own

LETTERS = re.compile(r"[^\W\d_]+")
UNKNOWN = "und"
_OPEN, _CLOSE = "\x02", "\x03"
_SALT = np.uint64(0x9E3779B97F4A7C15)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def word_features(types: list[str], bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers with the type each belongs to, and a 64-bit hash of every type."""
    chars = np.frombuffer("".join(f"{_OPEN}{t}{_CLOSE}" for t in types).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    first = chars == ord(_OPEN)
    owner, starts = np.cumsum(first) - 1, np.flatnonzero(first)
    place = (np.arange(len(chars)) - starts[owner]).astype(np.uint64)
    whole = mix(np.add.reduceat(mix(chars + (place << np.uint64(32))), starts))
    grams, owners = [mix(whole + np.uint64(1))], [np.arange(len(types))]
    rolled, inside, last = chars, np.ones(len(chars), bool), chars == ord(_CLOSE)
    for size in (2, 3, 4):
        rolled = mix(rolled[: len(chars) - size + 1] * _SALT + chars[size - 1 :])
        inside = inside[: len(chars) - size + 1] & ~first[size - 1 :]
        # Runs of two and three everywhere; of four only at the ends of the word: affixes of three.
        wanted = inside if size < 4 else inside & (first[: len(inside)] | last[3:])
        at = np.flatnonzero(wanted)
        grams.append(rolled[at])
        owners.append(owner[at])
    return (np.concatenate(grams) & np.uint64(2**bits - 1)).astype(np.int64), np.concatenate(owners), whole


@dataclass
class LanguageCrf:
    labels: list[str]
    bits: int
    weights: np.ndarray  # (2**bits + labels) x labels: hashed features, then a lexicon feature per label
    start: np.ndarray
    moves: np.ndarray
    lexicon: np.ndarray  # sorted word hashes
    lexicon_label: np.ndarray
    known: dict[str, int] = field(default_factory=dict, repr=False)
    scores: np.ndarray | None = field(default=None, repr=False)

    def features(self, types: list[str]) -> tuple[np.ndarray, np.ndarray]:
        numbers, owner, whole = word_features(types, self.bits)
        if len(self.lexicon):
            at = np.minimum(np.searchsorted(self.lexicon, whole), len(self.lexicon) - 1)
            hit = np.flatnonzero(self.lexicon[at] == whole)
            numbers = np.concatenate([numbers, 2**self.bits + self.lexicon_label[at[hit]]])
            owner = np.concatenate([owner, hit])
        return numbers, owner

    def emissions(self, tokens: list[str], limit: int = 300_000) -> np.ndarray:
        """Score of every label for every word; scores of word types are remembered."""
        missing = list(set(tokens).difference(self.known))
        if missing:
            if len(self.known) > limit:
                self.known, self.scores = {}, None
                missing = list(set(tokens))
            parts = [self.scores] if self.scores is not None else []
            for low in range(0, len(missing), 20_000):
                some = missing[low : low + 20_000]
                numbers, owner = self.features(some)
                parts.append(np.stack([np.bincount(owner, w[numbers], len(some)) for w in self.weights.T], 1).astype(np.float32))
            for token in missing:
                self.known[token] = len(self.known)
            self.scores = np.concatenate(parts)
        return self.scores[np.fromiter(map(self.known.__getitem__, tokens), np.int64, len(tokens))]

    def posteriors(self, emissions: np.ndarray, lengths: np.ndarray, block: int = 32) -> np.ndarray:
        """Label probabilities of every word by forward-backward; texts lie one after another.

        Texts are cut into blocks. The blocks' transfer matrices are multiplied within all blocks at
        once, then messages go from block to block, then through all blocks at once: the same result
        as word by word, in few array operations.
        """
        size = len(self.labels)
        factors = np.exp(emissions - emissions.max(1, keepdims=True)).astype(np.float64)
        blocks = -(-lengths // block)
        first_block, first_word = np.cumsum(blocks) - blocks, np.cumsum(lengths) - lengths
        word = np.arange(len(emissions))
        text = np.repeat(np.arange(len(lengths)), lengths)
        inside = word - first_word[text]
        lane, step = first_block[text] + inside // block, inside % block
        count = int(blocks.sum())
        psi = np.ones((count, block, size))
        psi[lane, step] = factors
        real = np.zeros((count, block), bool)
        real[lane, step] = True
        opens = np.zeros(count, bool)
        opens[first_block] = True
        moves, start = np.exp(self.moves), np.exp(self.start)

        def matrices(at: int) -> np.ndarray:
            """Transfer into step ``at`` of every block; an identity beyond a text's end."""
            out = moves * psi[:, at, None, :]
            if at == 0:
                out[opens] = start * psi[opens, 0, None, :]
            out[~real[:, at]] = np.eye(size)
            return out

        product = matrices(0)
        for at in range(1, block):
            product = product @ matrices(at)
            product /= product.sum((1, 2), keepdims=True)
        ahead, behind = np.full((count, size), 1.0 / size), np.full((count, size), 1.0 / size)
        order = np.argsort(-blocks, kind="stable")
        sorted_blocks = blocks[order]
        for nth in range(1, int(blocks.max(initial=0))):
            longer = order[: np.searchsorted(-sorted_blocks, -nth)]  # texts with a block after this one
            at = first_block[longer] + nth
            message = np.einsum("bi,bij->bj", ahead[at - 1], product[at - 1])
            ahead[at] = message / message.sum(1, keepdims=True)
            at = first_block[longer] + blocks[longer] - 1 - nth
            message = np.einsum("bij,bj->bi", product[at + 1], behind[at + 1])
            behind[at] = message / message.sum(1, keepdims=True)
        forward, message = np.empty((count, block, size)), ahead
        for at in range(block):
            new = np.where(real[:, at, None], (message @ moves) * psi[:, at], message)
            if at == 0:
                new[opens] = start * psi[opens, 0]
            message = new / new.sum(1, keepdims=True)
            forward[:, at] = message
        message = behind
        for at in range(block - 1, -1, -1):
            forward[:, at] *= message
            new = np.where(real[:, at, None], (psi[:, at] * message) @ moves.T, message)
            message = new / new.sum(1, keepdims=True)
        result = forward[lane, step]
        return result / result.sum(1, keepdims=True)

    def label_texts(self, texts: list[str | None], words_at_once: int = 150_000) -> tuple[list[str], list[float]]:
        return self.judged_texts(texts, words_at_once)[:2]

    def judged_texts(self, texts: list[str | None], words_at_once: int = 150_000) -> tuple[list[str], list[float], list[float]]:
        """Label and score of every text, and the mean over its words of their likeliest label's probability."""
        names, scores, sure = [UNKNOWN] * len(texts), [0.0] * len(texts), [0.0] * len(texts)
        tokens: list[str] = []
        rows: list[int] = []
        lengths: list[int] = []

        def flush() -> None:
            if rows:
                chances = self.posteriors(self.emissions(tokens), np.array(lengths))
                starts = np.cumsum([0, *lengths[:-1]])
                share = np.add.reduceat(chances, starts, axis=0) / np.array(lengths)[:, None]
                best = np.add.reduceat(chances.max(1), starts) / np.array(lengths)
                for row, own, mean in zip(rows, share, best, strict=True):
                    names[row], scores[row], sure[row] = self.labels[int(own.argmax())], float(min(1.0, own.max())), float(min(1.0, mean))
            tokens.clear(), rows.clear(), lengths.clear()

        for row, text in enumerate(texts):
            found = LETTERS.findall(text.lower()) if text and self.labels else []
            if found and (found[0].isalpha() or has_letter(text)):
                tokens.extend(found)
                rows.append(row)
                lengths.append(len(found))
                if len(tokens) >= words_at_once:
                    flush()
        flush()
        return names, scores, sure

    def label_words(self, text: str) -> list[tuple[str, str, float]]:
        """Every word with its likeliest label and that label's probability."""
        found = LETTERS.findall(text.lower())
        if not found or not self.labels:
            return []
        chances = self.posteriors(self.emissions(found), np.array([len(found)]))
        return [(w, self.labels[int(p.argmax())], float(p.max())) for w, p in zip(found, chances, strict=True)]


def fit(
    texts: list[str], names: list[str], bits: int = 16, chunk: int = 48, epochs: int = 3, batch: int = 48, rate: float = 0.3,
    decay: float = 1e-5, splice: float = 0.5, seed: int = 1,
) -> LanguageCrf:
    """Maximize the likelihood of word labels, by Adagrad over chunks of words with spliced runs."""
    labels = sorted(set(names))
    size, rng = len(labels), np.random.default_rng(seed)
    number = {name: i for i, name in enumerate(labels)}
    streams = [(LETTERS.findall(t.lower()), number[n]) for t, n in zip(texts, names, strict=True)]
    streams = [(w, n) for w, n in streams if w]
    types: dict[str, int] = {}
    coded = [(np.array([types.setdefault(w, len(types)) for w in own]), n) for own, n in streams]
    counts = np.zeros((len(types), size))
    for own, n in coded:
        np.add.at(counts[:, n], own, 1)
    total = counts.sum(1)
    sure = np.flatnonzero((total >= 3) & (counts.max(1, initial=0) >= 0.9 * total))
    names_of_types = list(types)
    lexicon = word_features([names_of_types[i] for i in sure], bits)[2] if len(sure) else np.zeros(0, np.uint64)
    order = np.argsort(lexicon)
    model = LanguageCrf(
        labels, bits, np.zeros((2**bits + size, size), np.float32), np.zeros(size), np.zeros((size, size)), lexicon[order],
        counts.argmax(1)[sure][order] if len(sure) else np.zeros(0, np.int64),
    )
    if not coded:
        return model
    numbers, owner = model.features(names_of_types)
    by_owner = np.argsort(owner, kind="stable")
    numbers, bounds = numbers[by_owner], np.searchsorted(owner[by_owner], np.arange(len(types) + 1))
    chunks = [(own[low : low + chunk], n) for own, n in coded for low in range(0, len(own), chunk)]
    by_label = [[c for c in chunks if c[1] == n] for n in range(size)]
    squares = [np.full_like(p, 1e-6, dtype=np.float64) for p in (model.weights, model.start, model.moves)]
    for _ in range(epochs):
        # Every label is seen equally often, however common it is in the sample.
        picked = [c for own in by_label for c in (own[i] for i in rng.integers(0, len(own), -(-len(chunks) // size)))]
        rng.shuffle(picked)
        for low in range(0, len(picked), batch):
            some = picked[low : low + batch]
            width = max(len(c) for c, _ in some)
            word, gold, real = np.zeros((len(some), width), np.int64), np.zeros((len(some), width), np.int64), np.zeros((len(some), width), bool)
            for row, (own, n) in enumerate(some):
                word[row, : len(own)], gold[row, : len(own)], real[row, : len(own)] = own, n, True
                if rng.random() < splice:
                    other, m = picked[rng.integers(len(picked))]
                    begin = int(rng.integers(0, len(own)))
                    run = other[: int(rng.integers(1, len(own) - begin + 1))]
                    word[row, begin : begin + len(run)], gold[row, begin : begin + len(run)] = run, m
            _step(model, squares, word, gold, real, numbers, bounds, rate, decay)
    return model


def _step(model, squares, word, gold, real, numbers, bounds, rate, decay) -> None:
    size, (rows, width) = len(model.labels), word.shape
    used, at = np.unique(word[real], return_inverse=True)
    spans = bounds[used + 1] - bounds[used]
    owner = np.repeat(np.arange(len(used)), spans)
    own = numbers[np.repeat(bounds[used] - (np.cumsum(spans) - spans), spans) + np.arange(spans.sum())]
    scores = np.stack([np.bincount(owner, w[own], len(used)) for w in model.weights.T], 1)
    psi = np.ones((rows, width, size))
    psi[real] = np.exp(scores - scores.max(1, keepdims=True))[at]
    moves, start = np.exp(model.moves), np.exp(model.start)
    forward, backward = np.empty_like(psi), np.ones_like(psi)
    forward[:, 0] = start * psi[:, 0]
    forward[:, 0] /= forward[:, 0].sum(1, keepdims=True)
    for t in range(1, width):
        new = np.where(real[:, t, None], (forward[:, t - 1] @ moves) * psi[:, t], forward[:, t - 1])
        forward[:, t] = new / new.sum(1, keepdims=True)
    for t in range(width - 2, -1, -1):
        new = np.where(real[:, t + 1, None], (psi[:, t + 1] * backward[:, t + 1]) @ moves.T, backward[:, t + 1])
        backward[:, t] = new / new.sum(1, keepdims=True)
    chance = forward * backward
    chance /= chance.sum(2, keepdims=True)
    hit = np.eye(size)[gold]
    error = (chance - hit)[real]
    by_type = np.stack([np.bincount(at, e, len(used)) for e in error.T], 1)
    slope = np.stack([np.bincount(own, e[owner], len(model.weights)) for e in by_type.T], 1) / rows + decay * model.weights
    both = real[:, 1:] & real[:, :-1]
    pairs = forward[:, :-1, :, None] * moves * (psi * backward)[:, 1:, None, :]
    pairs /= pairs.sum((2, 3), keepdims=True)
    seen = hit[:, :-1, :, None] * hit[:, 1:, None, :]
    slopes = [slope, (chance[:, 0] - hit[:, 0]).sum(0) / rows, ((pairs - seen) * both[..., None, None]).sum((0, 1)) / rows]
    for value, square, slope in zip((model.weights, model.start, model.moves), squares, slopes, strict=True):
        square += slope**2
        value -= (rate * slope / np.sqrt(square)).astype(value.dtype)


def train(docs: DataFrame, per_label: int = 150, max_chars: int = 20_000, max_labels: int = 1000, total: int = 30_000) -> LanguageCrf:
    """Fit on ``per_label`` texts of each label, picked by hash among rows that are not held out.

    With many labels each has fewer, so that there are ``total`` texts at most. Of more than ``max_labels`` the
    rarest stay unlearned.
    """
    usable = docs.where(
        ~held_out() & F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") <= max_chars)
    ).select("text", F.col("lang").alias("label"), F.xxhash64("doc_id", "text").alias("draw"))
    rows = smallest_draws(usable, "label", per_label, max_labels, total).select("label", "text").collect()
    rows.sort()
    return fit([r["text"] for r in rows], [r["label"] for r in rows])


def identify(docs: DataFrame, model: LanguageCrf | None = None, certainty: bool = False) -> DataFrame:
    """Add ``lang_pred`` and ``score`` (mean probability of that label over all words) to every row.

    Without a ``model`` one is trained on the rows' own ``lang``. Texts that are null or hold no letter
    are ``und`` with score 0, and so is everything when no labelled row can be learned from. Ties go to
    the alphabetically first label. Extra columns stay; ones named like an own column give way. Repeated
    rows get equal results; an empty table gives an empty result. With ``certainty`` a column of that name
    is added too: the mean over all words of the probability of the word's own likeliest label, which is
    high for texts in several languages as well.
    """
    model = model or train(docs)
    added = {"lang_pred": F.lit(""), "score": F.lit(0.0)} | ({"certainty": F.lit(0.0)} if certainty else {})
    own, width = with_own(docs, **added), len(added)

    def apply(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            names, *numbers = model.judged_texts(batch.column("text").to_pylist())
            kept = [batch.column(i) for i in range(batch.num_columns - width)]
            judged = [pa.array(names, pa.string()), *[pa.array(n, pa.float64()) for n in numbers]][:width]
            yield pa.RecordBatch.from_arrays([*kept, *judged], batch.schema.names)

    return own.mapInArrow(apply, own.schema)
