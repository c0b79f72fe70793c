"""Language identification of code-switched text by a linear-chain conditional random field.

Words are runs of letters, in lower case. A word's features are its character n-grams of one
to four characters, those at its ends being its affixes, hashed into a table of fixed size,
and its entry in a lexicon of words met in training, if it has one. The labels are the
languages; transitions between the labels of neighbours are learned with the feature
weights. Forward-backward gives each word's probability of each language; a document's
language is the one with the greatest mean, its score.

Training takes a sample of bounded size (``SAMPLE_DOCS`` documents per language on average,
chosen by a hash of text and number, and of each at most ``SAMPLE_WORDS`` words from its middle). Runs
of words of different documents are joined into sequences, so that switches are learned too.

Null text or text without a letter: ``und``, score 0. If there is nothing to learn from, every
row is ``und``. Rows are judged by themselves; other columns are ignored."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labeltext.llm.shared import releasing
from labeltext.llm.words import mix

SAMPLE_DOCS, SAMPLE_WORDS = 250, 240
SEQUENCE, RUN = 60, 20
EPOCHS, RATE, PENALTY = 12, 0.5, 1e-6
TABLE_BITS, GRAMS = 17, 4
LEXICON_BITS = 16
# Characters whose features are taken at a time.
CHUNK_CHARS = 400_000
BLOCK = 64
UNKNOWN = "und"

_STEP = np.uint64(0x9E3779B97F4A7C15)
_FOLD: list[np.ndarray] = []


def _fold() -> np.ndarray:
    """Code point -> code point of its lower case, 0 for what is no letter."""
    if not _FOLD:
        table = np.zeros(0x110000, np.uint32)
        for point in range(0x30000):
            char = chr(point)
            if char.isalpha():
                lower = char.lower()
                table[point] = ord(lower) if len(lower) == 1 else point
        _FOLD.append(table)
    return _FOLD[0]


def letters(text: str) -> np.ndarray:
    """The text's letters in lower case, everything else as 0, with a 0 at either end."""
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    out = np.zeros(len(points) + 2, np.uint32)
    out[1:-1] = _fold()[points]
    return out


@dataclass
class Grams:
    """Hashed features of words: feature k is of word ``word[k]``; ``entry`` is the words' own
    cell in the lexicon."""

    cell: np.ndarray
    word: np.ndarray
    entry: np.ndarray


def grams(chars: np.ndarray) -> Grams:
    """Features of the runs of letters in ``chars``, which begins and ends with 0."""
    inside = chars > 0
    start = np.flatnonzero(inside[1:] & ~inside[:-1])  # the 0 before each word
    if not len(start):
        none = np.zeros(0, np.int64)
        return Grams(none, none, none)
    # Each word with the 0 on either side, one after the other.
    end = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1  # the 0 after
    size = end - start + 1
    first = np.cumsum(size) - size
    word = np.repeat(np.arange(len(start)), size)
    text = chars[np.repeat(start - first, size) + np.arange(len(word))].astype(np.uint64)
    cells, words = [], []
    code = np.full(len(text), _STEP)
    for n in range(1, GRAMS + 1):
        code = code[: len(text) - n + 1] * _STEP + text[n - 1 :] + np.uint64(1)
        same = word[: len(code)] == word[n - 1 :]
        if n == 1:
            same &= text > 0
        cells.append((mix(code[same]) >> np.uint64(64 - TABLE_BITS)).astype(np.int64))
        words.append(word[: len(code)][same])
    place = np.arange(len(text)) - np.repeat(first, size)
    whole = np.add.reduceat(mix(text + place.astype(np.uint64) * _STEP), first)
    entry = (mix(whole) >> np.uint64(64 - LEXICON_BITS)).astype(np.int64)
    return Grams(np.concatenate(cells), np.concatenate(words), entry)


@dataclass
class Model:
    languages: list[str]
    weight: np.ndarray  # (feature cells, languages)
    lexicon: np.ndarray  # (lexicon cells, languages)
    move: np.ndarray  # (languages, languages)

    def emissions(self, chars: np.ndarray) -> np.ndarray:
        """Scores of each word for each language."""
        parts, at = [], 0
        while at < len(chars):
            end = min(at + CHUNK_CHARS, len(chars))
            if end < len(chars):
                gaps = np.flatnonzero(chars[at + 1 : end] == 0)
                if len(gaps):
                    end = at + 2 + int(gaps[-1])
                else:
                    later = np.flatnonzero(chars[end:] == 0)
                    end = end + 1 + int(later[0]) if len(later) else len(chars)
            parts.append(self._scores(grams(chars[at:end])))
            at = end - 1 if end < len(chars) else end
        return np.concatenate(parts) if parts else np.zeros((0, len(self.languages)))

    def _scores(self, found: Grams) -> np.ndarray:
        n, many = len(found.entry), np.maximum(np.bincount(found.word, minlength=len(found.entry)), 1)
        out = np.empty((n, len(self.languages)))
        for k in range(len(self.languages)):
            out[:, k] = np.bincount(found.word, self.weight[:, k][found.cell], minlength=n)
        return out / np.sqrt(many)[:, None] + self.lexicon[found.entry]


def _normal(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(x.sum(axis=-1, keepdims=True), 1e-300)


def marginals(scores: np.ndarray, move: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Label probabilities of the words of several sequences; ``first`` says where each
    begins, and the end."""
    return forward_backward(scores, move, first)[0]


def forward_backward(
    scores: np.ndarray, move: np.ndarray, first: np.ndarray, moves: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities of the words of several sequences and, if ``moves``, how often each
    label is expected to follow each other one: for every two neighbours forward times move
    times emission times backward, made a probability. Exact over blocks: the blocks' transfer
    matrices are multiplied up for all blocks at once, then carried along each sequence."""
    size = np.diff(first)
    labels = scores.shape[1]
    blocks = -(-size // BLOCK)
    begin = np.cumsum(blocks) - blocks
    total = int(blocks.sum())
    seq = np.repeat(np.arange(len(size)), blocks)
    number = np.arange(total) - begin[seq]
    places = first[:-1][seq][:, None] + number[:, None] * BLOCK + np.arange(BLOCK)
    real = places < first[1:][seq][:, None]
    emit = np.exp(scores - scores.max(axis=1, keepdims=True))
    emit = np.where(real[..., None], emit[np.minimum(places, len(scores) - 1)], 1.0)
    step = np.exp(move - move.max())
    eye = np.eye(labels)
    # Transfer matrix of each block; words past the end change nothing. The first word of a
    # sequence has no predecessor: it starts from equal labels and an identity step.
    whole = np.broadcast_to(eye, (total, labels, labels)).copy()
    for k in range(BLOCK):
        use = real[:, k]
        by = np.where((number[use] == 0)[:, None, None] & (k == 0), eye, step) * emit[use, k, None, :]
        whole[use] = whole[use] @ by
        whole[use] /= np.maximum(whole[use].sum(axis=(1, 2), keepdims=True), 1e-300)
    enter = np.ones((total, labels)) / labels
    leave = np.ones((total, labels)) / labels
    for k in range(1, int(blocks.max())):
        at = begin[blocks > k] + k
        enter[at] = _normal(np.einsum("bi,bij->bj", enter[at - 1], whole[at - 1]))
    for k in range(1, int(blocks.max())):
        at = (begin + blocks - 1 - k)[blocks > k]
        leave[at] = _normal(np.einsum("bij,bj->bi", whole[at + 1], leave[at + 1]))
    ahead = np.empty((total, BLOCK, labels))
    prior = enter.copy()
    expected = np.zeros((labels, labels))
    for k in range(BLOCK):
        by = np.where(((number == 0) & (k == 0))[:, None], enter, enter @ step) * emit[:, k]
        enter = np.where(real[:, k, None], _normal(by), enter)
        ahead[:, k] = enter
    out = np.empty_like(scores)
    for k in range(BLOCK - 1, -1, -1):
        use = real[:, k]
        out[places[use, k]] = _normal(ahead[use, k] * leave[use])
        if moves:
            # Words with one before them; that of a block's first word stands in the block before.
            here = use if k else use & (number > 0)
            left = (ahead[:, k - 1] if k else prior)[here]
            both = left[:, :, None] * step * (emit[here, k] * leave[here])[:, None, :]
            expected += (both / np.maximum(both.sum(axis=(1, 2), keepdims=True), 1e-300)).sum(axis=0)
        back = _normal((emit[:, k] * leave) @ step.T)
        leave = np.where(use[:, None], back, leave)
    return out, expected


def fit(texts: list[str], labels: list[str]) -> Model:
    """Weights of a bounded sample, by gradient steps on the conditional likelihood."""
    languages = sorted(set(labels))
    rng = np.random.default_rng(7)
    runs = []
    for text, label in zip(texts, labels, strict=True):
        words = "".join(map(chr, np.where(letters(text) > 0, letters(text), 32))).split()
        middle = max(0, (len(words) - SAMPLE_WORDS) // 2)
        words = words[middle : middle + SAMPLE_WORDS]
        for k in range(0, len(words), RUN):
            runs.append((words[k : k + RUN], languages.index(label)))
    model = Model(
        languages,
        np.zeros((1 << TABLE_BITS, len(languages))),
        np.zeros((1 << LEXICON_BITS, len(languages))),
        np.zeros((len(languages),) * 2),
    )
    if not runs:
        return model
    order = rng.permutation(len(runs))
    words, truth = [], []
    for k in order:
        words += runs[k][0]
        truth += [runs[k][1]] * len(runs[k][0])
    truth = np.array(truth)
    found = grams(letters(" ".join(words)))
    first = np.append(np.arange(0, len(words), SEQUENCE), len(words))
    goal = np.eye(len(languages))[truth]
    starts = np.zeros(len(words), bool)
    starts[first[:-1]] = True
    pair = np.flatnonzero(~starts)
    seen_moves = np.einsum("bi,bj->ij", goal[pair - 1], goal[pair])
    many = np.maximum(np.bincount(found.word, minlength=len(words)), 1)
    scale = 1 / np.sqrt(many)
    seen = np.bincount(found.entry, minlength=1 << LEXICON_BITS) > 1
    sums = [np.full(x.shape, 1e-8) for x in (model.weight, model.lexicon, model.move)]
    for _ in range(EPOCHS):
        scores = model._scores(found)
        chance, expected = forward_backward(scores, model.move, first, moves=True)
        miss = goal - chance
        grad = [np.empty_like(model.weight), np.empty_like(model.lexicon), None]
        for k in range(len(languages)):
            grad[0][:, k] = np.bincount(
                found.cell, (miss[:, k] * scale)[found.word], minlength=1 << TABLE_BITS
            )
            grad[1][:, k] = np.bincount(found.entry, miss[:, k], minlength=1 << LEXICON_BITS)
        grad[1][~seen] = 0
        grad[2] = seen_moves - expected
        for value, g, s in zip((model.weight, model.lexicon, model.move), grad, sums, strict=True):
            g -= PENALTY * len(words) * value
            s += g * g
            value += RATE * g / np.sqrt(s)
        np.clip(model.move, -4, 4, out=model.move)
    return model


def held_out(doc_id) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, sample: int = SAMPLE_DOCS) -> Model:
    """Fit on the rows of ``docs`` with text and lang. About ``sample`` rows per language are
    chosen by hash; fewer languages' worth of rows than that are all taken."""
    rows = docs.where("text is not null and lang is not null").select("doc_id", "text", "lang")
    sizes = {lang: n for lang, n in rows.groupBy("lang").count().collect()}
    if not sizes:
        return Model([], np.zeros((1, 0)), np.zeros((1, 0)), np.zeros((0, 0)))
    share = F.create_map(*(F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, sample / n))))
    chance = F.pmod(F.xxhash64(F.lit(11), "doc_id", F.substring("text", 1, 100)), F.lit(1 << 20)) / (1 << 20)
    # Long texts are cut to a window in their middle before they reach the driver.
    width = 12 * SAMPLE_WORDS
    middle = F.greatest(F.lit(1), ((F.length("text") - width) / 2).cast("int"))
    picked = rows.where(chance < share[F.col("lang")]).select(
        F.substring("text", middle, F.lit(width)).alias("text"), "lang", "doc_id"
    ).orderBy("doc_id", "lang", "text").collect()
    return fit([r[0] for r in picked], [r[1] for r in picked])


def _labelled(texts: list[str], model: Model) -> Iterator[tuple[str, float]]:
    """Language and score of each text; the texts are taken together."""
    if not model.languages:
        yield from ((UNKNOWN, 0.0) for _ in texts)
        return
    parts = [letters(text) for text in texts]
    scores = model.emissions(np.concatenate(parts))
    words = [int(((x[1:] > 0) & (x[:-1] == 0)).sum()) for x in parts]
    first = np.concatenate([[0], np.cumsum(words)])
    full = np.flatnonzero(words)
    mean = np.zeros((len(texts), len(model.languages)))
    if len(full):
        chance = marginals(scores, model.move, np.append(first[full], first[-1]))
        mean[full] = np.add.reduceat(chance, first[full]) / np.array(words)[full, None]
    for k, row in enumerate(mean):
        best = int(row.argmax())
        yield (model.languages[best], min(1.0, float(row[best]))) if words[k] else (UNKNOWN, 0.0)


def label_texts(column: pa.Array, model: Model) -> list[tuple[str, float]]:
    """Language and score of each row of a text column."""
    found: list[tuple[str, float]] = []
    texts: list[str] = []
    size = 0
    for text in column:
        text = text.as_py() or ""
        if texts and size + len(text) > CHUNK_CHARS:
            found += _labelled(texts, model)
            texts, size = [], 0
        texts.append(text)
        size += len(text)
    return found + list(_labelled(texts, model)) if texts else found


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of each row."""

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = label_texts(batch.column("text"), model)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").cast(pa.int64()),
                    pa.array([x[0] for x in found], pa.string()),
                    pa.array([x[1] for x in found], pa.float64()),
                ],
                ["doc_id", "lang_pred", "score"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        releasing(predict), "doc_id long, lang_pred string, score double"
    )


def keep_identified(docs: DataFrame, model: Model, least: float) -> DataFrame:
    """The rows of ``docs`` whose language is recognised with a score of ``least`` or more."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = label_texts(batch.column("text"), model)
            yield batch.filter(pa.array([l != UNKNOWN and s >= least for l, s in found], pa.bool_()))

    return docs.mapInArrow(releasing(keep), docs.schema)


def language_id(docs: DataFrame, sample: int = SAMPLE_DOCS) -> DataFrame:
    """doc_id, held_out, lang_pred, score; learned from the rows that aren't held out."""
    model = train(docs.where(~held_out(F.col("doc_id"))), sample)
    return identify(docs, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )
