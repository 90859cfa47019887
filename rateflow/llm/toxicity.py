"""Toxicity: a weighted lexicon matched by an Aho-Corasick automaton.

Text is folded first (case, accents, look-alike letters of other scripts, digits
and signs put for letters), letter for letter, so that places in the folded text
are places in the text. An entry is a word, matched whole, or a stem, matched at
the start of a longer word; a match inside an exception phrase does not count. The weights of the matches, over a length term, give the
score through a sigmoid fitted on the training rows.
"""

from __future__ import annotations

import math
import unicodedata
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rateflow.llm.common import logistic, sliced, training_sample

# Words looked for whether or not training rows hold them.
SEED_WORDS = (
    "arsehole asshole bastard bitch bollocks bullshit clown cretin creep cunt dickhead"
    " disgusting dumbass dumb fool freak fuck fucking garbage halfwit hateful hypocrite"
    " idiot idiotic imbecile jackass jerk liar loser lowlife lunatic maggot moron moronic"
    " nitwit numbskull parasite pathetic pervert pig prick psycho repulsive retard"
    " scumbag scum shit shithead sicko simpleton sleazebag slut stupid trash twat vermin"
    " vile wanker weirdo whore worthless"
).split()

# Harmless phrases that hold a word of the list.
EXCEPTION_PHRASES = (
    "trash can", "trash bin", "trash bag", "take out the trash", "garbage can",
    "garbage collection", "garbage collector", "garbage truck", "clown fish",
    "circus clown", "guinea pig", "pig iron", "sore loser", "computer freak",
    "april fool", "no fool", "pond scum",
)

# Letters of other scripts that look like Latin ones.
LOOK_ALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k",
    "м": "m", "н": "h", "о": "o", "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "α": "a",
    "β": "b", "ε": "e", "ι": "i", "κ": "k", "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u",
    "χ": "x", "ı": "i", "ɡ": "g", "ʟ": "l", "ɴ": "n", "ѡ": "w",
}

# Digits and signs put for letters.
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g",
               "@": "a", "$": "s", "!": "i", "|": "l", "+": "t"}

#: Bound of the labelled rows which the weights and the sigmoid are fitted on.
TRAINING_ROWS = 10000
#: A word or stem that is no seed enters the lexicon if at least this many toxic
#: training texts have it, and if it weighs so much.
LEARNED_TEXTS, LEARNED_WEIGHT = 5, 1.5
STEM_LENGTHS = range(3, 11)
SEED_WEIGHT = 3.0
#: Words which the matched mass is related to: so many that one match in a long text shows.
PER_WORDS = 100_000.0


def _plain_letters() -> dict[int, str]:
    """Accented and full-width letters to plain ones, and the look-alikes."""
    table = {}
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0xFF21, 0xFF5B)]:
        plain = unicodedata.normalize("NFKD", chr(code))[0].lower()
        if plain.isascii() and plain.isalpha():
            table[code] = plain
    for other, plain in LOOK_ALIKES.items():
        table[ord(other)] = plain
        if len(other.upper()) == 1:
            table[ord(other.upper())] = plain
    return table


_LETTERS = _plain_letters()
_SUBSTITUTES = str.maketrans(SUBSTITUTES)


def fold(text: str) -> tuple[str, str]:
    """``(letters, folded)``, each as long as the text.

    ``letters`` is lower case without accents and look-alikes; ``folded`` has
    the substitutes replaced too.
    """
    lower = text.lower()
    if len(lower) != len(text):
        lower = "".join(c.lower() if len(c.lower()) == 1 else c for c in text)
    letters = lower if lower.isascii() else lower.translate(_LETTERS)
    return letters, letters.translate(_SUBSTITUTES)


@dataclass(frozen=True)
class Lexicon:
    """Folded words and stems with weights, exception phrases, and the sigmoid.

    A stem is written with a hyphen at its end.

    ``sigmoid`` is (mass, rate, intercept): weights of the logarithms of the
    matched mass and of the mass per ``PER_WORDS`` words.
    """

    weights: dict[str, float]
    exceptions: tuple[str, ...] = EXCEPTION_PHRASES
    sigmoid: tuple[float, float, float] = (0.0, 1.0, -3.0)
    _built: list = field(default_factory=list, compare=False, repr=False)

    def __getstate__(self):
        return (self.weights, self.exceptions, self.sigmoid)

    def __setstate__(self, state):
        for name, value in zip(("weights", "exceptions", "sigmoid"), state):
            object.__setattr__(self, name, value)
        object.__setattr__(self, "_built", [])

    def automaton(self) -> ahocorasick.Automaton:
        if not self._built:
            built = ahocorasick.Automaton()
            entries: dict[str, list] = {}
            for entry, weight in self.weights.items():
                found = entries.setdefault(entry.rstrip("-"), [None, None, False])
                found[entry.endswith("-")] = weight
            for phrase in self.exceptions:
                entries.setdefault(fold(phrase)[1], [None, None, False])[2] = True
            for text, (word, stem, excepted) in entries.items():
                built.add_word(text, (len(text), word, stem, excepted))
            built.make_automaton()
            self._built.append(built)
        return self._built[0]

    def matches(self, text: str) -> list[tuple[int, int, float]]:
        """``(start, end, weight)`` of matches outside exceptions.

        Of the matches that begin at one place the longest counts.
        """
        if not self.weights:
            return []
        letters, folded = fold(text)
        found, excused = [], []
        for last, (length, word, stem, excepted) in self.automaton().iter(folded):
            start, end = last + 1 - length, last + 1
            # Signs are no part of a word: ``idiot$$$`` is the word and signs.
            if start and letters[start - 1].isalnum():
                continue
            whole = end == len(letters) or not letters[end].isalnum()
            if whole and excepted:
                excused.append((start, end))
            weight = word if whole else stem
            if weight is not None and any(c.isalpha() for c in letters[start:end]):
                found.append((start, end, weight))
        kept: list[tuple[int, int, float]] = []
        excused.sort()
        # How far the exceptions reach that begin at or before the match.
        at = reach = 0
        for start, end, weight in sorted(found, key=lambda m: (m[0], -m[1])):
            while at < len(excused) and excused[at][0] <= start:
                reach = max(reach, excused[at][1])
                at += 1
            if end <= reach:
                continue
            if not kept or start >= kept[-1][1]:
                kept.append((start, end, weight))
        return kept

    def measure(self, text: str) -> tuple[float, float]:
        """Logarithms of the matched mass and of the mass per ``PER_WORDS`` words."""
        mass = sum(weight for _, _, weight in self.matches(text))
        words = text.count(" ") + text.count("\n") + 1
        return math.log1p(mass), math.log1p(PER_WORDS * mass / words)

    def score(self, text: str | None) -> float:
        mass, rate = self.measure(text) if text else (0.0, 0.0)
        a, b, c = self.sigmoid
        return 1.0 / (1.0 + math.exp(-max(-60.0, min(60.0, a * mass + b * rate + c))))


def folded_words(text: str) -> set[str]:
    """The distinct folded words: runs of letters, digits and inner signs."""
    letters, folded = fold(text)
    words, start = set(), None
    for at, c in enumerate(letters):
        if c.isalnum():
            start = at if start is None else start
        elif start is not None:
            words.add(folded[start:at])
            start = None
    if start is not None:
        words.add(folded[start:])
    return words


def folded_entries(text: str) -> set[str]:
    """The distinct words of a text, and their stems written with a hyphen."""
    words = folded_words(text)
    stems = {word[:n] + "-" for word in words for n in STEM_LENGTHS if n < len(word)}
    return words | stems


def train(
    docs: DataFrame,
    labels: DataFrame,
    max_rows: int = TRAINING_ROWS,
    seeds: Iterable[str] = SEED_WORDS,
    exceptions: Iterable[str] = EXCEPTION_PHRASES,
) -> Lexicon:
    """Weights from at most ``max_rows`` labelled documents (``training_sample``).

    A weight is the lower end of the log-odds of being in a toxic rather than
    another text; texts that repeat count once. Seeds always enter (with
    ``SEED_WEIGHT`` where no training row has them, and never below a tenth of
    it); other words and stems enter under ``LEARNED_*``, so their number is
    bounded by the entries of the sample's toxic texts over ``LEARNED_TEXTS``. An
    entry is left out where a shorter stem of it weighs as much, and a stem where
    one longer entry has nearly all of its texts. Without toxic training rows the
    lexicon is the seeds.
    """
    seeds = sorted({fold(word)[1] for word in seeds})
    exceptions = tuple(exceptions)
    sample = (
        training_sample(docs, labels, "toxic", max_rows)
        .groupBy(F.md5("text").alias("digest"))
        .agg(F.max("label").alias("label"), F.first("text").alias("text"))
    )

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            for text, label in zip(
                batch.column("text").to_pylist(), batch.column("label").to_pylist()
            ):
                found = sorted(folded_entries(text))
                yield pa.record_batch(
                    {
                        # The empty word counts the texts themselves.
                        "word": pa.array(["", *found], pa.string()),
                        "label": pa.array([label] * (len(found) + 1), pa.int32()),
                    }
                )

    counted = (
        sample.select("text", "label")
        .mapInArrow(words, "word STRING, label INT")
        .groupBy("word")
        .agg(F.sum("label").alias("toxic"), F.count(F.lit(1)).alias("n"))
    )
    # What passes is bounded by the sample: seeds, and words that may be learned.
    total = counted.where(F.col("word") == "").first()
    toxic, clean = (total["toxic"], total["n"] - total["toxic"]) if total else (0, 0)
    often = (F.col("toxic") >= LEARNED_TEXTS) & (F.col("toxic") * clean > (F.col("n") - F.col("toxic")) * toxic)
    kept = counted.where((F.col("word") != "") & (often | F.col("word").isin(seeds))).collect()
    learned = {}
    for row in kept:
        weight = _log_odds(row["toxic"], row["n"] - row["toxic"], toxic, clean)
        if row["word"] in seeds:
            learned[row["word"]] = max(weight, SEED_WEIGHT / 10)
        elif weight >= LEARNED_WEIGHT and any(c.isalpha() for c in row["word"]):
            learned[row["word"]] = weight
    # A stem all but whose texts are those of one longer entry says too little.
    counts = {row["word"]: row["toxic"] for row in kept}
    widest: dict[str, int] = {}
    for entry in learned:
        text = entry.rstrip("-")
        for n in range(1, len(text) + (not entry.endswith("-"))):
            widest[text[:n]] = max(widest.get(text[:n], 0), counts[entry])
    weights = {word: SEED_WEIGHT for word in seeds}
    for entry in sorted(learned, key=lambda e: (len(e), e)):
        text = entry.rstrip("-")
        if entry.endswith("-") and widest.get(text, 0) >= 0.95 * counts[entry]:
            continue
        shorter = max((weights.get(text[:n] + "-", 0.0) for n in range(1, len(text))), default=0.0)
        if entry in seeds or learned[entry] > shorter + 0.2:
            weights[entry] = learned[entry]
    lexicon = Lexicon(weights, exceptions)
    if not toxic or not clean:
        return lexicon

    def measures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [lexicon.measure(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch(
                {
                    "mass": pa.array([m for m, _ in found], pa.float64()),
                    "rate": pa.array([r for _, r in found], pa.float64()),
                    "label": batch.column("label"),
                }
            )

    # At most max_rows rows of three numbers.
    rows = (
        sample.select("text", "label")
        .mapInArrow(measures, "mass DOUBLE, rate DOUBLE, label INT")
        .collect()
    )
    return Lexicon(weights, exceptions, _sigmoid(sorted(rows)))


def _log_odds(toxic_with: int, clean_with: int, toxic: int, clean: int) -> float:
    a, b = toxic_with + 0.5, clean_with + 0.5
    c, d = toxic - toxic_with + 0.5, clean - clean_with + 0.5
    return math.log(a * d / (b * c)) - 2.0 * math.sqrt(1 / a + 1 / b)


def _sigmoid(rows: list) -> tuple[float, float, float]:
    """Logistic regression on mass and rate; a weight below 0 is left out."""
    x = np.array([(r["mass"], r["rate"]) for r in rows])
    y = np.array([r["label"] for r in rows], float)
    for used in ([0, 1], [0], [1]):
        *slopes, intercept = logistic(x[:, used], y)
        if min(slopes) > 0:
            weights = np.zeros(2)
            weights[used] = slopes
            return float(weights[0]), float(weights[1]), float(intercept)
    return Lexicon.sigmoid


def score_documents(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.7) -> DataFrame:
    """``(doc_id, score, predicted)``, one row per document.

    A null text counts as empty and scores the sigmoid's floor, as any text
    without a match. Repeated rows are each scored; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            texts = batch.column("text").to_pylist()
            found = [lexicon.score(t) for t in texts]
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "score": pa.array(found, pa.float64()),
                    "predicted": pa.array([int(s >= threshold) for s in found], pa.int32()),
                }
            )

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id LONG, score DOUBLE, predicted INT")


def find_spans(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """``(doc_id, start, end, word, weight)`` of every match, in code points."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            rows = [
                (doc_id, start, end, text[start:end], weight)
                for doc_id, text in zip(
                    batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
                )
                for start, end, weight in lexicon.matches(text or "")
            ]
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.float64())
            yield pa.record_batch(
                [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)],
                names=["doc_id", "start", "end", "word", "weight"],
            )

    return docs.select("doc_id", "text").mapInArrow(
        run, "doc_id LONG, start LONG, end LONG, word STRING, weight DOUBLE"
    )


def keep_civil(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.7) -> DataFrame:
    """The documents, with all their columns, that score below ``threshold``.

    Null and empty texts score as a text without a match and stay; repeated rows
    are judged alike, and null ids are no matter. An empty table stays so.
    """
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches):
            found = [lexicon.score(t) for t in batch.column(at).to_pylist()]
            yield batch.filter(pa.array([s < threshold for s in found]))

    return docs.mapInArrow(run, docs.schema)
