"""Language ID by a linear-chain conditional random field over words.

Every word of a text is labelled with a language.  Its features are affixes
(first and last one to three letters), letter n-grams (two and three), the
script, and for each language whether the word is in that language's lexicon;
transitions between neighbouring words' labels are learned too.  Forward-
backward gives each word's label probabilities given the whole text, so a text
that switches languages is labelled piece by piece; the text's language is the
one with the largest expected share of its words.

Learning is by gradient ascent on the conditional likelihood, on the driver,
from a sample bounded by ``sample_rows`` excerpts of ``excerpt_chars``
characters, spliced so that the label changes within sequences.  Prediction
runs over whole texts in Arrow batches; nothing is shuffled.
"""

from __future__ import annotations

import functools
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import pieces

#: Hashed features of one word are looked up in a table of so many rows.
BUCKETS = 1 << 17
SAMPLE_ROWS = 1600
EXCERPT_CHARS = 900
LEXICON_COUNT = 3
UNDETERMINED = "und"
#: Letters scored at once.
_CHUNK = 1 << 18


@dataclass(frozen=True)
class Model:
    """``labels``; ``weights`` (buckets x labels), ``transitions`` (from x to, logs),
    ``start`` (logs); ``lexicon``: sorted word hashes, ``member``: lexicons of each."""

    labels: tuple[str, ...]
    weights: np.ndarray
    transitions: np.ndarray
    start: np.ndarray
    lexicon: np.ndarray
    member: np.ndarray


@functools.lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    """Of every code point: 2 a letter, 1 a mark (which goes on a word, but makes none), 0 neither."""
    return np.fromiter(("ML".find(unicodedata.category(chr(i))[0]) + 1 for i in range(0x110000)), np.int8, 0x110000)


def tokenize(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Lower-cased code points of all texts, and first letter, end and text of each word."""
    low = [t.lower() for t in texts]
    points = np.frombuffer("\n".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        none = np.zeros(0, np.int64)
        return points, none, none, none
    kind = _letters()[points]
    inside = np.concatenate([[False], kind > 0, [False]])
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    if len(starts) and (kind == 1).any():  # marks without a letter
        some = np.maximum.reduceat(kind, starts) == 2
        starts, ends = starts[some], ends[some]
    limits = np.cumsum([len(t) + 1 for t in low])
    return points, starts, ends, np.searchsorted(limits, starts, side="right")


def _mix(h: np.ndarray) -> np.ndarray:
    h = h * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(32))


def _gram(points: np.ndarray, at: np.ndarray, n: int, kind: int) -> np.ndarray:
    """Hash of the ``n`` letters from ``at`` on, as a feature of a kind."""
    h = np.full(len(at), kind, np.uint64)
    for j in range(n):
        h = _mix(h ^ points[at + j].astype(np.uint64))
    return h


def word_hashes(points: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit polynomial hash of each word."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    base = np.uint64(0xC2B2AE3D27D4EB4F)
    length = ends - starts
    first = np.concatenate([[0], np.cumsum(length)[:-1]])
    within = np.arange(int(length.sum())) - np.repeat(first, length)
    power = np.full(int(length.max()) + 1, base, np.uint64)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    letters = points[np.repeat(starts, length) + within].astype(np.uint64) + np.uint64(1)
    return _mix(np.add.reduceat(letters * power[within], first) ^ length.astype(np.uint64))


def _features(points, starts, ends, lexicon, member) -> list[tuple[np.ndarray, np.ndarray | None]]:
    """(bucket, word) of all features; word None: one per word, in order."""
    length = ends - starts
    out: list[tuple[np.ndarray, np.ndarray | None]] = []
    words = np.arange(len(starts))
    with np.errstate(over="ignore"):
        for n in (1, 2, 3):
            ok = length >= n
            out.append((_gram(points, starts[ok], n, 10 + n), words[ok]))
            out.append((_gram(points, ends[ok] - n, n, 20 + n), words[ok]))
        for n in (2, 3):
            count = np.maximum(length - n + 1, 0)
            owner = np.repeat(words, count)
            first = np.concatenate([[0], np.cumsum(count)[:-1]]) if len(count) else count
            at = np.arange(len(owner)) - np.repeat(first, count) + starts[owner]
            out.append((_gram(points, at, n, 30 + n), owner))
        out.append((_mix((points[starts] >> np.uint32(7)).astype(np.uint64) ^ np.uint64(40)), None))
        out.append((np.full(len(starts), 41, np.uint64), None))
        if len(lexicon):
            h = word_hashes(points, starts, ends)
            place = np.minimum(np.searchsorted(lexicon, h), len(lexicon) - 1)
            known = lexicon[place] == h
            for k in range(member.shape[1]):
                has = known & member[place, k]
                out.append((np.full(int(has.sum()), 100 + k, np.uint64), words[has]))
            out.append((np.full(int((~known).sum()), 99, np.uint64), words[~known]))
    return [((f % np.uint64(BUCKETS)).astype(np.int64), w) for f, w in out]


def emissions(model: Model, points, starts, ends) -> np.ndarray:
    """Score of each label for each word."""
    k = len(model.labels)
    out = np.zeros((len(starts), k))
    done = 0
    while done < len(starts):
        upto = max(done + 1, int(np.searchsorted(starts, starts[done] + _CHUNK)))
        s, e = starts[done:upto], ends[done:upto]
        part = np.zeros((len(s), k))
        for bucket, owner in _features(points, s, e, model.lexicon, model.member):
            w = model.weights[bucket]
            if owner is None:
                part += w
            elif len(owner):
                cut = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
                part[owner[cut]] += np.add.reduceat(w, cut, axis=0)
        out[done:upto] = part
        done = upto
    return out


def marginals(scores: np.ndarray, first: np.ndarray, length: np.ndarray, transitions: np.ndarray, start: np.ndarray,
              pairs: bool = False):
    """Forward-backward over sequences (rows ``first .. first + length`` of
    ``scores``): label probabilities per row, and (if asked) expected counts of
    transitions and of first labels."""
    k = scores.shape[1]
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    a = np.exp(transitions)
    order = np.argsort(-length, kind="stable")
    first, length = first[order], length[order]
    steps = int(length[0]) if len(length) else 0
    active = len(length) - np.searchsorted(length[::-1], np.arange(steps), side="right")
    forward = np.empty_like(e)
    state = np.exp(start)[None, :]
    for t in range(steps):
        rows = first[:active[t]] + t
        now = e[rows] * (state if t == 0 else state[:active[t]] @ a)
        state = now / now.sum(axis=1, keepdims=True)
        forward[rows] = state
    expected = np.zeros((k, k))
    prob = np.empty_like(e)
    last = first + length - 1
    prob[last] = forward[last]
    back = np.ones((len(length), k))
    for t in range(steps - 2, -1, -1):
        n = active[t + 1]
        rows = first[:n] + t
        right = e[rows + 1] * back[:n]
        message = right @ a.T
        both = forward[rows] * message
        total = both.sum(axis=1, keepdims=True)
        prob[rows] = both / total
        if pairs:
            expected += (forward[rows] / total).T @ right * a
        back[:n] = message / message.sum(axis=1, keepdims=True)
    return (prob, expected, prob[first].sum(axis=0)) if pairs else prob


def fit(samples: list[tuple[str, str]], epochs: int = 5, rate: float = 0.15, decay: float = 1e-5, seed: int = 7) -> Model:
    """Learn from (text, label) pairs.  Sequences splice runs of words of
    different labels, so that transitions are seen."""
    labels = tuple(sorted({label for _, label in samples}))
    k, rng = len(labels), np.random.default_rng(seed)
    number = {label: i for i, label in enumerate(labels)}
    count = Counter()
    for text, label in samples:
        p, s, e, _ = tokenize([text])
        with np.errstate(over="ignore"):
            count.update((int(h), number[label]) for h in word_hashes(p, s, e))
    chosen = sorted({h for (h, _), n in count.items() if n >= LEXICON_COUNT})
    lexicon = np.array(chosen, np.uint64)
    member = np.zeros((len(lexicon), k), bool)
    place = {h: i for i, h in enumerate(chosen)}
    total = Counter()
    for (h, _), n in count.items():
        total[h] += n
    for (h, label), n in count.items():
        if n >= LEXICON_COUNT and 5 * n >= total[h]:
            member[place[h], label] = True

    # runs of words, shuffled, then joined by threes and fours
    runs = []
    for text, label in samples:
        words = text.split()
        at = 0
        while at < len(words):
            n = int(rng.integers(4, 40))
            runs.append((" ".join(words[at:at + n]), number[label]))
            at += n
    rng.shuffle(runs)
    runs = [(t, int(y)) for t, y in runs]
    groups = [runs[i:i + 4] for i in range(0, len(runs), 4)]

    weights, g_weights = np.zeros((BUCKETS, k)), np.full((BUCKETS, k), 1e-4)
    transitions, g_trans = np.zeros((k, k)), np.full((k, k), 1e-2)
    start, g_start = np.zeros(k), np.full(k, 1e-2)
    batches = [groups[i:i + 128] for i in range(0, len(groups), 128)]
    prepared = []
    for batch in batches:
        points, s, e, piece = tokenize([t for group in batch for t, _ in group])
        if not len(s):
            continue
        y = np.array([y for group in batch for _, y in group])[piece]
        sequence = np.repeat(np.arange(len(batch)), [len(g) for g in batch])[piece]
        features = [(f, np.arange(len(s)) if w is None else w) for f, w in _features(points, s, e, lexicon, member)]
        bucket = np.concatenate([f for f, _ in features])
        owner = np.concatenate([w for _, w in features])
        order = np.argsort(owner, kind="stable")
        bucket, owner = bucket[order], owner[order]
        used, local = np.unique(bucket, return_inverse=True)
        cut = np.flatnonzero(np.concatenate([[True], sequence[1:] != sequence[:-1]]))
        length = np.diff(np.concatenate([cut, [len(s)]]))
        prepared.append((y, sequence, used, local, owner, np.searchsorted(owner, np.arange(len(s))), cut, length))
    for _ in range(epochs):
        for i in rng.permutation(len(prepared)):
            y, sequence, used, local, owner, heads, cut, length = prepared[i]
            w = weights[used]
            scores = np.add.reduceat(w[local], heads, axis=0)
            prob, pair, first = marginals(scores, cut, length, transitions, start, pairs=True)
            error = -prob
            error[np.arange(len(y)), y] += 1
            grad = np.stack([np.bincount(local, error[owner, j], len(used)) for j in range(k)], axis=1) / len(cut) - decay * w
            seen = np.zeros((k, k))
            inner = np.flatnonzero(sequence[1:] == sequence[:-1])
            np.add.at(seen, (y[inner], y[inner + 1]), 1)
            g_weights[used] += grad * grad
            weights[used] += rate * grad / np.sqrt(g_weights[used])
            for value, total_g, g in ((transitions, g_trans, (seen - pair) / len(cut)),
                                      (start, g_start, (np.bincount(y[cut], minlength=k) - first) / len(cut))):
                total_g += g * g
                value += rate * g / np.sqrt(total_g)
    return Model(labels, weights.astype(np.float32), transitions, start, lexicon, member)


def predict(model: Model | None, texts: list[str]) -> tuple[list[str], list[float]]:
    """Language and its expected share of the words, per text."""
    languages, scores = [UNDETERMINED] * len(texts), [0.0] * len(texts)
    points, starts, ends, owner = tokenize(texts)
    if model is None or not model.labels or not len(starts):
        return languages, scores
    first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    length = np.diff(np.concatenate([first, [len(owner)]]))
    prob = marginals(emissions(model, points, starts, ends), first, length, model.transitions, model.start)
    share = np.add.reduceat(prob, first, axis=0) / length[:, None]
    for i, row in zip(owner[first], share):
        best = int(row.argmax())
        languages[i], scores[i] = model.labels[best], float(min(1.0, row[best]))
    return languages, scores


def sample(docs: DataFrame, learn: Column, id_col: str, text_col: str, lang_col: str, rows: int, chars: int) -> list[tuple[str, str]]:
    """At most ``rows`` (and per language an equal part) labelled excerpts,
    chosen by a hash of the id over the whole table, from a place in the text
    that the hash chooses too."""
    base = docs.where(learn & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in base.groupBy(F.col(lang_col).cast("string")).count().collect()}
    if not counts:
        return []
    each = max(1, rows // len(counts))
    # a quarter more than needed in the mean; the surplus is cut off below
    share = F.create_map(*[x for lang, n in counts.items() for x in (F.lit(lang), F.lit(min(1.0, (1.25 * each + 10) / n)))])
    drawn = F.xxhash64(F.lit("crf"), F.col(id_col).cast("string"))
    at = F.pmod(F.xxhash64(F.lit("at"), drawn), F.greatest(F.length(text_col) - chars, F.lit(0)) + 1).cast("int") + 1
    picked = base.where((F.shiftrightunsigned(drawn, 11) / float(1 << 53)) < F.try_element_at(share, F.col(lang_col).cast("string")))
    found = picked.select(F.col(lang_col).cast("string"), drawn, F.substring(F.col(text_col), at, F.lit(chars))).collect()
    out, taken = [], Counter()
    for lang, _, text in sorted(found, key=lambda r: (r[0], r[1])):
        taken[lang] += 1
        if taken[lang] <= each:
            out.append((text, lang))
    return out


def held_out(id_col: str = "doc_id") -> Column:
    """Rows that are never learned from; null ids are none of them."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          sample_rows: int = SAMPLE_ROWS, excerpt_chars: int = EXCERPT_CHARS) -> Model | None:
    samples = sample(docs, ~held_out(id_col) & F.col(id_col).isNotNull(), id_col, text_col, lang_col, sample_rows, excerpt_chars)
    return fit(samples) if samples else None


def identify(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text",
             keep: list[str] | None = None, out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """One row per row of ``docs``: ``id_col`` (or all columns of ``keep``), and
    language and score under the names ``out``.

    Null texts and texts without letters are ``und`` with score 0, as is every
    text where nothing could be learned.  Ties go to the first language in
    alphabetical order.  Repeated rows stay; other columns are ignored.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = keep or [id_col]
    count = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # long sequences set the number of steps, so many texts go together
            for part, texts in pieces(batch, "__t", 3_000_000):
                languages, scores = predict(shared.value, texts)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:count], pa.array(languages, pa.string()), pa.array(scores, pa.float64())],
                    names=[*part.schema.names[:count], "lang_pred", "score"])

    # numbered names: columns of the caller may be called anything
    d = docs.select(*[F.col(c).alias(f"__{i}") for i, c in enumerate(names)], F.col(text_col).alias("__t"))
    schema = T.StructType([*d.schema.fields[:count], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return d.mapInArrow(run, schema).toDF(*names, *out)
