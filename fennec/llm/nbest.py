"""N-best segmentation with a SentencePiece vocabulary, and decoding.

A text is a lattice: every vocabulary piece that spells the letters between two
places is an arc with the piece's score; a letter that is no piece is an arc
scored below all pieces and spelled by byte pieces.  The best segmentation is
the path of the highest total; the n best come from a backward A-star search
whose heuristic is the forward Viterbi score of a place, which is exact: every
hypothesis is expanded in the order of the total it will reach.

No piece spans two neighbouring letters that stand next to each other in no
piece, so such places cut the lattice into independent segments.  Segments
recur across texts and are scored once (many at a time, in numpy): best path
and regret, the loss of the second-best path.  A text's n best paths differ
from its best one only in the n - 1 segments of least regret (each smaller
single change is itself one of the n), so A-star runs on these alone and the
results are merged.

Encoding is lossless: ``decode`` gives back every text, also where the text
holds the space mark itself (it is spelled by bytes).
"""

from __future__ import annotations

import functools
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .arrow import PIECE_CHARS, WordCache, pieces

SPACE = chr(0x2581)
#: Stands for a space mark of the text itself; no UTF-8 text can hold it.
_OWN_MARK = chr(0xD800)
N_BEST = 4
#: Longer segments are scored one by one.
_LONG = 64


class Segmenter:
    def __init__(self, path: str):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        size = sp.get_piece_size()
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        names = [sp.id_to_piece(i) for i in range(size)]
        special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(size)]
        is_byte = [sp.is_byte(i) for i in range(size)]
        self.byte_id = {int(names[i][3:5], 16): i for i in range(size) if is_byte[i]}
        self.spelled = [bytes([int(n[3:5], 16)]) if b else b"" if s else n.replace(SPACE, " ").encode()
                        for n, s, b in zip(names, special, is_byte)]
        plain = {n: i for i, n in enumerate(names) if not special[i] and not is_byte[i]}
        self.scores = np.array([sp.get_score(i) for i in range(size)])
        self.unknown = min(self.scores[list(plain.values())]) - 10.0
        # the pieces as a trie: (node, letter) -> node, for one text and for many
        self.child: dict[tuple[int, str], int] = {}
        self.piece_at = [-1]
        pairs = set()
        for name, i in plain.items():
            node = 0
            for c in name:
                nxt = self.child.get((node, c))
                if nxt is None:
                    nxt = self.child[node, c] = len(self.piece_at)
                    self.piece_at.append(-1)
                node = nxt
            self.piece_at[node] = i
            pairs.update(zip(name, name[1:]))
        edges = sorted(((node << 21) | ord(c), to) for (node, c), to in self.child.items())
        self.edge, self.to = np.array([e for e, _ in edges], np.int64), np.array([t for _, t in edges], np.int64)
        self.piece_of = np.array(self.piece_at, np.int64)
        self.pairs = np.array(sorted(ord(a) << 21 | ord(b) for a, b in pairs), np.int64)
        self.near = np.zeros((1024, 1024), bool)
        for a, b in pairs:
            if ord(a) < 1024 and ord(b) < 1024:
                self.near[ord(a), ord(b)] = True
        self.best_of = WordCache(self.best)
        self.nbest_of: dict[tuple[str, int], list] = {}

    # -- texts and segments ------------------------------------------------

    @staticmethod
    def marked(text: str) -> str:
        """The text as it is segmented: spaces as marks, one before the text."""
        return SPACE + text.replace(SPACE, _OWN_MARK).replace(" ", SPACE) if text else ""

    def _cuts(self, marked: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The code points of all texts, where segments start and end (no piece
        spans a cut), and where each text's cuts end."""
        p = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), np.uint32)
        limits = np.cumsum([len(m) for m in marked])
        if not len(p):
            return p, np.zeros(1, np.int64), limits
        a, b = p[:-1], p[1:]
        small = (a < 1024) & (b < 1024)
        together = self.near[np.where(small, a, 0), np.where(small, b, 0)] & small
        rest = np.flatnonzero(~small)
        if len(rest):
            key = a[rest].astype(np.int64) << 21 | b[rest]
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            together[rest] = self.pairs[at] == key
        together[limits[(limits > 0) & (limits < len(p))] - 1] = False
        cuts = np.concatenate([[0], np.flatnonzero(~together) + 1, [len(p)]])
        return p, cuts, np.searchsorted(cuts, limits)

    def segments(self, marked: list[str]) -> tuple[list[str], list[int]]:
        """The segments of all texts, and where each text's end."""
        whole = "".join(marked)
        _, cuts, limits = self._cuts(marked)
        places = cuts.tolist()
        return [whole[i:j] for i, j in zip(places, places[1:])], limits.tolist()

    def _bytes_of(self, c: str) -> tuple[int, ...]:
        return tuple(self.byte_id[x] for x in (SPACE if c == _OWN_MARK else c).encode())

    # -- one lattice ---------------------------------------------------------

    def lattice(self, s: str) -> list[list[tuple[int, float, tuple[int, ...]]]]:
        """Per end place the arcs to it: start, score, ids."""
        into: list[list] = [[] for _ in range(len(s) + 1)]
        child, piece_at = self.child, self.piece_at
        for i in range(len(s)):
            node, single = 0, False
            for j in range(i, len(s)):
                node = child.get((node, s[j]))
                if node is None:
                    break
                p = piece_at[node]
                if p >= 0:
                    into[j + 1].append((i, float(self.scores[p]), (p,)))
                    single |= j == i
            if not single:
                into[i + 1].append((i, self.unknown, self._bytes_of(s[i])))
        return into

    def nbest(self, s: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """The ``n`` best paths (fewer if there are no more): score and ids."""
        into = self.lattice(s)
        ahead = [0.0] + [0.0] * len(s)  # forward Viterbi: best score from the start to a place
        for j in range(1, len(s) + 1):
            ahead[j] = max(ahead[i] + score for i, score, _ in into[j])
        found, serial = [], 0
        heap = [(-ahead[len(s)], 0, len(s), 0.0, None)]
        while heap and len(found) < n:
            total, _, at, behind, path = heapq.heappop(heap)
            if at == 0:
                ids: list[int] = []
                while path is not None:
                    ids += path[0]
                    path = path[1]
                found.append((-total, tuple(ids)))
                continue
            for i, score, ids in into[at]:
                serial += 1
                heapq.heappush(heap, (-(ahead[i] + score + behind), serial, i, score + behind, (ids, path)))
        return found

    # -- many lattices -------------------------------------------------------

    def best(self, segs: list[str]) -> list[tuple[bytes, float, float]]:
        """Per segment: ids of the best path, its score, and the second one's loss."""
        out: list = [None] * len(segs)
        many = []
        for k, s in enumerate(segs):
            if len(s) <= _LONG:
                many.append(k)
            else:
                top = self.nbest(s, 2)
                out[k] = (np.array(top[0][1], self.kind).tobytes(), top[0][0], top[0][0] - top[1][0] if len(top) > 1 else np.inf)
        for at in range(0, len(many), 20_000):
            some = many[at:at + 20_000]
            for k, value in zip(some, self._best_short([segs[k] for k in some])):
                out[k] = value
        return out

    def _best_short(self, segs: list[str]) -> list[tuple[bytes, float, float]]:
        n = np.array([len(s) for s in segs])
        first = np.concatenate([[0], np.cumsum(n)[:-1]])
        p = np.frombuffer("".join(segs).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        word = np.repeat(np.arange(len(segs)), n)
        stop = np.repeat(first + n, n)
        # walk the trie from all places at once, one letter further in each round
        at, node = np.arange(len(p)), np.zeros(len(p), np.int64)
        starts, ends, ids = [], [], []
        single = np.zeros(len(p), bool)
        step = 0
        while len(at):
            key = node << 21 | p[at + step]
            place = np.minimum(np.searchsorted(self.edge, key), len(self.edge) - 1)
            ok = self.edge[place] == key
            at, node = at[ok], self.to[place[ok]]
            step += 1
            piece = self.piece_of[node]
            is_piece = piece >= 0
            starts.append(at[is_piece])
            ends.append(at[is_piece] + step)
            ids.append(piece[is_piece])
            if step == 1:
                single[at[is_piece]] = True
            go = at + step < stop[at]
            at, node = at[go], node[go]
        lone = np.flatnonzero(~single)
        s = np.concatenate([*starts, lone])
        e = np.concatenate([*ends, lone + 1])
        i = np.concatenate([*ids, np.full(len(lone), -1)])
        score = np.where(i >= 0, self.scores[i], self.unknown)
        w = word[s]
        s_node, e_node = s + w, e + w  # a segment of n letters has n + 1 places
        # forward, by place within the segment; equal totals: the longest last piece
        order = np.lexsort((s, e_node, e - first[w]))
        s_node, e_node, i, score, w, e_rel = s_node[order], e_node[order], i[order], score[order], w[order], (e - first[w])[order]
        group = np.flatnonzero(np.concatenate([[True], e_node[1:] != e_node[:-1]]))
        bound = np.searchsorted(e_rel, np.arange(1, int(n.max()) + 2))
        g_bound = np.searchsorted(group, bound)
        ahead = np.zeros(len(p) + len(segs))
        best_arc = np.full(len(ahead), -1)
        for j in range(len(bound) - 1):
            lo, hi = bound[j], bound[j + 1]
            if lo == hi:
                continue
            heads = group[g_bound[j]:g_bound[j + 1]]
            total = ahead[s_node[lo:hi]] + score[lo:hi]
            top = np.maximum.reduceat(total, heads - lo)
            sizes = np.diff(np.concatenate([heads, [hi]]))
            is_top = np.flatnonzero(total == np.repeat(top, sizes))
            owner = np.searchsorted(heads - lo, is_top, side="right") - 1
            _, one = np.unique(owner, return_index=True)
            ahead[e_node[heads]] = top
            best_arc[e_node[heads]] = is_top[one] + lo
        # backward, from the ends
        last = first + n + np.arange(len(segs))
        behind = np.zeros(len(ahead))
        s_rel = s_node - w - first[w]
        back = np.lexsort((s_node, -s_rel))
        b_group = np.flatnonzero(np.concatenate([[True], s_node[back][1:] != s_node[back][:-1]]))
        b_rel = -s_rel[back]
        b_bound = np.searchsorted(b_rel, np.arange(-int(n.max()) + 1, 2))
        gb_bound = np.searchsorted(b_group, b_bound)
        for j in range(len(b_bound) - 1):
            lo, hi = b_bound[j], b_bound[j + 1]
            if lo == hi:
                continue
            arcs = back[lo:hi]
            heads = b_group[gb_bound[j]:gb_bound[j + 1]]
            top = np.maximum.reduceat(behind[e_node[arcs]] + score[arcs], heads - lo)
            behind[s_node[back[heads]]] = top
        # follow the best arcs from the ends
        on_path = np.zeros(len(i), bool)
        place = last
        while len(place):
            arc = best_arc[place]
            on_path[arc] = True
            place = s_node[arc]
            place = place[best_arc[place] >= 0]
        through = np.where(on_path, -np.inf, ahead[s_node] + score + behind[e_node])
        second = np.full(len(segs), -np.inf)
        np.maximum.at(second, w, through)
        best = ahead[last]
        path = np.flatnonzero(on_path)
        path = path[np.argsort(s_node[path], kind="stable")]
        count = np.bincount(w[path], minlength=len(segs))
        at = np.concatenate([[0], np.cumsum(count)])
        whole = np.where(i[path] >= 0, i[path], 0).astype(self.kind).tobytes()
        byte_spelled = set(w[path][i[path] < 0].tolist())
        size = self.kind.itemsize
        out = []
        for k, seg in enumerate(segs):
            a, b = int(at[k]), int(at[k + 1])
            if k in byte_spelled:
                ids_k: list[int] = []
                for arc in path[a:b]:
                    ids_k += (int(i[arc]),) if i[arc] >= 0 else self._bytes_of(seg[int(s_node[arc] - k - first[k])])
                spelled = np.array(ids_k, self.kind).tobytes()
            else:
                spelled = whole[a * size:b * size]
            out.append((spelled, float(best[k]), float(max(best[k] - second[k], 0.0))))
        return out

    # -- whole texts ---------------------------------------------------------

    def encode(self, text: str, n: int = 1) -> list[tuple[float, bytes]]:
        return next(self.encode_all([text], n))

    def encode_all(self, texts: list[str], n: int = 1) -> Iterator[list[tuple[float, bytes]]]:
        """Per text the ``n`` best segmentations: total score and ids (bytes of
        ``kind``).  Segments are told apart in Arrow; those new to the cache
        are scored for all texts at once."""
        marked = [self.marked(t) for t in texts]
        owned = [_OWN_MARK in m for m in marked]  # these hold what Arrow's strings cannot
        segs, limits = self.segments([m for m, o in zip(marked, owned) if o])
        slow = (segs, limits, self.best_of.values_of(segs))
        plain = [m for m, o in zip(marked, owned) if not o]
        p, cuts, ends = self._cuts(plain)
        width = 1 + (p >= 0x80).astype(np.int64) + (p >= 0x800) + (p >= 0x10000)
        offsets = np.concatenate([[0], np.cumsum(width)])[cuts]
        count = len(cuts) - 1
        coded = pa.LargeStringArray.from_buffers(
            count, pa.py_buffer(offsets.tobytes()), pa.py_buffer("".join(plain).encode())).dictionary_encode()
        code = np.asarray(coded.indices)
        values = self.best_of.values_of(coded.dictionary.to_pylist())
        parts, scores, regrets = zip(*values) if values else ((), (), ())
        size = self.kind.itemsize
        length = np.fromiter(map(len, parts), np.int64, len(parts)) // size
        flat, start = np.frombuffer(b"".join(parts), self.kind), np.concatenate([[0], np.cumsum(length)])
        took = length[code]
        first = np.concatenate([[0], np.cumsum(took)])
        ids = flat[np.repeat(start[code] - first[:-1], took) + np.arange(int(first[-1]))].tobytes()
        score, regret = np.array(scores)[code] if count else np.zeros(0), np.array(regrets)[code] if count else np.zeros(0)
        names = coded.dictionary
        quick, late, begin = 0, 0, 0
        for own in owned:
            if own:
                a, b = (slow[1][late - 1] if late else 0), slow[1][late]
                late += 1
                own_parts, own_scores, own_regrets = zip(*slow[2][a:b])
                yield self._ranked(float(sum(own_scores)), b"".join(own_parts), np.array(own_regrets),
                                   np.concatenate([[0], np.cumsum([len(x) for x in own_parts])]), lambda k, a=a: segs[a + k], n)
            else:
                a, b = begin, int(ends[quick])
                quick, begin = quick + 1, b
                yield self._ranked(float(score[a:b].sum()), ids[first[a] * size:first[b] * size], regret[a:b],
                                   (first[a:b + 1] - first[a]) * size, lambda k, a=a: names[int(code[a + k])].as_py(), n)

    def _ranked(self, total: float, best: bytes, regret: np.ndarray, offsets: np.ndarray, segment, n: int) -> list[tuple[float, bytes]]:
        """The best path and, by the segments of least regret, the next ones."""
        ranked = [(total, best)]
        if n == 1 or not len(regret):
            return ranked
        few = np.flatnonzero(np.isfinite(regret))
        if len(few) > n - 1:
            limit = np.partition(regret[few], n - 2)[n - 2]
            few = few[regret[few] <= limit]
            few = few[np.argsort(regret[few], kind="stable")][:n - 1]
        options: list[tuple[float, tuple[tuple[int, int], ...]]] = [(0.0, ())]
        for k in sorted(few.tolist()):
            top = self._nbest_cached(segment(k), n)
            options = sorted(((loss + top[0][0] - t[0], (*chosen, (k, r)) if r else chosen)
                              for loss, chosen in options for r, t in enumerate(top)), key=lambda o: o[0])[:n]
        for loss, chosen in options[1:]:
            pieces_, at = [], 0
            for k, r in chosen:
                pieces_ += best[at:offsets[k]], np.array(self._nbest_cached(segment(k), n)[r][1], self.kind).tobytes()
                at = offsets[k + 1]
            ranked.append((total - loss, b"".join([*pieces_, best[at:]])))
        return ranked

    def _nbest_cached(self, seg: str, n: int):
        if len(self.nbest_of) > 5_000:
            self.nbest_of.clear()
        got = self.nbest_of.get((seg, n))
        if got is None:
            got = self.nbest_of[seg, n] = self.nbest(seg, n)
        return got

    def decode(self, ids) -> str:
        """The text that ids (any segmentation) spell."""
        spelled = self.spelled
        return b"".join(map(spelled.__getitem__, ids)).decode("utf-8", "replace")[1:]


@functools.lru_cache(maxsize=2)
def segmenter(path: str) -> Segmenter:
    return Segmenter(path)


def _default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def digests(docs: DataFrame, n: int = N_BEST, id_col: str = "doc_id", text_col: str = "text", model: str | None = None,
            keep: list[str] | None = None, with_ids: bool = False) -> DataFrame:
    """One row per document: ``id_col``, the columns of ``keep``, ``n_found``
    (segmentations, at most ``n``), and by rank ``scores``, ``n_pieces``, ``ids_crc32``
    (of the ids as little-endian unsigned 32-bit integers); ``round_trip``: the best
    one decodes to the text; ``ids`` of the best one, if wanted.

    Null texts are empty; an empty text has one segmentation without pieces.
    Repeated rows stay; other columns are ignored.
    """
    path = model or _default_model()

    names = [id_col, *(keep or [])]
    count = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = segmenter(path)
        for batch in batches:
            for part, texts in pieces(batch, "__t", 500_000 if with_ids else PIECE_CHARS):
                rows, ids_of = [], []
                for text, best in zip(texts, seg.encode_all(texts, n)):
                    ranked = [(score, np.frombuffer(ids, seg.kind)) for score, ids in best]
                    rows.append((len(ranked), [r[0] for r in ranked], [len(r[1]) for r in ranked],
                                 [zlib.crc32(r[1].astype("<u4").tobytes()) for r in ranked],
                                 seg.decode(ranked[0][1].tolist()) == text))
                    ids_of.append(ranked[0][1].astype(np.int32) if with_ids else None)
                kinds = [pa.int32(), pa.list_(pa.float64()), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.bool_()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:count], *[pa.array(c, t) for c, t in zip(zip(*rows), kinds)], pa.array(ids_of, pa.list_(pa.int32()))],
                    names=[*part.schema.names[:count], "n_found", "scores", "n_pieces", "ids_crc32", "round_trip", "ids"])

    d = docs.select(*[F.col(c).alias(f"__{i}") for i, c in enumerate(names)], F.col(text_col).alias("__t"))
    found = T.StructType.fromDDL("n_found int, scores array<double>, n_pieces array<int>, ids_crc32 array<bigint>, round_trip boolean, ids array<int>")
    out = d.mapInArrow(run, T.StructType([*d.schema.fields[:count], *found.fields])).toDF(*names, *found.names)
    return out if with_ids else out.drop("ids")


def encode(docs: DataFrame, n: int = 1, id_col: str = "doc_id", text_col: str = "text", model: str | None = None,
           keep: list[str] | None = None) -> DataFrame:
    """One row per document and segmentation: ``id_col``, ``rank`` (from 0),
    ``score``, ``ids``, and the columns of ``keep``.  Cases as in ``digests``."""
    path = model or _default_model()
    names = [id_col, *(keep or [])]
    count = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = segmenter(path)
        for batch in batches:
            for part, texts in pieces(batch, "__t", 500_000):
                found = list(seg.encode_all(texts, n))
                owner = pa.array([i for i, f in enumerate(found) for _ in f], pa.int64())
                ids = [np.frombuffer(b, seg.kind).astype(np.int32) for f in found for _, b in f]
                offsets = np.cumsum([0, *map(len, ids)]).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*[c.take(owner) for c in part.columns[:count]], pa.array([r for f in found for r in range(len(f))], pa.int32()),
                     pa.array([s for f in found for s, _ in f], pa.float64()),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(ids) if ids else [], pa.int32()))],
                    names=[*part.schema.names[:count], "rank", "score", "ids"])

    d = docs.select(*[F.col(c).alias(f"__{i}") for i, c in enumerate(names)], F.col(text_col).alias("__t"))
    out = T.StructType([*d.schema.fields[:count], T.StructField("rank", T.IntegerType()), T.StructField("score", T.DoubleType()),
                        T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return d.mapInArrow(run, out).toDF(*names, "rank", "score", "ids")


def decode(rows: DataFrame, keep: list[str], ids_col: str = "ids", model: str | None = None) -> DataFrame:
    """``keep`` + ``text``: what the ids spell (null ids: null)."""
    path = model or _default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seg = segmenter(path)
        for batch in batches:
            texts = [None if ids is None else seg.decode(ids) for ids in batch.column("__ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(texts, pa.string())], names=[*keep, "text"])

    d = rows.select(*keep, F.col(ids_col).alias("__ids"))
    schema = ", ".join(f"`{c}` {d.schema[c].dataType.simpleString()}" for c in keep)
    return d.mapInArrow(run, f"{schema}, text string")
