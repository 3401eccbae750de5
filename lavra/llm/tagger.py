"""A character-level bidirectional LSTM with CRF transitions, in numpy: scores, decoding and training.

The input of a cell is a row of a table indexed by the class of the character, so that the product with the input weights is a
look-up. Long texts are cut into overlapping windows; the scores of overlapping windows are blended, each by its distance from
the window's edge, and one Viterbi search over the blended scores decides for the whole text.
"""

from __future__ import annotations

import io
import unicodedata
from collections.abc import Sequence

import numpy as np

WINDOW, OVERLAP = 320, 32
STRETCH, APART = 8, -1e4  # characters looked at together; the gain of what stands between two texts, less than any
AROUND = 12  # characters searched beside those that an item could hold
BLOCK = 16  # steps that are worked on while they are in the cache
TOGETHER = 384  # windows that are worked on together, so that a step of theirs stays in the cache
ROOM = 2**27  # bytes of scores that are kept from call to call; what a longer text takes is given back
_PUNCT = " \n\t.,;:!?@()[]{}<>-_+/\\'\"#%&*=|º°–—“”«»"


def _classes() -> tuple[np.ndarray, int]:
    """Class of every code point of the basic plane: letters by base letter and case, digits, punctuation, marks, the rest."""
    table = np.ones(0x10000, dtype=np.int16)
    for c in range(0x250):
        base = unicodedata.normalize("NFKD", chr(c))[:1]
        if "a" <= base <= "z":
            table[c] = 2 + ord(base) - 97
        elif "A" <= base <= "Z":
            table[c] = 28 + ord(base) - 65
        elif "0" <= base <= "9" and chr(c).isdigit():
            table[c] = 54 + ord(base) - 48
    for i, p in enumerate(_PUNCT):
        table[ord(p)] = 64 + i
    table[ord("\r")] = table[0xA0] = 64
    for lo, hi in ((0xFB00, 0xFB07), (0x2010, 0x2012)):
        table[lo:hi] = 2 + 5 if lo == 0xFB00 else 64 + _PUNCT.index("-")
    table[0x300:0x370] = 64 + len(_PUNCT)
    return table, 65 + len(_PUNCT)


_CLASS_OF, CLASSES = _classes()


def encode(text: str) -> np.ndarray:
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return _CLASS_OF.take(points, mode="clip")


def _gate(x: np.ndarray) -> np.ndarray:
    """The hard sigmoid in place: a clipped line."""
    x *= 0.25
    x += 0.5
    return np.clip(x, 0, 1, out=x)


def _soft(x: np.ndarray) -> np.ndarray:
    """The softsign, which takes the place of the hyperbolic tangent."""
    return x / (1 + np.abs(x))


def _windows(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of the windows of texts of these sizes: as few as cover each, of like length, each with the first ``OVERLAP``
    characters of the next."""
    parts = np.where(sizes > 0, np.maximum(1, -(-(sizes - OVERLAP) // (WINDOW - OVERLAP))), 0)
    of = np.repeat(np.arange(len(sizes)), parts)
    i, long = np.arange(len(of)) - (np.cumsum(parts) - parts)[of], (sizes - OVERLAP)[of]
    cuts = (np.rint(k * long / parts[of]).astype(np.int64) for k in (i, i + 1))
    return of, next(cuts), next(cuts) + OVERLAP


def windows_of(size: int) -> list[tuple[int, int]]:
    """(start, end) of the windows of a text."""
    _, starts, ends = _windows(np.array([size]))
    return list(zip(starts.tolist(), ends.tolist()))


def _best_runs(gain: np.ndarray) -> np.ndarray:
    """For each character what the run gains that gains most among those that hold it."""
    total = np.zeros(len(gain) + 1)
    np.cumsum(gain, out=total[1:])
    return np.maximum.accumulate(total[:0:-1])[::-1] - np.minimum.accumulate(total[:-1])


def _paying(gain: np.ndarray, need: float) -> np.ndarray:
    """The characters that a run holds that gains more than is needed; their number is a multiple of ``STRETCH``.

    Stretches of ``STRETCH`` characters are looked at first: a run gains at most all gains without the losses in the stretches
    of its ends, and gains and losses between them. A run that pays lies in stretches that could pay."""
    rows = gain.reshape(-1, STRETCH)
    whole, most = ((r @ np.ones(STRETCH, np.float32)).astype(np.float64) for r in (rows, np.maximum(rows, 0)))
    whole, most = whole + 1e-3, most * 1.0001 + 1e-3  # in double precision, and more than single precision loses
    ends = np.cumsum(whole)
    # the most that a run brings along from the stretches before and after
    left, right = np.zeros(len(whole)), np.zeros(len(whole))
    left[1:] = np.maximum(np.maximum.accumulate(most - ends)[:-1] + ends[:-1], 0)
    right[:-1] = np.maximum(np.maximum.accumulate((most + ends - whole)[::-1])[::-1][1:] - ends[:-1], 0)
    could = np.flatnonzero(np.maximum(most + np.maximum(left, right), whole + left + right) > need)
    if not len(could):
        return could
    # the runs of these stretches, each row of neighbours by itself
    place = np.arange(len(could)) + np.concatenate([[0], np.cumsum(np.diff(could) > 1)])
    exact = np.full((place[-1] + 2, STRETCH), APART)
    exact[place] = rows[could]
    held = _best_runs(exact.ravel()).reshape(-1, STRETCH)[place] > need
    return (could[:, None] * STRETCH + np.arange(STRETCH))[held]


def _regions(near: np.ndarray, starts: np.ndarray, ends: np.ndarray, around: int) -> list[tuple[int, int, int]]:
    """(text, start, end) of the parts of texts, which stand one behind the other, that hold these characters and those around them."""
    of = np.searchsorted(starts, near, "right") - 1
    cuts = np.flatnonzero((np.diff(near) > 2 * around) | (np.diff(of) > 0))
    first, last = (np.concatenate(x).astype(np.intp)[: len(near)] for x in ([[0], cuts + 1], [cuts, [len(near) - 1]]))
    of = of[first]
    return list(zip(of.tolist(), np.maximum(starts[of], near[first] - around).tolist(), np.minimum(ends[of], near[last] + around + 1).tolist()))


class CharTagger:
    """Weights: ``x`` (classes x 4H), ``h`` (H x 4H) and ``o`` (H x tags) for each direction; ``bias``; ``trans``."""

    NAMES = ("xf", "hf", "of", "xb", "hb", "ob", "bias", "trans")

    def __init__(self, weights: dict[str, np.ndarray]):
        self.w = {k: np.asarray(v, dtype=np.float32) for k, v in weights.items()}
        self.hidden, self.tags = self.w["of"].shape
        self._room = np.empty(0, np.float32)  # for the scores of a call, as new memory costs time

    @classmethod
    def fresh(cls, hidden: int, tags: int, seed: int = 0) -> CharTagger:
        rng = np.random.default_rng(seed)
        w: dict[str, np.ndarray] = {}
        for d in "fb":
            w["x" + d] = rng.normal(0, 0.3, (CLASSES, 4 * hidden))
            w["x" + d][:, hidden : 2 * hidden] += 1  # forget gates start open
            w["h" + d] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, 4 * hidden))
            w["o" + d] = rng.normal(0, 1 / np.sqrt(hidden), (hidden, tags))
        w["bias"], w["trans"] = np.zeros(tags), np.zeros((tags, tags))
        return cls(w)

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez_compressed(out, **{k: v.astype(np.float16) for k, v in self.w.items()})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> CharTagger:
        with np.load(io.BytesIO(data)) as z:
            return cls({k: z[k] for k in cls.NAMES})

    def _blocks(self) -> tuple[np.ndarray, np.ndarray]:
        """Look-up table (classes, 4H), the classes of the backward direction behind those of the forward one, and recurrent weights
        (2, H, 4H), for the gates o, i, f, g. The line of the hard sigmoid is folded into those of the first three."""
        gates = (np.array([2, 0, 1, 3])[:, None] * self.hidden + np.arange(self.hidden)).ravel()
        slope, base = (np.repeat(np.float32(q), self.hidden) for q in ([0.25, 0.25, 0.25, 1], [0.5, 0.5, 0.5, 0]))
        into = np.concatenate([self.w["x" + d][:, gates] * slope + base for d in "fb"])
        # in rows, as what is picked by columns need not be
        return np.ascontiguousarray(into), np.ascontiguousarray([self.w["h" + d][:, gates] * slope for d in "fb"])

    def scores(self, ids: np.ndarray, sizes: np.ndarray | None = None, room: np.ndarray | None = None) -> np.ndarray:
        """Scores (steps, rows, tags) of windows of classes (rows, steps), in ``room`` if there is any. With ``sizes``, ascending, the
        backward cells rest in the padding behind a shorter window, whose own scores mean nothing. Both directions go in step, so that
        a call serves both."""
        (rows, steps), tags = ids.shape, self.tags
        out = np.empty((steps, rows, tags), np.float32) if room is None else room[: steps * rows * tags].reshape(steps, rows, tags)
        some = -(-rows // max(1, -(-rows // TOGETHER)))  # in parts of like size
        for a in range(0, rows, max(1, some)):
            self._run(ids[a : a + some], None if sizes is None else sizes[a : a + some], out[:, a : a + some])
        return out

    def _run(self, ids: np.ndarray, sizes: np.ndarray | None, out: np.ndarray) -> None:
        """The scores of some windows, into ``out``."""
        (rows, steps), n, tags = ids.shape, self.hidden, self.tags
        padded = np.searchsorted(sizes, np.arange(steps), side="right").tolist() if sizes is not None else [0] * steps
        by_step = np.empty((steps, 2 * rows), np.intp)
        by_step[:, :rows] = ids.T
        np.add(by_step[::-1, :rows], CLASSES, out=by_step[:, rows:])
        into, wh = self._blocks()
        held, h, z = np.zeros((5, 2, rows, n), np.float32), np.zeros((2, rows, n), np.float32), np.empty((2, rows, 4 * n), np.float32)
        gates, o, i_f, g_c, g, c = held[:3], held[0], held[1:3], held[3:], held[3], held[4]  # i meets g and f meets c in one product
        # all gates in one product, which takes far less time than one by one, then its rows are cut and laid gate by gate
        flat, by_gate, apart = z.reshape(2 * rows, 4 * n), held[:4].reshape(8 * rows, n), np.arange(8 * rows).reshape(-1, 4).T.ravel()
        x, u = held[:4].reshape(flat.shape), h  # in memory that is free just then, so that all stays in the cache
        one, zero, wo = np.float32(1), np.float32(0), np.stack([self.w["of"], self.w["ob"]])
        found, bias = np.empty((2, rows, tags), np.float32), np.tile(self.w["bias"], (2, rows, 1))
        # looked up once, as the calls are short
        matmul, add, multiply, divide, absolute, clip = np.matmul, np.add, np.multiply, np.divide, np.absolute, gates.clip
        look_up, cut = into.take, z.reshape(8 * rows, n).take
        for t in range(steps):
            matmul(h, wh, z)
            look_up(by_step[t], 0, x, "clip")
            add(flat, x, flat)
            cut(apart, 0, by_gate, "clip")
            clip(zero, one, gates)
            absolute(g, u)
            add(u, one, u)
            divide(g, u, g)
            multiply(g_c, i_f, g_c)
            add(c, g, c)
            absolute(c, u)
            add(u, one, u)
            divide(c, u, u)
            multiply(u, o, h)
            back = steps - 1 - t
            if rest := padded[back]:
                h[1, :rest], c[1, :rest] = 0, 0
            if t < back:  # the first to come
                matmul(h, wo, out[t : back + 1 : back - t])
                continue
            matmul(h, wo, found)
            if t == back:
                add(found[0], found[1], out[t])
                add(out[t], bias[0], out[t])
            else:  # the second brings the bias along
                add(found, bias, found)
                both = out[back : t + 1 : t - back][::-1]
                add(both, found, both)

    def _read(self, texts: Sequence[str], rows: int, each=None) -> tuple[np.ndarray, tuple[np.ndarray, ...], list[np.ndarray]]:
        """Where the texts end, one behind the other; starts and ends of their windows, and which are first and last; the scores
        (characters, tags) of each window. ``each``, if any, gets the starts, sizes and scores of the windows of every call, and scores are
        kept in the tagger's own room until the next time."""
        lengths = np.array([len(t) for t in texts], np.int64)
        of, starts, ends = _windows(lengths)
        places, first, last = np.cumsum(lengths) - lengths, starts == 0, ends == lengths[of]
        starts, ends = starts + places[of], ends + places[of]
        codes = np.concatenate([*map(encode, texts), np.zeros(WINDOW, np.int16)])
        order, found = np.argsort(ends - starts, kind="stable"), [codes] * len(of)
        rows = -(-len(of) // max(1, -(-len(of) // rows)))  # in parts of like size
        parts = [order[at : at + rows] for at in range(0, len(of), max(1, rows))]
        if each and len(self._room) < (need := sum(len(p) * int(ends[p[-1]] - starts[p[-1]]) for p in parts) * self.tags):
            self._room = np.empty(need, np.float32)
        room = self._room
        for part in parts:
            start, sizes = starts[part], ends[part] - starts[part]
            ids = codes[start + np.arange(sizes[-1])[:, None]].T
            if each:
                scores, room = self.scores(ids, sizes, room), room[ids.size * self.tags :]
                each(start, sizes, scores)
            else:
                scores = self.scores(ids, sizes)
            for r, (w, size) in enumerate(zip(part.tolist(), sizes.tolist())):
                found[w] = scores[:size, r]
        return places + lengths, (starts, ends, first, last), found

    def _blended(self, spans: Sequence[tuple[int, int]], windows: tuple[np.ndarray, ...], found: Sequence[np.ndarray]) -> list[np.ndarray]:
        """Scores (characters, tags) of whole texts or parts of them from those of their windows."""
        rising, out = np.arange(1, OVERLAP + 1, dtype=np.float32) / np.float32(OVERLAP + 1), []
        starts, ends, firsts, lasts = windows
        begin, stop = np.searchsorted(ends, [a for a, _ in spans], "right"), np.searchsorted(starts, [b for _, b in spans])
        for (a, b), i, j in zip(spans, begin.tolist(), stop.tolist()):
            out.append(np.zeros((b - a, self.tags), np.float32))
            for w in range(i, j):
                start, end = int(starts[w]), int(ends[w])
                lo, hi = max(a, start), min(b, end)
                piece = found[w][lo - start : hi - start]
                if not firsts[w] and lo < start + OVERLAP or not lasts[w] and hi > end - OVERLAP:
                    weights = np.ones((end - start, 1), np.float32)
                    if not firsts[w]:
                        weights[:OVERLAP, 0] = rising
                    if not lasts[w]:
                        weights[-OVERLAP:, 0] = rising[::-1]
                    piece = piece * weights[lo - start : hi - start]
                out[-1][lo - a : hi - a] += piece
        return out

    def text_scores(self, texts: Sequence[str], rows: int = 768) -> list[np.ndarray]:
        """Scores (characters, tags) of whole texts, blended from overlapping windows."""
        ends, windows, found = self._read(texts, rows)
        return self._blended([(b - len(t), b) for t, b in zip(texts, ends.tolist())], windows, found)

    def tag(self, texts: Sequence[str], rows: int = 768) -> list[np.ndarray]:
        """The best tags of whole texts, the same as ``decode(text_scores(texts))``. Every character is scored; scores are blended and
        searched only around the runs that pay by the leads of their characters (``_leads``), as no other run pays for any kind."""
        lead = np.full(-(-sum(map(len, texts)) // STRETCH) * STRETCH, APART, np.float32)

        def each(starts: np.ndarray, sizes: np.ndarray, scores: np.ndarray) -> None:
            for a, size, most in zip(starts.tolist(), sizes.tolist(), self._leads(scores)):
                e = lead[a : a + size]
                np.maximum(e, most[:size], e)

        ends, windows, found = self._read(texts, rows, each)
        starts = ends - [len(t) for t in texts]
        near = _paying(lead, min((need for _, _, need in self._kinds()), default=np.inf))  # runs over two texts are harmless
        regions, tags = _regions(near, starts, ends, AROUND), [np.zeros(len(t), np.int8) for t in texts]
        for (i, a, b), best in zip(regions, self.decode(self._blended([r[1:] for r in regions], windows, found))):
            tags[i][a - starts[i] : b - starts[i]] = best
        if self._room.nbytes > ROOM:
            self._room = np.empty(0, np.float32)
        return tags

    def _kinds(self) -> list[tuple[int, float, float]]:
        """The first tag of each kind, what is added to the lead of its characters over tag 0, and what an item must gain to pay."""
        trans, out = self.w["trans"].astype(np.float64), []
        for b in range(1, self.tags, 2):
            on = trans[b + 1, b + 1]
            out.append((b, on - trans[0, 0], -self.EDGE - (trans[0, b] + trans[b, b + 1] + trans[b + 1, 0] - 2 * on - trans[0, 0])))
        return out

    def _leads(self, scores: np.ndarray) -> np.ndarray:
        """For windows (steps, rows, tags) the most that a character gains in an item of any kind (rows, steps), in units of the least that
        an item must gain. Blended scores gain no more than the larger of the two that they are blended from."""
        kinds, (steps, rows, _) = self._kinds(), scores.shape
        least, out = min((need for _, _, need in kinds), default=1.0), np.full((steps, rows), APART, np.float32)
        flat, most, size = scores.reshape(steps * rows, -1), out.reshape(-1), BLOCK * rows
        outside, lead = np.empty(size, np.float32), np.empty(size, np.float32)
        for at in range(0, len(flat), size):
            part, best = flat[at : at + size], most[at : at + size]
            zero, gain = outside[: len(part)], lead[: len(part)]
            np.copyto(zero, part[:, 0])
            for b, more, need in kinds:
                unit = least / need if least > 0 else 1.0
                np.maximum(part[:, b], part[:, b + 1], gain)
                np.subtract(gain, zero, gain)
                np.add(gain, np.float32(more + 1e-4), gain)  # more than single precision loses
                np.multiply(gain, np.float32(unit), gain)
                np.maximum(best, gain, best)
        return np.ascontiguousarray(out.T)

    def _possible(self, scores: Sequence[np.ndarray]) -> list[np.ndarray]:
        """For each text the characters that some item could hold. Tags 2k + 1 and 2k + 2 begin and go on with an item of kind k. An item
        pays for entry and exit and gains its lead over tag 0 in each of its characters; where no run of characters pays for any kind,
        the best path stays outside, so these need no search."""
        sizes = np.array([-(-len(s) // STRETCH) + 1 for s in scores], np.int64)  # in stretches; the last one is between texts
        starts = (np.cumsum(sizes) - sizes) * STRETCH
        flat = np.zeros((self.tags, int(sizes.sum()) * STRETCH), np.float32)
        for s, a, b in zip(scores, starts.tolist(), (starts + sizes * STRETCH).tolist()):
            flat[:, a : a + len(s)] = s.T
            flat[0, a + len(s) : b] = -APART
        keep = np.zeros(flat.shape[1], bool)
        for b, more, need in self._kinds():
            gain = np.maximum(flat[b], flat[b + 1])
            gain -= flat[0]
            gain += np.float32(more)
            keep[_paying(gain, need)] = True
        return [np.flatnonzero(keep[a : a + len(s)]) for s, a in zip(scores, starts.tolist())]

    EDGE = 3.0  # what an item at the end of a text may save

    def decode(self, scores: Sequence[np.ndarray], around: int = AROUND) -> list[np.ndarray]:
        """The best tags of whole texts; tag 0 is outside."""
        tags = [np.zeros(len(s), np.int8) for s in scores]
        ends = np.cumsum([len(s) for s in scores], dtype=np.int64)
        starts = ends - [len(s) for s in scores]
        near = np.concatenate([np.zeros(0, np.int64), *(x + a for x, a in zip(self._possible(scores), starts))])
        regions = [(i, a - starts[i], b - starts[i]) for i, a, b in _regions(near, starts, ends, around)]
        regions.sort(key=lambda r: r[2] - r[1])
        a = 0
        while a < len(regions):  # regions of like length together
            first = regions[a][2] - regions[a][1]
            end = a + 1
            while end < len(regions) and regions[end][2] - regions[end][1] <= 1.25 * first + 64 and (end - a + 1) * first <= 200_000:
                end += 1
            part, a = regions[a:end], end
            steps = part[-1][2] - part[-1][1] + 1  # one outside at least, so that all leave their last item at the same price
            padded = np.zeros((steps, len(part), self.tags), np.float32)
            padded[:, :, 1:] = -1e4
            for r, (i, lo, hi) in enumerate(part):
                padded[: hi - lo, r] = scores[i][lo:hi]
            best = self._viterbi(padded)
            for r, (i, lo, hi) in enumerate(part):
                tags[i][lo:hi] = best[: hi - lo, r]
        return tags

    def _viterbi(self, scores: np.ndarray) -> np.ndarray:
        steps, rows, k = scores.shape
        best, trans = np.array(scores.transpose(0, 2, 1), order="C"), np.repeat(self.w["trans"][:, :, None], rows, axis=2)
        ways, most, into = np.empty((k, k, rows), np.float32), np.empty((k, rows), np.float32), np.ascontiguousarray(self.w["trans"].T)
        for t in range(1, steps):
            np.add(best[t - 1][:, None, :], trans, out=ways)
            np.maximum.reduce(ways, 0, None, most)
            best[t] += most
        out = np.empty((steps, rows), np.int8)
        out[-1] = best[-1].argmax(axis=0)
        for t in range(steps - 1, 0, -1):
            out[t - 1] = (best[t - 1].T + into.take(out[t], axis=0)).argmax(axis=1)
        return out

    # training

    def _forward(self, ids: np.ndarray) -> tuple[np.ndarray, dict]:
        rows, steps = ids.shape
        n, kept, out = self.hidden, {}, np.empty((steps, rows, self.tags), np.float32)
        out[:] = self.w["bias"]
        for d, order in (("f", range(steps)), ("b", range(steps - 1, -1, -1))):
            gates, cs, hs = np.empty((steps, rows, 4 * n), np.float32), np.empty((steps, rows, n), np.float32), np.empty((steps, rows, n), np.float32)
            h, c = np.zeros((rows, n), np.float32), np.zeros((rows, n), np.float32)
            for t in order:
                z = h @ self.w["h" + d] + self.w["x" + d][ids[:, t]]
                _gate(z[:, : 3 * n])
                z[:, 3 * n :] = _soft(z[:, 3 * n :])
                c = z[:, n : 2 * n] * c + z[:, :n] * z[:, 3 * n :]
                h = z[:, 2 * n : 3 * n] * _soft(c)
                gates[t], cs[t], hs[t] = z, c, h
            out += hs @ self.w["o" + d]
            kept[d] = (gates, cs, hs)
        return out, kept

    def _crf(self, scores: np.ndarray, gold: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        """Mean loss of a character, and the gradients of scores and transitions."""
        steps, rows, k = scores.shape
        s, trans = scores.astype(np.float64), self.w["trans"].astype(np.float64)
        e = np.exp(trans - trans.max())
        alpha, beta = np.empty((steps, rows, k)), np.empty((steps, rows, k))
        alpha[0] = s[0]
        for t in range(1, steps):
            m = alpha[t - 1].max(axis=1, keepdims=True)
            alpha[t] = s[t] + m + trans.max() + np.log(np.exp(alpha[t - 1] - m) @ e + 1e-300)
        beta[-1] = 0
        for t in range(steps - 2, -1, -1):
            v = beta[t + 1] + s[t + 1]
            m = v.max(axis=1, keepdims=True)
            beta[t] = m + trans.max() + np.log(np.exp(v - m) @ e.T + 1e-300)
        m = alpha[-1].max(axis=1, keepdims=True)
        z = (m + np.log(np.exp(alpha[-1] - m).sum(axis=1, keepdims=True)))[:, 0]
        ds = np.exp(alpha + beta - z[None, :, None])
        dt = np.zeros((k, k))
        for t in range(1, steps):
            a, b = alpha[t - 1], beta[t] + s[t]
            ma, mb = a.max(axis=1, keepdims=True), b.max(axis=1, keepdims=True)
            scale = np.exp(np.clip(ma + mb - z[:, None], -60, 60))
            dt += (np.exp(a - ma) * scale).T @ np.exp(b - mb) * np.exp(trans)
        r = np.arange(rows)
        g = gold.T
        score = sum(s[t, r, g[t]] for t in range(steps)) + sum(trans[g[t - 1], g[t]] for t in range(1, steps))
        for t in range(steps):
            ds[t, r, g[t]] -= 1
        for t in range(1, steps):
            np.add.at(dt, (g[t - 1], g[t]), -1)
        count = rows * steps
        return float((z - score).sum() / count), (ds / rows).astype(np.float32), (dt / rows).astype(np.float32)

    def gradients(self, ids: np.ndarray, gold: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        rows, steps = ids.shape
        n = self.hidden
        scores, kept = self._forward(ids)
        loss, ds, dtrans = self._crf(scores, gold)
        grads = {"bias": ds.sum(axis=(0, 1)), "trans": dtrans}
        flat = ids.T.ravel()
        one_hot = np.zeros((len(flat), CLASSES), np.float32)
        one_hot[np.arange(len(flat)), flat] = 1
        for d, order in (("f", range(steps - 1, -1, -1)), ("b", range(steps))):
            gates, cs, hs = kept[d]
            wh, wo = self.w["h" + d], self.w["o" + d]
            dz = np.empty_like(gates)
            dh, dc = np.zeros((rows, n), np.float32), np.zeros((rows, n), np.float32)
            from_scores = ds @ wo.T
            for t in order:
                before = t - 1 if d == "f" else t + 1
                inside = 0 <= before < steps
                i, f, o, g = (gates[t][:, q * n : (q + 1) * n] for q in range(4))
                tc = _soft(cs[t])
                dh = dh + from_scores[t]
                dc = dc + dh * o * (1 - np.abs(tc)) ** 2
                z = dz[t]
                z[:, :n] = dc * g * ((i > 0) & (i < 1)) * 0.25
                z[:, n : 2 * n] = dc * cs[before] * ((f > 0) & (f < 1)) * 0.25 if inside else 0
                z[:, 2 * n : 3 * n] = dh * tc * ((o > 0) & (o < 1)) * 0.25
                z[:, 3 * n :] = dc * i * (1 - np.abs(g)) ** 2
                dc = dc * f
                dh = z @ wh.T
            previous = np.zeros_like(hs)
            if d == "f":
                previous[1:] = hs[:-1]
            else:
                previous[:-1] = hs[1:]
            grads["o" + d] = hs.reshape(-1, n).T @ ds.reshape(-1, self.tags)
            grads["h" + d] = previous.reshape(-1, n).T @ dz.reshape(-1, 4 * n)
            grads["x" + d] = one_hot.T @ dz.reshape(-1, 4 * n)
        return loss, grads

    def fit(self, ids: np.ndarray, gold: np.ndarray, *, epochs: int, batch: int = 128, rate: float = 0.01, seed: int = 0, log=None) -> None:
        """Adam with a rate that falls to a twentieth along a cosine; gradients are clipped by their norm."""
        rng, step = np.random.default_rng(seed), 0
        total = epochs * -(-len(ids) // batch)
        m, v = ({k: np.zeros_like(x) for k, x in self.w.items()} for _ in range(2))
        for epoch in range(epochs):
            order, losses = rng.permutation(len(ids)), []
            for at in range(0, len(ids), batch):
                pick = order[at : at + batch]
                loss, grads = self.gradients(ids[pick], gold[pick])
                losses.append(loss)
                norm = np.sqrt(sum(float((g * g).sum()) for g in grads.values()))
                scale, step = min(1.0, 5.0 / (norm + 1e-9)), step + 1
                now = rate * (0.05 + 0.95 * (1 + np.cos(np.pi * step / total)) / 2)
                for k, g in grads.items():
                    g = g * scale
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.99 * v[k] + 0.01 * g * g
                    self.w[k] -= (now * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
            if log:
                log(epoch, float(np.mean(losses)))
