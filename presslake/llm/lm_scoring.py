"""Document log-likelihoods under a gated recurrent language model with a class-factored softmax.

Word counts come from all training documents. The most frequent words are the network's vocabulary, dealt to classes by
rank; any other word is the network's "other" token times its own share among the others, so a text's score is the
probability of the very text. The network is trained by truncated backpropagation in numpy: in each round copies are
trained, each on its share of documents, and averaged, weighted by tokens. Shares, their order and their number follow from
the documents alone, not from how these lie in files and partitions. For scores the state is carried from window to
window, through the whole document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from presslake.llm.common import raw, remainder, rows_of, slices, text_slices
from presslake.sources.workspace import materialize

END, OTHER = 0, 1
#: Words that every task gets with their counts; the rest is joined. A bound on what is sent, about 10 MB.
HEAD = 200_000
#: Size of the network's vocabulary (with END and OTHER), its state, and the classes of its output.
WORDS, STATE, CLASSES = 2048, 32, 45
#: Rounds of training; every training row is in one of them.
ROUNDS = 3
#: Tokens of a round for each of its copies, about: enough that a long document does not leave the other lanes empty.
SHARE = 2_400_000
#: Tokens of documents that are scored together, and those that a copy holds at once. Bounds on what a task holds.
TOGETHER, HELD = 1_500_000, 4_800_000
#: Steps whose gates' slopes are found at once, and the rows from which a word's are summed by themselves.
FEW, TURNS = 8, 16
#: Places of a class that may be left empty for working on it with its neighbours.
EMPTY = 48
#: Parameters that are updated at once.
BLOCK = 32_768


# ---------------------------------------------------------------- word counts


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-cased words of UTF-8 texts, one after the other, and the number of the text that each is from."""
    # Arrow's kernels want strings; they look at single bytes only, so bytes that are no UTF-8 do no harm.
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, b"").view(pa.string())))
    words, sizes = lists.flatten(), lists.value_lengths().to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(texts)), sizes)
    empty = pc.equal(pc.binary_length(words), 0)  # before a leading and after a trailing blank
    if pc.any(empty).as_py():
        full = pc.invert(empty)
        words, owner = words.filter(full), owner[full.to_numpy(zero_copy_only=False)]
    return words.view(pa.binary()), owner


def _merged(tables: list[pa.Table]) -> pa.Table:
    return pa.concat_tables(tables).group_by("word").aggregate([("n", "sum")]).select(["word", "n_sum"]).rename_columns(["word", "n"]).combine_chunks()


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    found: list[pa.Table] = []
    for part in text_slices(batches):
        counts = pc.value_counts(_words(part.column("text"))[0])
        found.append(pa.table({"word": counts.field("values"), "n": counts.field("counts")}))
        if sum(map(len, found)) > 800_000:
            found = [_merged(found)]
            if len(found[0]) > 400_000:
                yield from found[0].to_batches()
                found = []
    if found:
        yield from _merged(found).to_batches()


_heads: dict = {}


@dataclass
class Lexicon:
    """Frequent words, by rank in one text, with their counts, and the totals of all training words."""

    text: bytes
    counts: np.ndarray
    ends: int  # training documents, each with an end
    tokens: int
    distinct: int
    vocabulary: int  # how many of the words are the network's own, after END and OTHER

    @property
    def head(self) -> pa.Array:
        """The frequent words, by rank; made once in each Python worker."""
        if _heads.get("text") != self.text:
            _heads.update(text=self.text, head=pa.array(self.text.split(), pa.binary()))
        return _heads["head"]

    @property
    def kind(self) -> str:
        """Type of the network's numbers of words, as they are packed."""
        return "<u2" if self.vocabulary + 2 <= 1 << 16 else "<i4"

    def base(self, count: np.ndarray | float):
        return np.log10(count + 0.1)

    @property
    def base_total(self) -> float:
        return math.log10(self.tokens + 0.1 * (self.distinct + 1))

    @property
    def other_total(self) -> float:
        """Logarithm of what the shares of other words are parts of, an unseen word included."""
        known = int(self.counts[: self.vocabulary].sum())
        words = self.distinct - (self.ends > 0) - self.vocabulary
        return math.log10(self.tokens - self.ends - known + 0.1 * (words + 1))


def lexicon(training: DataFrame, head: int = HEAD, size: int = WORDS) -> tuple[Lexicon, DataFrame]:
    """Counts over all training rows: the ``head`` most frequent words for the tasks, and the table of all."""
    counted = training.select("text").mapInArrow(_count, "word binary, n long")
    table = materialize(counted.groupBy("word").agg(F.sum("n").alias("n")), "words")
    # The bound on the head is found from a histogram of counts, so no task sorts all words.
    scale = F.floor(F.log2("n") * 4).cast("int").alias("scale")
    sizes = sorted(((r["scale"], r["words"], r["n"]) for r in table.groupBy(scale).agg(F.count(F.lit(1)).alias("words"), F.sum("n").alias("n")).collect()), reverse=True)
    taken, least, cut = 0, None, None
    for scale_, words, _ in sizes:
        if taken + words > head:
            cut = scale_
            break
        taken, least = taken + words, scale_
    wanted = F.lit(False) if least is None else scale >= least
    if cut is not None:
        # The class that would cross the bound is cut by the words' hashes, again by a histogram.
        lot = F.pmod(F.xxhash64("word"), F.lit(4096))
        lots, last = {r["lot"]: r["count"] for r in table.filter(scale == cut).groupBy(lot.alias("lot")).count().collect()}, -1
        while taken + lots.get(last + 1, 0) <= head:
            last += 1
            taken += lots.get(last, 0)
        wanted = wanted | ((scale == cut) & (lot <= last))
    found = table.filter(wanted).toArrow()
    words, counts = found.column("word").to_pylist(), found.column("n").to_numpy()
    order = sorted(range(len(words)), key=lambda k: (-counts[k], words[k]))
    ends = training.count()
    tokens, distinct = sum(n for *_, n in sizes) + ends, sum(w for _, w, _ in sizes) + (ends > 0)
    text = b" ".join(words[k] for k in order)  # no word holds a blank
    return Lexicon(text, counts[order].astype(np.float64), ends, tokens, distinct, min(size - 2, len(order))), table


# ---------------------------------------------------------------- the network


def summed(rows: np.ndarray, names: np.ndarray, n: int) -> np.ndarray:
    """Sums of (gates, rows, numbers) over the rows of each name 0 to n - 1; each name has a row."""
    sizes = np.bincount(names, minlength=n)
    ranked = np.argsort(-sizes, kind="stable")
    sizes = sizes[ranked]
    rank = np.empty(n, np.intp)
    rank[ranked] = np.arange(n)
    names = rank[names]
    order = np.argsort(names.astype(np.uint16) if n <= 1 << 16 else names, kind="stable")
    names, starts = names[order], np.cumsum(sizes) - sizes
    out = np.empty((len(rows), n, rows.shape[2]), rows.dtype)
    # A frequent name is a slice of its own. The others go by turns: first rows, second rows, and so on, so that a turn is a
    # slice that is added to the first names.
    often = int(np.searchsorted(-sizes, -TURNS))
    cut = int(sizes[:often].sum())
    turn = np.arange(cut, len(order)) - starts[names[cut:]]
    many = np.bincount(turn)
    begin = np.cumsum(many) - many
    place = np.empty(len(order) - cut, np.intp)
    place[begin[turn] + names[cut:] - often] = order[cut:]
    laid = rows.take(np.concatenate([order[:cut], place]), axis=1)
    ones = np.ones(sizes[:1].max(initial=0), rows.dtype)
    for k in range(often):
        np.matmul(ones[: sizes[k]], laid[:, starts[k] : starts[k] + sizes[k]], out=out[:, k])
    for k, (low, size) in enumerate(zip((cut + begin).tolist(), many.tolist(), strict=True)):
        if k:
            out[:, often : often + size] += laid[:, low : low + size]
        else:
            out[:, often:] = laid[:, low : low + size]
    return out.take(rank, axis=1)


class Network:
    """One gated recurrent layer; ``x`` is looked up, so the input's weights are a table."""

    def __init__(self, params: dict[str, np.ndarray], classes: int):
        self.p, self.classes = params, classes
        self.vocab = params["x"].shape[0]
        self.width = -(-self.vocab // classes)

    @classmethod
    def new(cls, vocab: int, state: int, classes: int, frequency: np.ndarray, seed: int = 1) -> Network:
        rng = np.random.default_rng(seed)
        wild = lambda *shape, s=0.1: (rng.standard_normal(shape) * s).astype(np.float32)
        p = {"x": wild(vocab, 3 * state), "b": np.zeros(3 * state, np.float32), "u": wild(state, 2 * state, s=state**-0.5), "v": wild(state, state, s=state**-0.5)}
        p |= {"c": wild(state, classes), "cb": np.zeros(classes, np.float32), "w": wild(vocab, state), "wb": np.log(frequency + 1).astype(np.float32)}
        net = cls(p, classes)
        mass = np.bincount(np.arange(vocab) // net.width, weights=frequency, minlength=classes)
        p["cb"] = np.log(mass[:classes] + 1).astype(np.float32)
        return net

    def run(self, inputs: np.ndarray, fresh: np.ndarray, h: np.ndarray, keep: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """States after each step of (lanes, steps) inputs; where ``fresh``, the state starts at zero."""
        p, s = self.p, h.shape[1]
        lanes, steps = inputs.shape
        kind = p["u"].dtype
        # What an input adds is summed up once for each word that occurs. Half of a gate's, as its sigmoid is made from a tanh.
        seen = np.flatnonzero(np.bincount(inputs.ravel(), minlength=self.vocab))
        number = np.zeros(self.vocab, np.intp)
        number[seen] = np.arange(len(seen))
        at = number[inputs.T]
        # Each gate lies by itself, so that all its lanes are one stretch of memory.
        table = (p["x"][seen] + p["b"]).reshape(-1, 3, s).transpose(1, 0, 2).copy()
        table[:2] *= 0.5
        half, v = (0.5 * p["u"]).reshape(s, 2, s).transpose(1, 0, 2).copy(), p["v"]
        held = steps if keep is not None else 1
        gates = np.take(table, at, axis=1) if keep is not None else np.empty((3, 1, lanes, s), kind)
        reset, apart = np.empty((held, lanes, s), kind), np.empty((held, lanes, s), kind)
        states = np.empty((steps, lanes, s), kind)
        two, one = np.empty((2, lanes, s), kind), np.empty((lanes, s), kind)
        starts, h = fresh.any(0).tolist(), h.astype(kind)
        for t in range(steps):
            if starts[t]:
                h = h * ~fresh[:, t, None]
            k, after = t % held, states[t]
            rh, gap = reset[k], apart[k]
            if keep is None:
                np.take(table, at[t], axis=1, out=gates[:, 0], mode="clip")
            zr, n = gates[:2, k], gates[2, k]
            zr += np.matmul(h, half, out=two)
            np.tanh(zr, out=zr)
            zr *= 0.5
            zr += 0.5
            np.multiply(zr[1], h, out=rh)
            n += np.dot(rh, v, out=one)
            np.tanh(n, out=n)
            np.subtract(h, n, out=gap)
            np.multiply(gap, zr[0], out=after)
            after += n
            h = after
        if keep is not None:
            keep.extend((gates, reset, apart, starts, seen, at))
        return states, h.copy()

    def log_probabilities(self, states: np.ndarray, targets: np.ndarray, gradients: dict | None = None) -> tuple[np.ndarray, np.ndarray | None]:
        """Natural log-probabilities of flat targets; with ``gradients``, also adds theirs and returns the states'."""
        p, s, n = self.p, states.shape[1], len(targets)
        # Rows by class, so that a class is a slice. Rare classes have few tokens each: neighbours are worked on together,
        # each with as many places as the largest of them has tokens, while that leaves few places empty.
        classes = (targets // self.width).astype(np.int16)
        order = np.argsort(classes, kind="stable")
        classes = classes[order].astype(np.intp)
        sizes = np.bincount(classes, minlength=self.classes)
        firsts, bases, spans, low, places, counts = np.cumsum(sizes) - sizes, np.zeros(self.classes, np.intp), [], 0, 0, sizes.tolist()
        while low < self.classes:
            high, most = low + 1, counts[low]
            while high < self.classes and (high - low) * max(0, counts[high] - most) + max(0, most - counts[high]) <= EMPTY:
                most, high = max(most, counts[high]), high + 1
            if most:
                bases[low:high] = places + most * np.arange(high - low)
                spans.append((low, high, most, places))
                places += most * (high - low)
            low = high
        place = (bases - firsts)[classes] + np.arange(n)
        at = np.zeros(places, np.intp)
        at[place] = order
        # A last column of ones takes the biases along.
        x = np.ones((places, s + 1), np.result_type(states, p["w"]))
        x[:, :s] = states.take(at, axis=0)
        real = np.zeros(places, x.dtype)
        real[place] = 1
        into = np.concatenate([p["c"], p["cb"][None]])
        words = np.zeros((self.classes * self.width, s + 1), x.dtype)
        words[: self.vocab, :s], words[: self.vocab, s] = p["w"], p["wb"]
        # States are between -1 and 1, so no output is beyond the sum of its weights; only large ones could overflow.
        ones = np.ones(s + 1, x.dtype)
        safe = max((ones @ np.abs(into)).max(), (np.abs(words) @ ones).max()) < 60
        words[self.vocab :, s] = -1e30  # numbers of the last classes that no word has
        words = words.reshape(self.classes, self.width, s + 1)
        turned = words.transpose(0, 2, 1).copy()
        one, each = np.ones(self.classes, x.dtype), np.ones(self.width, x.dtype)
        e = x @ into
        if not safe:
            e -= e.max(1, keepdims=True)
        flat, hit = e.reshape(-1), place * self.classes + classes
        out = flat[hit]
        np.exp(e, out=e)
        total = e @ one
        back = None
        if gradients is not None:
            e *= (real / total)[:, None]
            flat[hit] -= 1
            made = e.T @ x
            gradients["c"] += made[:, :s].T
            gradients["cb"] += made[:, s]
            back = e @ p["c"].T.copy()
        own = targets[order] - classes * self.width
        for low, high, most, begin in spans:
            # The share of words inside these classes: onto ``out``, times ``total``, and onto the gradients.
            many, rows = high - low, slice(begin, begin + (high - low) * most)
            tokens = slice(firsts[low], firsts[high - 1] + sizes[high - 1])
            part = x[rows].reshape(many, most, s + 1)
            e = np.matmul(part, turned[low:high])
            if not safe:
                e -= e.max(2, keepdims=True)
            flat, hit = e.reshape(-1), (place[tokens] - begin) * self.width + own[tokens]
            out[tokens] += flat[hit]
            np.exp(e, out=e)
            sums = e @ each
            total[rows] *= sums.ravel()
            if gradients is not None:
                here = real[rows].reshape(many, most)
                e *= (here / (sums + (1 - here)))[:, :, None]
                flat[hit] -= 1
                first, last = low * self.width, min(high * self.width, self.vocab)
                made = np.matmul(e.transpose(0, 2, 1), part).reshape(-1, s + 1)[: max(0, last - first)]
                gradients["w"][first:last] += made[:, :s]
                gradients["wb"][first:last] += made[:, s]
                back[rows] += np.matmul(e, words[low:high, :, :s]).reshape(-1, s)
        out -= np.log(total[place])
        logs, where = np.empty_like(out), np.empty(n, np.intp)
        logs[order], where[order] = out, place
        return logs, None if back is None else back.take(where, axis=0)

    def slopes(self, inputs: np.ndarray, targets: np.ndarray, fresh: np.ndarray, real: np.ndarray, h: np.ndarray, g: dict) -> tuple[float, np.ndarray]:
        """Loss and last state of one window; adds the loss' gradients to ``g``. No gradient goes beyond the window."""
        p, s = self.p, h.shape[1]
        keep: list = []
        states, last = self.run(inputs, fresh, h, keep)
        gates, reset, apart, starts, seen, at = keep
        steps, lanes = at.shape
        mask = real.T.ravel()
        flat, wanted = states.reshape(-1, s), targets.T.ravel()
        if mask.all():
            logs, back = self.log_probabilities(flat, wanted, g)
        else:
            logs, some = self.log_probabilities(flat[mask], wanted[mask], g)
            back = np.zeros((len(mask), s), some.dtype)
            back[mask] = some
        back = back.reshape(states.shape)
        d, turned, two = np.zeros((lanes, s), states.dtype), np.empty((lanes, s), states.dtype), np.empty((2, lanes, s), states.dtype)
        da = np.empty((3, steps, lanes, s), states.dtype)
        u, v = p["u"].T.reshape(2, s, s).copy(), p["v"].T.copy()
        for first in range((steps - 1) // FEW * FEW, -1, -FEW):
            # How the states' gradients pass each gate: for a few steps at once, which stay in the processor's cache.
            few = slice(first, first + FEW)
            (z, r, n), (to_z, to_r, to_n) = gates[:, few], da[:, few]
            np.subtract(1, z, out=to_z)
            np.multiply(n, n, out=to_n)
            np.subtract(1, to_n, out=to_n)
            to_n *= to_z
            to_z *= z
            to_z *= apart[few]
            np.subtract(1, r, out=to_r)
            to_r *= reset[few]
            for t in range(min(first + FEW, steps) - 1, first - 1, -1):
                d += back[t]
                dzn, dr = da[::2, t], da[1, t]
                dzn *= d
                drh = np.dot(da[2, t], v, out=turned)
                dr *= drh
                d *= gates[0, t]
                drh *= gates[1, t]
                d += drh
                np.matmul(da[:2, t], u, out=two)
                d += two[0]
                d += two[1]
                if starts[t]:
                    d *= ~fresh[:, t, None]
        da = da.reshape(3, -1, s)
        before = np.concatenate([h.astype(states.dtype)[None], states[:-1]])
        before[fresh.T] = 0
        before = before.reshape(-1, s).T
        g["u"][:, :s] += before @ da[0]
        g["u"][:, s:] += before @ da[1]
        g["v"] += reset.reshape(-1, s).T @ da[2]
        sums = summed(da, at.ravel(), len(seen)).swapaxes(0, 1).reshape(len(seen), 3 * s)
        g["x"][seen] += sums
        g["b"] += sums.sum(0)
        return -float(logs.sum()), last

    def window(self, inputs: np.ndarray, targets: np.ndarray, fresh: np.ndarray, real: np.ndarray, h: np.ndarray) -> tuple[float, dict, np.ndarray]:
        """Loss, gradients for each token, and last state of one window."""
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        loss, last = self.slopes(inputs, targets, fresh, real, h, g)
        n_real = max(1, int(real.sum()))
        return loss, {k: v / n_real for k, v in g.items()}, last


class Lanes:
    """Documents laid end to end in lanes of similar length, read window by window with the state carried."""

    def __init__(self, docs: list[np.ndarray], lanes: int):
        order = sorted(range(len(docs)), key=lambda k: (-len(docs[k]), k))
        lanes = max(1, min(lanes, len(docs)))
        heap = [(0, lane) for lane in range(lanes)]
        held: list[list[int]] = [[] for _ in range(lanes)]
        import heapq

        for k in order:
            load, lane = heapq.heappop(heap)
            held[lane].append(k)
            heapq.heappush(heap, (load + len(docs[k]) + 1, lane))
        held = sorted(held, key=lambda ks: -sum(len(docs[k]) + 1 for k in ks))
        self.sizes = np.array([sum(len(docs[k]) + 1 for k in ks) for ks in held], np.int64)
        flat = [k for ks in held for k in ks]
        n = np.array([len(docs[k]) + 1 for k in flat], np.int64)
        self.owner = np.repeat(np.array(flat, np.int64), n)
        self.targets = np.full(int(n.sum()), END, np.int32)
        inside = np.ones(len(self.targets), bool)
        inside[np.cumsum(n) - 1] = False
        self.targets[inside] = np.concatenate([docs[k] for k in flat])
        self.fresh = np.zeros(len(self.targets), bool)
        self.fresh[np.cumsum(n) - n] = True
        self.inputs = np.where(self.fresh, END, np.append(END, self.targets[:-1]))
        self.starts = np.cumsum(self.sizes) - self.sizes

    def windows(self, tokens: int, steps: int | None = None) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(active lanes, index of each step, which are real); about ``tokens`` steps in all, or ``steps`` a lane."""
        at, longest = 0, int(self.sizes[0])
        while at < longest:
            active = int(np.searchsorted(-self.sizes, -at, side="left"))
            n = min(longest - at, steps or max(16, min(2048, tokens // active)))
            place = at + np.arange(n)
            index = self.starts[:active, None] + place
            if at + n <= self.sizes[active - 1]:
                real = np.ones(index.shape, bool)
            else:
                real = place[None] < self.sizes[:active, None]
                index = np.where(real, index, 0)
            yield active, index, real
            at += n


def _views(flat: np.ndarray, like: dict[str, np.ndarray]) -> dict[str, np.ndarray]:
    """The parts of a flat array in the shapes of ``like``, in the order of their names."""
    ends = np.cumsum([like[k].size for k in sorted(like)])
    return {k: part.reshape(like[k].shape) for k, part in zip(sorted(like), np.split(flat, ends[:-1]), strict=True)}


def train_part(net: Network, docs: list[np.ndarray], lanes: int = 96, steps: int = 32, rate: float = 0.01) -> int:
    """One pass over some documents with Adam; changes the network, returns the tokens it saw."""
    if not docs:
        return 0
    laid = Lanes(docs, lanes)
    h = np.zeros((len(laid.sizes), net.p["u"].shape[0]), np.float32)
    flat = np.concatenate([net.p[k].ravel() for k in sorted(net.p)])
    net.p = _views(flat, net.p)
    grown, m, v = (np.zeros_like(flat) for _ in range(3))
    g, spare = _views(grown, net.p), np.empty(min(BLOCK, len(flat)), flat.dtype)
    total, step, was = 0, 0, 1.0
    for active, index, real in laid.windows(0, steps):
        _, last = net.slopes(laid.inputs[index], laid.targets[index], laid.fresh[index] & real, real, h[:active], g)
        h[:active] = last
        n_real = int(real.sum())
        total += n_real
        step += 1
        norm = math.sqrt(float(grown @ grown)) / n_real
        scale = min(1.0, 1.0 / (norm + 1e-9)) / n_real
        size = rate * min(1.0, step / 20) * math.sqrt(1 - 0.999**step) / (1 - 0.9**step)
        # Adam, a block that stays in the processor's cache at a time; ``m`` and ``v`` are 10 and 1,000 times the means, of
        # gradients that lack this step's ``scale``: bringing them to it costs no further pass.
        old, was = was / scale, scale
        for at in range(0, len(flat), BLOCK):
            own, gb, mb, vb = (x[at : at + BLOCK] for x in (flat, grown, m, v))
            tmp = spare[: len(gb)]
            mb *= 0.9 * old
            mb += gb
            vb *= 0.999 * old * old
            gb *= gb
            vb += gb
            gb.fill(0)
            np.sqrt(vb, out=tmp)
            tmp += 1e-8 * 1000**0.5 / scale
            np.divide(mb, tmp, out=tmp)
            tmp *= size * 0.1 * 1000**0.5
            own -= tmp
    return total


def score_docs(net: Network, docs: list[np.ndarray]) -> np.ndarray:
    """Natural log-probability of each document's tokens and its end."""
    out = np.zeros(len(docs))
    if not docs:
        return out
    laid = Lanes(docs, 512)
    h = np.zeros((len(laid.sizes), net.p["u"].shape[0]), np.float32)
    for active, index, real in laid.windows(16_384):
        states, last = net.run(laid.inputs[index], laid.fresh[index] & real, h[:active])
        h[:active] = last
        mask = real.T.ravel()
        flat, place = states.reshape(-1, h.shape[1]), index.T.ravel()
        if not mask.all():
            flat, place = flat[mask], place[mask]
        logs, _ = net.log_probabilities(flat, laid.targets[place])
        out += np.bincount(laid.owner[place], weights=logs, minlength=len(out))
    return out


# ---------------------------------------------------------------- training on the cluster


def _train(batches: Iterator[pa.RecordBatch], params: dict, classes: int, kind: str, rate: float) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by copy; each copy starts from ``params``."""
    net, copy, docs, held, total = None, None, [], 0, 0

    def done() -> pa.RecordBatch:
        tokens = total + train_part(net, docs, rate=rate)
        return pa.RecordBatch.from_pylist([{"part": copy, "tokens": tokens, "blob": np.concatenate([net.p[k].ravel() for k in sorted(net.p)]).tobytes()}])

    for numbers, ids in rows_of(batches, "copy", "ids"):
        for number, packed in zip(numbers, ids, strict=True):
            if number != copy:
                if net:
                    yield done()
                net, copy, docs, held, total = Network({k: v.copy() for k, v in params.items()}, classes), number, [], 0, 0
            docs.append(np.frombuffer(packed, kind))
            held += len(docs[-1]) + 1
            if held > HELD:
                total += train_part(net, docs, rate=rate)
                docs, held = [], 0
    if net:
        yield done()


def _average(table: pa.Table) -> pa.Table:
    table = table.sort_by("part")  # sums of floats depend on their order
    weights = np.array(table.column("tokens").to_pylist(), np.float64)
    blobs = table.column("blob")
    mean = sum(w * np.frombuffer(blobs[k].as_buffer(), np.float32).astype(np.float64) for k, w in enumerate(weights)) / weights.sum()
    return pa.table({"part": pa.array([table.column("part")[0].as_py() // 32], pa.int64()), "tokens": pa.array([int(weights.sum())], pa.int64()), "blob": pa.array([mean.astype(np.float32).tobytes()], pa.binary())})


def train(training: DataFrame, lex: Lexicon) -> Network:
    """The network of the training rows (``doc_id``, ``text``)."""
    return fit(coded(training, lex), lex)


def fit(training: DataFrame, lex: Lexicon) -> Network:
    """Rounds of local training and averaging; each of the ``coded`` training rows is in one round.

    A round deals its rows by their hash to a number of copies that grows with the tokens; a copy reads its rows in the order
    of another hash. Rows that are equal in both columns are interchangeable, so the same rows give the same network.
    """
    frequency = np.concatenate([[lex.ends, max(0, lex.tokens - lex.ends - lex.counts[: lex.vocabulary].sum())], lex.counts[: lex.vocabulary]])
    net = Network.new(lex.vocabulary + 2, STATE, CLASSES, frequency)
    place = F.pmod("mark", F.lit(100_003)) / 100_003
    bounds = np.linspace(0, 1, ROUNDS + 1) ** 1.5
    for k, (low, high) in enumerate(zip(bounds, bounds[1:], strict=False)):
        params, rate = net.p, 0.01 / (1 + k)
        copies = 1 + int(lex.tokens * (high - low)) // SHARE
        own = training.filter((place >= float(low)) & (place < float(high))).withColumn("copy", F.pmod("lot", F.lit(copies)))
        # More partitions than copies, so that few copies share a task; a task trains its copies one after the other.
        rows = own.repartition(4 * copies, "copy").sortWithinPartitions("copy", "mark", "doc_id", "ids").select("copy", "ids")
        trained = rows.mapInArrow(lambda b, params=params, rate=rate: _train(b, params, CLASSES, lex.kind, rate), "part long, tokens long, blob binary")
        nets = materialize(trained, "network")
        while copies > 32:  # at most 32 copies meet in a task, and then in the driver
            nearby = F.floor(F.col("part") / 32).cast("long").alias("group")
            nets, copies = nets.groupBy(nearby).applyInArrow(_average, "part long, tokens long, blob binary"), -(-copies // 32)
        got = nets.orderBy("part").collect()
        if got:
            total = sum(r["tokens"] for r in got)
            mean = sum(np.frombuffer(r["blob"], np.float32).astype(np.float64) * (r["tokens"] / total) for r in got).astype(np.float32)
            at, fresh = 0, {}
            for name in sorted(net.p):
                shape = net.p[name].shape
                size = net.p[name].size
                fresh[name] = mean[at : at + size].reshape(shape)
                at += size
            net = Network(fresh, CLASSES)
    return net


# ---------------------------------------------------------------- scoring


RESULT = [("row", pa.int64()), ("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("known", pa.int64()), ("base", pa.float64()), ("score", pa.float64())]
CODED = pa.schema([*RESULT, ("mark", pa.int64()), ("lot", pa.int32()), ("ids", pa.binary()), ("rare", pa.list_(pa.struct([("word", pa.binary()), ("k", pa.int64())])))])
SCORED_SQL = "row long, doc_id long, n_tokens long, known long, base double, score double"
CODED_SQL = f"{SCORED_SQL}, mark long, lot int, ids binary, rare array<struct<word:binary,k:long>>"


def _code(batches: Iterator[pa.RecordBatch], lex: Lexicon) -> Iterator[pa.RecordBatch]:
    logs = lex.base(lex.counts)
    end = float(lex.base(float(lex.ends)))
    row = TaskContext.get().partitionId() << 40
    for part in text_slices(batches):
        n = part.num_rows
        words, owner = _words(part.column("text"))
        # Rank of each word among the frequent ones, -1 for others.
        ranks = pc.fill_null(pc.index_in(words, value_set=lex.head), -1).to_numpy(zero_copy_only=False) if len(lex.counts) else np.full(len(words), -1, np.int32)
        sizes = np.bincount(owner, minlength=n)
        head, other = ranks >= 0, ranks >= lex.vocabulary
        n_other = np.bincount(owner[~head | other], minlength=n)
        known = np.bincount(owner[head], minlength=n) + (lex.ends > 0)
        base = np.bincount(owner[head], weights=logs[ranks[head]], minlength=n) + end
        score = np.bincount(owner[other], weights=logs[ranks[other]], minlength=n).astype(np.float64)
        if n_other.any():
            score -= n_other * lex.other_total
        own = np.where(head & ~other, ranks + 2, OTHER).astype(lex.kind)
        ends = np.append(0, np.cumsum(sizes)) * own.itemsize
        ids = pa.Array.from_buffers(pa.binary(), n, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(own)])
        # Rare words once for each text, with their number.
        named = words.filter(pa.array(~head)).dictionary_encode()
        pairs, times = np.unique(owner[~head] * max(1, len(named.dictionary)) + named.indices.to_numpy(), return_counts=True)
        whose, which = np.divmod(pairs, max(1, len(named.dictionary)))
        rare = pa.StructArray.from_arrays([named.dictionary.take(pa.array(which)), pa.array(times.astype(np.int64))], names=["word", "k"])
        listed = pa.ListArray.from_arrays(pa.array(np.searchsorted(whose, np.arange(n + 1)).astype(np.int32)), rare)
        made = [row + np.arange(n), part.column("doc_id"), sizes + 1, known, base, score, part.column("mark"), part.column("lot"), ids, listed]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) if isinstance(c, np.ndarray) else c for c, f in zip(made, CODED, strict=True)], schema=CODED)
        row += n


def coded(rows: DataFrame, lex: Lexicon) -> DataFrame:
    """``rows`` (``doc_id``, ``text``) as packed numbers of the network's words, with what a score needs beside the network.

    ``base`` and ``score`` lack the words outside the head, which ``rare`` lists. ``mark`` and ``lot`` say where a row is trained.
    """
    marked = rows.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("mark"), F.hash("doc_id", "text").alias("lot"))
    return marked.mapInArrow(lambda b: _code(b, lex), CODED_SQL)


def _score(batches: Iterator[pa.RecordBatch], params: dict, classes: int, kind: str) -> Iterator[pa.RecordBatch]:
    """Adds the network's part to ``score``."""
    net, names = Network(params, classes), [name for name, _ in RESULT]
    rows: list[pa.RecordBatch] = []
    docs, held = [], 0

    def out() -> pa.Table:
        table = pa.Table.from_batches(rows)
        score = table.column("score").to_numpy() + score_docs(net, docs) / math.log(10)
        return table.set_column(names.index("score"), "score", pa.array(score))

    for batch in slices(batches):
        rows.append(batch.select(names))
        docs += [np.frombuffer(packed, kind) for packed in batch.column("ids").to_pylist()]
        held += sum(map(len, docs[len(docs) - batch.num_rows :])) + batch.num_rows
        if held > TOGETHER:
            yield from out().to_batches()
            rows, docs, held = [], [], 0
    if docs:
        yield from out().to_batches()


def score_documents(docs: DataFrame, folds: int = 10) -> DataFrame:
    """Per row of ``docs``: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Learns from the rows whose fold is not 0. Tokens are the words, A-Z lower-cased, and one end. ``base_score`` is the
    smoothed unigram log10-probability, ``score`` the network's, both of the whole text (a null one is empty). Without
    any training row nothing is known and the scores are those of the smoothing alone. Rows that share a ``doc_id``
    stay separate; other columns are ignored. Other files or partitions of the same rows change scores by no more than
    rounding.
    """
    rows = raw(docs)
    training = rows.filter(remainder(F.col("doc_id"), folds) != 0)
    lex, table = lexicon(training)
    # Texts are cut into words once more; training and scoring read numbers.
    numbers = materialize(coded(rows, lex), "coded")
    params = fit(numbers.filter(remainder(F.col("doc_id"), folds) != 0), lex).p
    scored = materialize(numbers.drop("mark", "lot", "rare").mapInArrow(lambda b: _score(b, params, CLASSES, lex.kind), SCORED_SQL), "scored")
    # Words outside the head are rare, so no word of this join is a hot key.
    rare = numbers.select("row", F.inline("rare")).join(table, "word", "left")
    found = rare.groupBy("row").agg(
        F.sum(F.col("k") * F.log10(F.coalesce("n", F.lit(0)) + F.lit(0.1))).alias("logs"), F.sum(F.when(F.col("n").isNotNull(), F.col("k"))).alias("seen")
    )
    total = lex.base_total
    logs = F.coalesce("logs", F.lit(0.0))
    return scored.join(found, "row", "left").select(
        "doc_id",
        (remainder(F.col("doc_id"), folds) == 0).alias("held_out"),
        "n_tokens",
        (F.col("known") + F.coalesce("seen", F.lit(0))).alias("n_known"),
        F.lit(lex.tokens).cast("long").alias("train_tokens"),
        (F.col("base") + logs - F.col("n_tokens") * total).alias("base_score"),
        (F.col("score") + logs).alias("score"),
    )
