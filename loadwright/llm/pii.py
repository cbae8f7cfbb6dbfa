"""Personal data by patterns, extended by a skip-chain conditional random field.

Patterns find emails, IP addresses, card numbers and phone numbers.  A CRF over
the tokens that hold a digit or ``@`` (any other token is not an entity) then
labels what the patterns leave out:

* unary potentials from token shapes and those of its neighbours;
* chain potentials between neighbouring tokens;
* skip potentials between distant tokens that repeat or resemble each other
  (same digits in another format, same name in front of an ``@``), each linked
  to its next occurrence, so a token repeated n times gives n - 1 links.

Loopy belief propagation over a whole document carries labels along the links:
each sweep passes messages from end to end of all runs of neighbours, then of
all rows of look-alikes, so evidence reaches every occurrence of an entity,
however many lie between, and weakens by what the skip potential gives for each
link.  Sweeps go on until the messages of a document stand still, for each
document by itself; on links without cycles the result is exact.  A run of n
neighbours takes about log n array steps, so long lists of numbers are no
special case.  A document whose cycles still swing after ``SWEEPS`` (damped from
sweep ``DAMPED`` on) keeps its last messages, which are proper probabilities.
The potentials are trained on the
pattern labels (distant supervision) by pseudo-likelihood: label and
neighbourhood patterns are counted by Spark over a bounded, documented sample
of distinct documents (``FIT_DOCS``) and only distinct patterns reach the driver.

Defined results: a null or empty text has no span; repeated rows are judged
each; an empty table gives an empty result; a corpus without any candidate
token has pattern spans only.  Digits other than 0 to 9 (superscripts, other
scripts) are letters like any other.  Places are code points, the end exclusive.
Extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadwright.llm.common import key_counts, map_batches, map_rows, sample_cut, sampled

KINDS = ("email", "ip", "card", "phone")
FIT_DOCS = 20_000
FEATURES = 4096
SLOTS = 6
#: Messages that change by less stand still.
STILL = 1e-6
#: Sweeps without damping, and in all.
DAMPED = 10
SWEEPS = 200
#: Look-alike tokens agree by this much where the sample has no evidence.
SKIP_PRIOR = 4.0
#: A token joins an entity if its belief reaches this.
BELIEF = 0.9

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# Possessive digits and the look-behind keep long digit runs linear; what matches stays the same.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_CANDIDATE = re.compile(r"(?<!\S)[^\s0-9@]*+[0-9@]\S*")
_RUN = re.compile(r"[0-9]+|[^\W\d_]+")

Span = tuple[str, int, int]


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (d > 4)
    return total % 10 == 0


def _byte(part: str) -> bool:
    return len(p := part.lstrip("0") or "0") <= 3 and int(p) <= 255


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """``[A-Za-z0-9._%+-]+@`` and a dotted name, leftmost first, in linear time."""
    last, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            last = m.end()
            yield start, last
        at = text.find("@", max(last, at + 1))


def base_spans(text: str) -> list[Span]:
    """Pattern spans by start, then kind."""
    out: list[Span] = []
    if "@" in text:
        out += [("email", s, e) for s, e in _emails(text)]
    if _DIGIT.search(text):
        out += [("ip", *m.span()) for m in _IP.finditer(text) if all(map(_byte, m[0].split(".")))]
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
        if "+" in text:
            out += [("phone", *m.span()) for m in _PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m[0]) <= 15]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def _shape(token: str) -> str:
    """Digits as 9 and their number, letters as a; other signs stay."""
    return _RUN.sub(lambda m: f"9{min(len(m[0]), 20)}" if m[0][0] in "0123456789" else "a", token)


def _small_number(part: str) -> bool:
    """Up to three ASCII digits, at most 255 (other digits, such as superscripts, are no numbers here)."""
    return part.isascii() and part.isdecimal() and len(part) < 4 and int(part) < 256


def _hash(slot: int, value: str) -> int:
    return zlib.crc32(f"{slot}|{value}".encode()) % FEATURES


@dataclass
class Graph:
    """Candidate tokens of many documents as one factor graph."""

    features: list[list[int]] = field(default_factory=list)
    labels: list[int] = field(default_factory=list)      # 0: none, else 1 + kind of the pattern span
    places: list[tuple[int, int, int]] = field(default_factory=list)  # document, start, end
    chain: list[tuple[int, int]] = field(default_factory=list)
    skip: list[tuple[int, int]] = field(default_factory=list)


def _keys(token: str) -> list[str]:
    """What makes tokens alike: their digits, their lower-cased text, the name before an @."""
    digits = "".join(c for c in token if c in "0123456789")
    keys = ["=" + token.lower()]
    if len(digits) >= 6:
        keys.append("9" + digits)
    if "@" in token[1:]:
        keys.append("=" + token[:token.index("@", 1)].lower())
    return keys


def add_document(graph: Graph, doc: int, text: str, spans: list[Span]) -> None:
    if not ("@" in text or _DIGIT.search(text)):
        return
    tokens = [m for m in _CANDIDATE.finditer(text)]
    seen: dict[str, int] = {}
    first, s = len(graph.features), 0
    cores = []
    for m in tokens:
        left = len(m[0]) - len(m[0].lstrip("\"'[{<,;:!?"))
        core = m[0][left:].rstrip("\"']}>,;:!?.") or m[0]
        cores.append((m.start() + (left if core != m[0] else 0), core))
    shapes = [_shape(c) for _, c in cores]
    for i, ((start, core), shape) in enumerate(zip(cores, shapes)):
        end = start + len(core)
        near_left = i > 0 and not text[tokens[i - 1].end():tokens[i].start()].strip()
        near_right = i + 1 < len(tokens) and not text[tokens[i].end():tokens[i + 1].start()].strip()
        digits = "".join(c for c in core if c in "0123456789")
        graph.features.append([
            _hash(0, shape), _hash(1, shapes[i - 1] if near_left else "-"), _hash(2, shapes[i + 1] if near_right else "-"),
            _hash(3, f"{min(len(digits), 20)}{luhn(digits) if 12 <= len(digits) <= 19 else '-'}"),
            _hash(4, f"{'@' in core}{core.count('.')}{core[0] == '+'}"),
            _hash(5, f"{'@' in core[1:-1]}{all(map(_small_number, core.split('.')))}")])
        while s < len(spans) and spans[s][2] <= start:
            s += 1
        hit = next((k for k, a, e in spans[s:s + 8] if a < end and start < e), None)
        graph.labels.append(0 if hit is None else 1 + KINDS.index(hit))
        graph.places.append((doc, start, end))
        if near_left:
            graph.chain.append((first + i - 1, first + i))
        for before in dict.fromkeys(seen[k] for k in _keys(core) if k in seen):
            if not near_left or before != first + i - 1:  # neighbours have a chain link
                graph.skip.append((before, first + i))
        for k in _keys(core):
            seen[k] = first + i


@dataclass
class SkipChainModel:
    unary: np.ndarray  # FEATURES x labels
    chain: np.ndarray  # labels x labels, left to right
    skip: np.ndarray   # labels x labels, symmetric

    def beliefs(self, graph: Graph) -> np.ndarray:
        """Label probabilities of every token by loopy sum-product messages.

        The links form classes of paths (the text neighbours, then the skip
        links).  A sweep passes exact messages along all paths of a class, with
        those of the other classes held, class after class.
        """
        n = len(graph.features)
        total = self.unary[np.array(graph.features)].sum(axis=1)
        chain = np.array(graph.chain, np.int64).reshape(-1, 2)
        has_left, has_right = np.zeros(n, bool), np.zeros(n, bool)
        has_left[chain[:, 1]], has_right[chain[:, 0]] = True, True
        total += np.where(has_left[:, None], 0, self.chain[0]) + np.where(has_right[:, None], 0, self.chain[:, 0])
        doc = np.array([d for d, _, _ in graph.places], np.int64)
        classes = [Paths.of(n, chain, self.chain)] + [Paths.of(n, np.array(e, np.int64), self.skip) for e in _path_classes(graph.skip)]
        classes = [c for c in classes if len(c.nodes)]
        for sweep in range(SWEEPS):
            if not classes:
                break
            change = np.zeros(doc[-1] + 1)
            for paths in classes:
                moved = paths.pass_messages(total, 0.5 if sweep >= DAMPED else 0.0)
                np.maximum.at(change, doc[paths.nodes], moved)
            if len(classes) == 1:  # paths alone: one pass is exact
                break
            live = change >= STILL
            classes = [c for c in (c.only(live[doc[c.nodes]]) for c in classes) if len(c.nodes)]
        total = np.exp(total - total.max(axis=1, keepdims=True))
        return total / total.sum(axis=1, keepdims=True)


def _path_classes(edges: list[tuple[int, int]]) -> list[list[tuple[int, int]]]:
    """The edges dealt out so that in a class each token has one link at most on either side."""
    out: list[tuple[list, set, set]] = []
    for x, y in edges:
        for same, left, right in out:
            if x not in left and y not in right:
                break
        else:
            same, left, right = [], set(), set()
            out.append((same, left, right))
        same.append((x, y))
        left.add(x)
        right.add(y)
    return [same for same, _, _ in out]


@dataclass
class Paths:
    """Disjoint paths through tokens, one after another, with the messages that reach each token on its path."""

    nodes: np.ndarray     # tokens in path order
    first: np.ndarray     # does a path start here?
    pot: np.ndarray       # [earlier label, later label]
    right: np.ndarray     # messages from the left end
    left: np.ndarray      # messages from the right end

    @classmethod
    def of(cls, n: int, edges: np.ndarray, pot: np.ndarray) -> "Paths":
        before, on = np.arange(n), np.zeros(n, bool)
        before[edges[:, 1]] = edges[:, 0]
        on[edges.ravel()] = True
        root = before
        while not np.array_equal(up := root[root], root):  # links lead to later tokens: roots are first tokens
            root = up
        nodes = np.flatnonzero(on)
        nodes = nodes[np.lexsort((nodes, root[nodes]))]
        zero = np.zeros((len(nodes), len(pot)))
        return cls(nodes, before[nodes] == nodes, pot, zero, zero.copy())

    def only(self, keep: np.ndarray) -> "Paths":
        return Paths(self.nodes[keep], self.first[keep], self.pot, self.right[keep], self.left[keep])

    def pass_messages(self, total: np.ndarray, damping: float) -> np.ndarray:
        """Updates ``total`` (scores with all messages); returns how far each token's messages moved."""
        score = total[self.nodes] - self.right - self.left
        last = np.append(self.first[1:], True)
        right = _forward(score[:, :, None] + self.pot, self.first)
        left = _forward((score[:, :, None] + self.pot.T)[::-1], last[::-1])[::-1]
        right, left = (damping * old + (1 - damping) * new for old, new in ((self.right, right), (self.left, left)))
        moved = np.maximum(np.abs(right - self.right), np.abs(left - self.left)).max(axis=1)
        self.right, self.left = right, left
        total[self.nodes] = score + right + left
        return moved


#: Tokens of a path that are taken one after another; longer paths are cut and their pieces' products linked.
PIECE = 32


def _forward(mats: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Message that reaches each place of the paths: that of the place before, through its matrix (logarithms).

    Long paths are cut into pieces: the product of each whole piece, the same
    problem over the pieces, then all pieces side by side.  The number of steps
    so grows with the logarithm of the longest path.
    """
    n, k = len(mats), mats.shape[1]
    out = np.zeros((n, k))
    starts = np.flatnonzero(first)
    size = np.diff(np.append(starts, n))
    if size.max(initial=0) > PIECE:
        place = np.arange(n) - np.repeat(starts, size)
        piece = np.flatnonzero(place % PIECE == 0)
        length = np.diff(np.append(piece, n))
        opens = first[piece]
        whole = np.append(~opens[1:], False)  # goes on in the next piece
        product = np.zeros((len(piece), k, k))
        product[whole] = mats[piece[whole]]
        for t in range(1, PIECE):
            product[whole] = _level(_logsumexp(product[whole][:, :, :, None] + mats[piece[whole] + t][:, None], 2), (1, 2))
        out[piece] = _forward(product, opens)
        starts, size = piece, length
    for t in range(1, size.max(initial=0)):
        at = starts[size > t] + t
        out[at] = _level(_logsumexp(out[at - 1][:, :, None] + mats[at - 1], 1), 1)
    return out


def _level(x: np.ndarray, axis) -> np.ndarray:
    return x - x.max(axis=axis, keepdims=True)


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis=axis, keepdims=True)
    return np.log(np.exp(x - top).sum(axis=axis)) + top.squeeze(axis)


def _patterns(docs: DataFrame) -> DataFrame:
    """(pattern, n): features, label, left, right, earlier and later look-alike's label (-1: none)."""

    def run(batches):
        for b in batches:
            g = Graph()
            for i, t in enumerate(b.column(0).to_pylist()):
                add_document(g, i, t or "", base_spans(t or ""))
            around = np.full((len(g.labels), 4), -1)
            around[:, :2] = 0  # a neighbour that is no candidate has no label
            for at, edges in ((0, g.chain), (2, g.skip)):
                for x, y in edges:
                    around[y, at], around[x, at + 1] = g.labels[x], g.labels[y]
            rows = [[*f, y, *a] for f, y, a in zip(g.features, g.labels, around.tolist())]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.int32()))], ["pattern"])

    return map_batches(docs, ["text"], "pattern array<int>", run).groupBy("pattern").agg(F.count(F.lit(1)).alias("n"))


def fit(docs: DataFrame, fit_docs: int = FIT_DOCS, steps: int = 150) -> SkipChainModel | None:
    """Potentials of most pseudo-likelihood on the sample; None without candidates."""
    key = ("doc_id", "text")
    size = docs.agg(*key_counts(key, 23)).first()
    some = docs.where(sampled(key, sample_cut(size.n, size.least, fit_docs), 23)).select(*key).dropDuplicates()
    rows = _patterns(some).collect()  # distinct patterns of a bounded sample
    if not rows:
        return None
    p = np.array([r.pattern for r in sorted(rows, key=lambda r: r.pattern)], np.int64)
    n = np.array([r.n for r in sorted(rows, key=lambda r: r.pattern)], float)
    k = len(KINDS) + 1
    feats, y, around = p[:, :SLOTS], p[:, SLOTS], p[:, SLOTS + 1:]
    prior = [np.zeros((FEATURES, k)), np.zeros((k, k)), SKIP_PRIOR * np.eye(k)]
    params = [x.copy() for x in prior]
    moments = [(np.zeros_like(x), np.zeros_like(x)) for x in params]
    target = np.eye(k)[y]
    weight = (np.log1p(n) / np.log1p(n).sum())[:, None]  # copies of one text don't rule
    for step in range(1, steps + 1):
        unary, chain, skip = params
        z = unary[feats].sum(axis=1) + chain[around[:, 0]] + chain.T[around[:, 1]]
        for c in (2, 3):
            z += np.where(around[:, c:c + 1] >= 0, skip[around[:, c]], 0)
        z = np.exp(z - z.max(axis=1, keepdims=True))
        err = (target - z / z.sum(axis=1, keepdims=True)) * weight
        grads = [-1e-5 * (x - x0) for x, x0 in zip(params, prior)]
        for c in range(SLOTS):
            np.add.at(grads[0], feats[:, c], err)
        np.add.at(grads[1], around[:, 0], err)
        right = np.zeros((k, k))
        np.add.at(right, around[:, 1], err)
        grads[1] += right.T
        for c in (2, 3):
            has = around[:, c] >= 0
            half = np.zeros((k, k))
            np.add.at(half, around[has, c], err[has])
            grads[2] += (half + half.T) / 2
        for x, g, (m, v) in zip(params, grads, moments):  # Adam
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x += 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.99 ** step)) + 1e-8)
    return SkipChainModel(*params)


def _added(graph: Graph, belief: np.ndarray, base: list[list[Span]]) -> None:
    """Appends runs of sure tokens to the spans of their document; a token that a pattern span touches ends a run."""
    label = belief.argmax(axis=1)
    sure = (label > 0) & (belief.max(axis=1) >= BELIEF) & (np.array(graph.labels) == 0)
    linked = set(graph.chain)
    at = 0
    while at < len(label):
        end = at + 1
        if sure[at]:
            while end < len(label) and sure[end] and label[end] == label[at] and (end - 1, end) in linked:
                end += 1
            doc, start, stop = graph.places[at][0], graph.places[at][1], graph.places[end - 1][2]
            base[doc].append((KINDS[label[at] - 1], start, stop))
        at = end


def find_spans(texts: list[str | None], model: SkipChainModel | None) -> list[tuple[list[Span], list[Span]]]:
    """(pattern spans, all spans) of each text."""
    graph = Graph()
    base = [base_spans(t or "") for t in texts]
    every = [list(s) for s in base]
    if model is not None:
        for i, t in enumerate(texts):
            add_document(graph, i, t or "", base[i])
        if graph.features:
            _added(graph, model.beliefs(graph), every)
    return [(b, sorted(a, key=lambda s: (s[1], KINDS.index(s[0])))) for b, a in zip(base, every)]


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def personal_data(docs: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base, spans) per row of ``docs``."""
    model = fit(docs, fit_docs)

    def run(batches):
        for b in batches:
            found = find_spans(b.column(1).to_pylist(), model)
            counts = [[sum(k == kind for k, _, _ in base) for base, _ in found] for kind in KINDS]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *(pa.array(c, pa.int64()) for c in counts), pa.array([_joined(x) for x, _ in found], pa.string()),
                 pa.array([_joined(x) for _, x in found], pa.string())],
                ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base", "spans"])

    return map_batches(docs, [F.col("doc_id").cast("long").alias("doc_id"), "text"],
                       "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base string, spans string", run)


def redact(text: str, spans: list[Span]) -> str:
    """``text`` with each span replaced by its kind; overlapping spans merge into the first."""
    out, at = [], 0
    for kind, start, end in spans:
        if start >= at:
            out += [text[at:start], f"<{kind.upper()}>"]
        at = max(at, end)
    return "".join([*out, text[at:]])


def mask_personal_data(docs: DataFrame, fit_docs: int = FIT_DOCS) -> DataFrame:
    """``docs``, all rows and columns, with personal data masked in ``text``.

    An integer ``n_chars`` column is set to the length of the masked text.
    """
    model = fit(docs, fit_docs)
    text = docs.columns.index("text")

    def run(batches):
        for b in batches:
            texts = b.column(text).to_pylist()
            masked = [t if t is None or not s else redact(t, s) for t, (_, s) in zip(texts, find_spans(texts, model))]
            yield b.set_column(text, b.schema.field(text), pa.array(masked, b.schema.field(text).type))

    out = map_rows(docs, run)
    if dict(docs.dtypes).get("n_chars") in ("int", "bigint"):
        out = out.withColumn("n_chars", F.length("text").cast(dict(docs.dtypes)["n_chars"]))
    return out
