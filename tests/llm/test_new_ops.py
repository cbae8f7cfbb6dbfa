"""Whitening, token counts and the prefix trie against brute force; edge cases of each."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from loadwright.llm import prefix_trie, token_counts, whitening

# ---------------------------------------------------------------------------
# op11
# ---------------------------------------------------------------------------
EMBEDDINGS = "vec_id long, embedding array<float>, label int, component int, n long, V string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 2, 3, "x") for i, v in rows], EMBEDDINGS)


def check_whitening(got, rows, components=8):
    """The rows of ``whiten`` against numpy's eigenvectors of the covariance in whole numbers."""
    x = np.array([[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in rows], object)
    n, sums = len(x), x.sum(axis=0)
    dev = n * x - sums
    z = dev.astype(float) / n
    values, vecs = np.linalg.eigh(z.T @ z / n)
    values, vecs = values[::-1], vecs[:, ::-1]
    rank = min(components, int((values > 1e-9 * values[0]).sum())) if values[0] > 0 else 0
    assert len(got) == n * rank
    assert all(r.n == n for r in got) and len({r.identity_error for r in got}) <= 1
    by = defaultdict(dict)
    for r in got:
        by[r.component][r.vec_id] = r
    assert sorted(by) == list(range(1, rank + 1))
    ids = [i for i, _ in rows]
    for k in range(rank):
        mine = by[k + 1]
        assert [mine[i].deviation for i in ids] == [int(v) for v in (dev * dev).sum(axis=1)]
        assert mine[ids[0]].explained == pytest.approx(values[k] / values.sum(), rel=1e-9)
        y = np.array([mine[i].whitened for i in ids])
        near = [j for j in range(len(values)) if abs(values[j] - values[k]) <= 1e-6 * values[0]]
        # the direction lies in the space of the eigenvalue's vectors
        back = z @ vecs[:, near] / math.sqrt(values[k])
        fit, *_ = np.linalg.lstsq(back, y, rcond=None)
        assert np.abs(back @ fit - y).max() < 1e-7 * max(1, np.abs(y).max()) and np.linalg.norm(fit) == pytest.approx(1, abs=1e-7)
    if rank:
        every = np.array([[by[k + 1][i].whitened for k in range(rank)] for i in ids])
        every = every - every.mean(axis=0)
        assert np.abs(every.T @ every / n - np.eye(rank)).max() == pytest.approx(got[0].identity_error, abs=1e-9) and got[0].identity_error < 1e-6


@pytest.mark.parametrize("name", ["plain", "clusters", "low rank", "equal axes", "two dims", "one row", "equal rows", "large"])
def test_op11_against_numpy(spark, name):
    rng = np.random.default_rng(len(name))
    x = {"plain": lambda: rng.normal(size=(400, 20)), "clusters": lambda: rng.normal(size=(5, 16))[rng.integers(0, 5, 600)] + 0.05 * rng.normal(size=(600, 16)),
         "low rank": lambda: rng.integers(-3, 4, (100, 3)) @ rng.integers(-3, 4, (3, 12)) / 8, "equal axes": lambda: np.vstack([np.eye(6), -np.eye(6)]) * 2,
         "two dims": lambda: rng.normal(size=(50, 2)), "one row": lambda: rng.normal(size=(1, 4)), "equal rows": lambda: np.ones((30, 4)),
         "large": lambda: rng.normal(size=(60, 3)) * 1e4}[name]()
    rows = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(x)]
    check_whitening(whitening.whiten(vectors(spark, rows)).collect(), rows)


def test_op11_bad_vectors(spark):
    rng = np.random.default_rng(1)
    good = [(i, [float(np.float32(c)) for c in v]) for i, v in enumerate(rng.normal(size=(40, 5)))]
    bad = [(100, None), (101, []), (102, [1.0, None, 0.0, 0.0, 0.0]), (103, [1.0, math.nan, 0.0, 0.0, 0.0]), (104, [math.inf, 0.0, 0.0, 0.0, 0.0]),
           (105, [1.0, 2.0]), (106, [1.0] * 6)]
    check_whitening(whitening.whiten(vectors(spark, good + bad)).collect(), good)
    assert whitening.whiten(vectors(spark, bad[:5])).count() == 0
    assert whitening.whiten(vectors(spark, good).limit(0)).count() == 0
    huge = [(i, [float(x), 3e38 * (i % 3 - 1)]) for i, x in enumerate(rng.normal(size=9))] + [(None, [0.5, 0.5]), (None, [0.5, 0.5])]
    got = whitening.whiten(vectors(spark, huge)).collect()
    assert sum(r.vec_id is None for r in got) == 2 * len({r.component for r in got}) > 0 and any(r.deviation is None for r in got)


def test_singular_values_of_hard_matrices():
    rng = np.random.default_rng(5)
    n = 21
    wilkinson = np.diag(np.abs(np.arange(n) - 10.0) + 0.5) + np.diag(np.ones(n - 1), 1)
    graded = np.linalg.qr(rng.normal(size=(60, 30)) * 10.0 ** -np.arange(30), mode="r")
    round_ = np.linalg.qr(rng.normal(size=(5000, 40)), mode="r")
    for r in (wilkinson, graded, round_, np.diag(np.arange(1.0, 20)), np.diag([3.0, 3, 3, 2, 2, 0, 0])):
        values, d = whitening.leading_directions(r, 8)
        want = np.linalg.svd(r, compute_uv=False)[:len(values)] ** 2
        assert len(values) == min(8, int((want > 0).sum()) if len(want) == 8 else len(values)) and np.abs(values / want - 1).max() < 1e-13
        assert np.abs(d.T @ d - np.eye(len(values))).max() < 1e-12 and np.abs(r.T @ (r @ d) - d * values).max() < 1e-12 * values[0]
    small = whitening.squared_singular_values(np.array([1.0, 1e-9, 1e-18]), np.array([1e-4, 1e-12]))
    exact = np.sort(np.linalg.svd(np.diag([1.0, 1e-9]) + np.diag([1e-4], 1), compute_uv=False) ** 2)
    assert small[-1] == pytest.approx(exact[-1], rel=1e-14) and (small > 0).all()
    assert np.prod(np.sqrt(small)) == pytest.approx(1e-27, rel=1e-13)  # the determinant: small values are accurate too


# ---------------------------------------------------------------------------
# op12
# ---------------------------------------------------------------------------
PARTS = ["a", "B", "'s", "'", "re", "'LL", " ", "  ", "\n", "\t", "\r", "1", "23", "é", "É", "ß", "İ", "ſ", "ÿ", "²", "½", "ª", "“", "–", " ", "\x85", "\x1c", "\x0b",
         "́", "é", "中", "٣", "<|", "<|endoftext|>", "<|startoftext|>", "|>", "Σ", "​", "　", "K", "×", "_", "-", "\x00", "😀", "ﬁ", "­"]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(token_counts.default_path())
    return lambda text: len(t.encode(text or "", add_special_tokens=False).ids)


def test_op12_lengths_equal_library(library):
    rng = random.Random(12)
    lengths = token_counts.Lengths(token_counts.Library(token_counts.default_path()), {"a": 1, "1": 1}, room=50)
    assert lengths.library.by_word
    for _ in range(20_000):
        text = "".join(rng.choices(PARTS, k=rng.randint(0, 9)))
        assert lengths.count(text) == library(text), text
    for code in (*range(0x20, 0x600), *range(0x2000, 0x2100), 0x1E9E, 0xFB01, 0x1F600):
        text = f"x{chr(code)}Y 7{chr(code)}"
        assert lengths.count(text) == library(text), text
    assert len(lengths) <= 52


@pytest.mark.parametrize("words", [token_counts.TABLE_WORDS, 3, 0])
def test_op12_against_library(spark, library, words):
    rng = random.Random(words)
    texts = ["".join(rng.choices(PARTS + ["thing ", "word ", "other "] * 9, k=rng.randint(0, 60))).replace("\x00", "") for _ in range(150)]
    texts += [None, "", " \n", "word " * 30_000, "word " * 30_000, "z" * 5000, "word " * 2048, "word " * 2049]
    rows = [(i % 100 if i % 40 else None, t, 1, "x") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int, Table string")
    got = token_counts.count_tokens(docs, table_words=words).collect()
    assert Counter(tuple(r) for r in got) == Counter((d, len((t or "").encode()), n := library(t), n > 2048) for d, t, *_ in rows)
    assert token_counts.count_tokens(docs.limit(0)).count() == 0


def test_op12_other_tokenizers(spark):
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    texts = ["Some words, don't 12 é", "<|endoftext|> a", "", None, "  two  spaces "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bpe = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    for file, want in (("byte_bpe_50k.json", lambda t: len(bpe.encode(t, add_special_tokens=False).ids)), ("piece_bpe_32k.model", lambda t: len(pieces.encode(t)))):
        got = {r.doc_id: r.n_tokens for r in token_counts.count_tokens(docs, tokenizer=public_tokenizers.path(file)).collect()}
        assert got == {i: want(t) if t else 0 for i, t in enumerate(texts)}


def test_op12_summary_keeps_heavy_words():
    rng = random.Random(3)
    total, whole = Counter(), Counter()
    for _ in range(40):
        part = Counter(rng.choices(["hot", "warm"] + [f"w{i}" for i in range(5000)], weights=[900, 300] + [1] * 5000, k=3000))
        whole += part
        total = token_counts.trim(total + token_counts.trim(part, 200), 200)
    assert len(total) <= 200 and token_counts.unpack(token_counts.pack(total)) == total
    assert all(total[w] > 0 and whole[w] - total[w] <= 2 * sum(whole.values()) / 200 for w in ("hot", "warm"))


# ---------------------------------------------------------------------------
# op13
# ---------------------------------------------------------------------------
CONVERSATIONS = "conv_id long, turn int, role string, text string, pos int, K1 long, block string"


def brute_trie(rows):
    turns = defaultdict(list)
    for c, at, role, text in rows:
        if c is not None:
            turns[c].append((at is not None, at or 0, role or "", text or ""))
    turns = {c: [(r, x) for _, _, r, x in sorted(v)] for c, v in turns.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = turns.get(c - int(math.fmod(c, 20)), [])[:h] + own[h:]
    members, children = defaultdict(list), defaultdict(set)
    for c, seq in whole.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
            if d:
                children[tuple(seq[:d - 1])].add(tuple(seq[:d]))
    leaves, saved = Counter(), Counter()
    for node, m in members.items():
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        for d in range(len(node) + 1):
            saved[node[:d]] += (len(m) - 1) * words
            leaves[node[:d]] += node not in children
    out = Counter()
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(whole[c]) == len(node))
        out[min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(children.get(node, ())), leaves[node], saved[node],
            hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def tree(spark, rows):
    return spark.createDataFrame([(*r, 1, 2, "x") for r in rows], CONVERSATIONS)


@pytest.mark.parametrize("seed", [1, 2])
def test_op13_against_brute_force(spark, monkeypatch, seed):
    """Shared turns, ties, nulls, repeated rows, turnless conversations, chunks and blocks that are short."""
    rng = random.Random(seed)
    if seed == 2:
        monkeypatch.setattr(prefix_trie, "WIDTH", 3)
        monkeypatch.setattr(prefix_trie, "CHUNK", 2)
        monkeypatch.setattr(prefix_trie, "RUN_IDS", 2)
    rows = []
    for c in rng.sample(range(-60, 300), 150):
        for at in range(rng.choice([1, 1, 2, 3, 5, 9, 20 if c % 7 == 0 else 4])):
            role = rng.choice(["user", "assistant", None]) if at > 3 else "user"
            rows.append((c, at if rng.random() < 0.9 else rng.choice([0, None]), role, rng.choice(["a b", "a  c d", "", None, "x\ty z"]) if at else "same start"))
    rows += rng.sample(rows, 10) + [(None, 1, "user", "lost"), (7, None, None, None), (7, None, None, None)]
    got = prefix_trie.trie(tree(spark, rows)).collect()
    assert Counter(tuple(r) for r in got) == brute_trie(rows)


def test_op13_hot_conversation_and_empty(spark):
    rows = [(40, i, "user", f"turn {i % 50} of it") for i in range(600)] + [(c, i, "user", f"turn {i} of it") for c in range(40, 100) for i in range(3) if c > 40]
    got = prefix_trie.trie(tree(spark, rows)).collect()
    assert Counter(tuple(r) for r in got) == brute_trie(rows)
    assert prefix_trie.trie(tree(spark, rows).limit(0)).count() == 0
    assert prefix_trie.trie(tree(spark, [(None, 1, "a", "b")])).count() == 0
    one = prefix_trie.trie(tree(spark, [(5, None, None, None)])).collect()  # crc32("5") % 4 turns go, and there is no family head
    assert Counter(tuple(r) for r in one) == brute_trie([(5, None, None, None)])
